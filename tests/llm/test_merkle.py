import hashlib
import random

from pyspark.sql import functions as F

from loomtext.llm import merkle
from tests.llm.fixtures import empty_documents, odd_documents, odd_rows, with_clashes


def brute(rows):
    """Sorted by id, an edit with the next document; for unique ids."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    found = {}
    for i, (doc, text, *_) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        quarter = len(text) // 4
        found[doc] = (len(text), text[: len(text) - quarter] + after[:quarter], text)
    return found


def unique_rows():
    seen = {}
    for r in odd_rows():
        seen.setdefault(r[0], r)
    return list(seen.values())


def test_edited_texts_against_brute_force(spark):
    rows = unique_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4)
    want = brute(rows)
    got = merkle.edited_likeness(with_clashes(docs)).collect()
    assert len(got) == len(rows)
    roots = {}
    for r in got:
        n, edited, text = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (edited == text)
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["near_edited"] == 1) or edited != text
        roots.setdefault(text, set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in roots.values()) and len(set.union(*roots.values())) == len(roots)


def test_many_ranges_find_the_next_document(spark):
    docs = spark.range(500).select((F.col("id") * 3).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    got = {r["doc_id"]: r["next_text"] for r in merkle.with_next(docs, range_bytes=400).collect()}
    assert got == {3 * i: f"text {(i + 1) % 500}" for i in range(500)}


def test_repeated_ids_and_rows(spark):
    rows = merkle.edited_likeness(odd_documents(spark)).collect()
    assert len(rows) == len(odd_rows())
    assert len({tuple(r) for r in rows if r["doc_id"] == 200}) <= 2


def test_a_lone_document_is_its_own_next(spark):
    rows = merkle.edited_likeness(spark.createDataFrame([(1, "abcdefgh")], "doc_id bigint, text string")).collect()
    assert rows[0]["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and rows[0]["near_next"] == 1


def test_branches_locate_edits(spark):
    lines = [f"paragraph {i}" for i in range(30)]
    changed = lines.copy()
    changed[3], changed[20] = "other", "another"
    old = [(1, "\n".join(lines)), (2, "\n".join(lines)), (3, "a"), (4, None)]
    new = [(1, "\n".join(changed)), (2, "\n".join(lines)), (3, "a\nb"), (4, "")]
    tables = [merkle.fingerprints(spark.createDataFrame(t, "doc_id bigint, text string")) for t in (old, new)]
    got = sorted((r["doc_id"], r["section"], r["paragraph"]) for r in merkle.edits(*tables).collect())
    assert got == [(1, 0, 3), (1, 2, 20), (3, 0, 1)]


def test_likeness_follows_the_share_that_stays(spark):
    words = [f"w{i}" for i in range(400)]
    pairs = [(words, words[:300] + [f"v{i}" for i in range(100)]), (words, [f"v{i}" for i in range(400)]), (words, ["new", *words])]
    df = spark.createDataFrame([(" ".join(a), " ".join(b)) for a, b in pairs], "a string, b string")
    near = [r[0] for r in df.select(merkle.likeness(merkle.marks(F.col("a")), merkle.marks(F.col("b")))).collect()]
    assert 0.7 <= near[0] <= 0.8 and near[1] == 0 and near[2] > 0.95


def test_chunks_cover_every_character_and_one_edit_changes_few(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghinorst.,") for _ in range(rng.randint(1, 9))) for _ in range(600)]
    line = " ".join(words)
    put_in, taken_out = "new " + line, " ".join(words[:250] + words[251:])
    unspaced = "".join(rng.choice("的一是不了在人有我他这") for _ in range(2000))
    tail = unspaced[:1500] + "".join(rng.choice("中来上大为和国") for _ in range(500))
    odd = "  two  spaces \n\n\tTab\n" + "x" * 100 + " end \n"
    pairs = [(line, put_in), (line, taken_out), (unspaced, tail), (odd, odd)]
    df = spark.createDataFrame(pairs, "a string, b string")
    near = [r[0] for r in df.select(merkle.likeness(merkle.marks(F.col("a")), merkle.marks(F.col("b")))).collect()]
    assert near[0] > 0.97 and near[1] > 0.97 and 0.7 < near[2] < 0.8 and near[3] == 1
    changed = spark.createDataFrame([(odd, odd[:i] + "#" + odd[i + 1 :]) for i in range(len(odd))], "a string, b string")
    assert changed.where(merkle.marks(F.col("a")) == merkle.marks(F.col("b"))).count() == 0  # no character is in no chunk


def test_empty_table(spark):
    assert merkle.edited_likeness(empty_documents(spark)).collect() == []
    assert merkle.fingerprints(empty_documents(spark)).collect() == []


def test_main_path_is_native(spark):
    plan = merkle.edited_likeness(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
