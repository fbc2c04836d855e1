import random

import pytest
import xxhash
from pyspark.sql import functions as F

from loomtext.llm import simhash
from loomtext.llm.components import components
from tests.llm.fixtures import empty_documents, odd_documents, odd_rows, with_clashes


def fingerprint(text, words=3):
    parts = (text or "").encode().lower().split()
    shingles = [b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))] if parts else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closest(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints_and_classes_against_brute_force(spark):
    rows = simhash.near_duplicates(odd_documents(spark)).collect()
    source = odd_rows()
    prints = {r[1]: fingerprint(r[1]) for r in source}
    assert sorted((str(r["doc_id"]), r["fingerprint"]) for r in rows) == sorted((str(r[0]), f"{prints[r[1]]:016x}") for r in source)
    distinct = sorted(set(prints.values()))
    root = closest(distinct, [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 2])
    least = {}
    for r in source:
        if r[0] is not None:
            at = root[prints[r[1]]]
            least[at] = min(least.get(at, r[0]), r[0])
    for r in rows:
        assert r["component_id"] == least.get(root[int(r["fingerprint"], 16)])


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_links_connect_all_pairs_within_the_radius(spark, radius):
    rng = random.Random(radius)
    centres = [rng.getrandbits(64) for _ in range(6)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(25)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp bigint"), radius)
    got = {(r["node"], r["root"]) for r in components(links).collect()}
    mask = (1 << 64) - 1
    pairs = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= radius]
    root = closest(signed, pairs)
    assert got == {(n, root[n]) for p in pairs for n in p}


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.near_links(spark.createDataFrame([(1,)], "fp bigint"), 3)


@pytest.mark.parametrize("shape", ["path", "star", "ring", "two"])
def test_components(spark, shape):
    n = 200
    order = random.Random(3).sample(range(n), n)
    links = {
        "path": list(zip(order, order[1:])),
        "star": [(order[0], o) for o in order[1:]],
        "ring": list(zip(order, order[1:] + order[:1])),
        "two": [(a, b) for a, b in zip(order, order[2:])],
    }[shape]
    links += [(5, 5), links[0], links[0][::-1]]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = closest(range(n), links)
    assert got == want


def shingles(text, words=5):
    parts = (text or "").encode().lower().split()
    return {b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))} if parts else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(words, changes, rng):
    words = words.copy()
    for at in rng.sample(range(len(words)), changes):
        words[at] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_similarity_is_estimated_from_sketches(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(3000)}" for _ in range(400)]
    pairs = [(" ".join(base), edited(base, n, rng)) for n in (0, 1, 4, 8, 12, 20, 60)]
    df = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", simhash.sketch(F.col("a")).alias("one"), simhash.sketch(F.col("b")).alias("two"))
    for r in df.select("a", "b", simhash.similarity_of("one", "two").alias("s")).collect():
        assert abs(r["s"] - jaccard(r["a"], r["b"])) < 0.1


def test_near_copies_go_and_others_stay(spark):
    rng = random.Random(8)
    rows, groups = [], 40
    for g in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(150, 500))]
        for copy in range(1 + g % 5):
            rows.append((g * 10 + copy, edited(base, len(base) // 60 if copy else 0, rng)))  # similar to about 0.85
        rows.append((g * 10 + 9, edited(base, len(base) // 6, rng)))  # to about 0.25
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect()}
    assert kept == {g * 10 for g in range(groups)} | {g * 10 + 9 for g in range(groups)}


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(300)]
    rows = [(i, edited(base, 2, rng)) for i in range(400)] + [(1000 + i, edited(base, 290, rng)) for i in range(400)]
    kept = sorted(r["doc_id"] for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert kept == [0, *range(1000, 1400)]


def family(members, own, rng, length=400):
    """Texts of ``length`` words that share all but one run of ``own`` words."""
    base = [f"b{i}" for i in range(length)]
    at = (length - own) // 2
    return [base[:at] + [f"n{rng.randrange(10**9)}" for _ in range(own)] + base[at + own :] for _ in range(members)]


def test_texts_that_share_a_template_stay(spark):
    rng = random.Random(11)
    texts = [" ".join(t) for t in family(300, 56, rng)]
    assert 0.72 < jaccard(texts[0], texts[1]) < 0.75
    kept = simhash.drop_near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert kept.count() == len(texts)


@pytest.mark.parametrize("part", [1024, 3])
def test_all_that_meet_are_compared(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)
    rng = random.Random(12)
    texts = family(400, 78, rng)  # similar to 0.66
    for of in range(60):
        copy = texts[of].copy()
        copy[rng.randrange(200, 230)] = copy[rng.randrange(20)] = "changed"
        texts.append(copy)
    texts = [" ".join(t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bands = {r[0]: r[1] for r in docs.select("doc_id", simhash.sketch(F.col("text"))["bands"]).collect()}
    meet = lambda a, b: any((x ^ y).bit_count() <= 2 for x, y in zip(bands[a], bands[b], strict=True))
    pairs = [(of, 400 + of) for of in range(60) if meet(of, 400 + of) and jaccard(texts[of], texts[400 + of]) >= 0.8]
    assert len(pairs) > 50
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect()}
    assert not kept & {b for _, b in pairs}
    assert kept >= set(range(400))


def around(base, members, rng):
    """Texts with one to eight words of ``base`` replaced, left out or doubled."""
    texts = []
    for _ in range(members):
        words = base.copy()
        for _ in range(rng.randint(1, 8)):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[f"n{rng.randrange(10**9)}"], [], [words[at]] * 2])
        texts.append(words)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_crowds_are_connected_as_by_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(simhash, "CROWD", 0)
    rng = random.Random(seed)
    texts = around([f"w{i}" for i in range(150)], 250, rng) + around([f"v{i % 40}" for i in range(60)], 60, rng)
    texts = [" ".join(t) for t in {" ".join(t): t for t in texts}.values()]
    df = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    nodes = df.select("node", simhash.sketch(F.col("text")).alias("sketch")).cache()
    got = {(r["a"], r["b"]) for r in simhash.similar_links(nodes, df).collect()}
    assert all(jaccard(texts[a], texts[b]) >= 0.8 for a, b in got)
    true = {(a, b) for b in range(len(texts)) for a in range(b) if jaccard(texts[a], texts[b]) >= 0.8}
    assert len(true) > 200
    assert closest(range(len(texts)), sorted(got)) == closest(range(len(texts)), sorted(true))


def test_copies_in_a_large_family_are_found_without_all_pairs(spark, monkeypatch):
    rng = random.Random(14)
    members = 5000
    texts = family(members, 40, rng, length=200)  # similar to 0.65
    for of in range(50):
        copy = texts[of].copy()
        copy[100] = copy[rng.randrange(20)] = "changed"
        texts.append(copy)
    texts = [" ".join(t) for t in texts]
    assert all(jaccard(texts[of], texts[members + of]) >= 0.8 for of in range(50))
    compared, ordered = [], simhash._ordered

    def counting(pairs, one, other):
        made = ordered(pairs, one, other)
        compared.append(made.count())
        return made

    monkeypatch.setattr(simhash, "_ordered", counting)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect()}
    assert kept == set(range(members))
    assert sum(compared) < 40 * members


@pytest.mark.parametrize("bands", [[5] * 6, [0, 1, 2, 4, 8, 16], [5, 5, 5, 4, 4, 4]])
def test_a_pair_is_found_behind_others(spark, bands):
    rng = random.Random(13)
    texts = [[f"w{rng.randrange(10**6)}" for _ in range(100)] for _ in bands]
    texts[4] = texts[2][:50] + ["new"] + texts[2][51:]
    rows = [(i, [b], " ".join(t)) for i, (b, t) in enumerate(zip(bands, texts, strict=True))]
    df = spark.createDataFrame(rows, "node long, bands array<bigint>, text string")
    nodes = df.select("node", simhash.sketch(F.col("text")).withField("bands", F.col("bands")).alias("sketch"))
    assert [tuple(r) for r in simhash.similar_links(nodes, df.select("node", "text")).collect()] == [(2, 4)]


def test_kept_rows_have_all_columns(spark):
    docs = with_clashes(odd_documents(spark))
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    texts = [r["text"] for r in kept.collect()]
    same = closest(range(len(texts)), [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(texts[i], texts[j]) >= 0.9])
    assert len(set(same.values())) == len(texts)  # no two that are left are near copies
    assert all(any(jaccard(r[1], t) >= 0.7 for t in texts) for r in odd_rows())  # and all others have one that is left


def test_empty_table(spark):
    assert simhash.near_duplicates(empty_documents(spark)).collect() == []
    assert simhash.drop_near_duplicates(empty_documents(spark)).collect() == []


def test_a_group_meets_in_bounded_buckets(spark):
    # However many documents share a fingerprint, a variant gathers fingerprints, not documents.
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("one two three four").alias("text"))
    assert {r["component_id"] for r in simhash.near_duplicates(docs).collect()} == {0}
