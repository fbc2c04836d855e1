import math

import pytest
from pyspark.sql import functions as F

from loomtext.functions.text import collapse_whitespace, tokens_of
from loomtext.operators import checks, encode, vocab
from loomtext.sources import vocab_file


def docs(spark, texts, parts=3):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "row_id string, text string").repartition(parts)


TEXTS = ["b a a", "a b c", "", None, "智能 a", "  a\n\tb  "]


def vocabulary(spark, size=32000, texts=TEXTS):
    return vocab.frequency_vocab(vocab.token_counts(docs(spark, texts)), size)


def test_ids_by_count_then_piece(spark):
    rows = [tuple(r) for r in vocabulary(spark).orderBy("id").collect()]
    # ▁a: 5, ▁b: 3, then one ▁c and one ▁智能
    assert [(i, p) for i, p, _, _ in rows] == [
        (0, "<pad>"), (1, "<unk>"), (2, "<s>"), (3, "</s>"), (4, "▁a"), (5, "▁b"), (6, "▁c"), (7, "▁智能")]
    assert [s for *_, s in rows] == [True] * 4 + [False] * 4
    assert math.isclose(rows[4][2], math.log(5 / 10))


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_vocabulary_does_not_depend_on_partitions(spark, parts):
    found = vocab.frequency_vocab(vocab.token_counts(docs(spark, TEXTS, parts)), 6)
    assert [r["piece"] for r in found.orderBy("id").collect()][4:] == ["▁a", "▁b"]


def encoded(spark, v, **options):
    rows = encode.encode_words(docs(spark, TEXTS), v, **options).collect()
    return {int(r["row_id"]): r["input_ids"] for r in rows}


def test_encode(spark):
    v = vocabulary(spark, 6)
    assert encoded(spark, v) == {0: [5, 4, 4, 3], 1: [4, 5, 1, 3], 2: [3], 3: None, 4: [1, 4, 3], 5: [4, 5, 3]}
    assert encoded(spark, v, append_eos=False) == {0: [5, 4, 4], 1: [4, 5, 1], 2: [], 3: None, 4: [1, 4], 5: [4, 5]}


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_a_join_gives_what_the_broadcast_gives(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(encode, "HOT_SHARE", 1e-9)
    v = vocabulary(spark, 6)
    df = docs(spark, [*TEXTS, "a " * 500]).withColumn("values", F.lit("own")).withColumn("item", F.lit(7))
    by_broadcast = encode.encode_words(df, v)
    joined = encode.encode_joined(df, encode.word_dictionary(v), hot_rows=hot_rows)
    assert joined.columns == by_broadcast.columns
    got = {r["row_id"]: r["input_ids"] for r in joined.collect()}
    assert got == {r["row_id"]: r["input_ids"] for r in by_broadcast.collect()}
    back = encode.decode_joined(by_broadcast, v, hot_rows=hot_rows)
    want = encode.decode(by_broadcast, v)
    assert {r["row_id"]: r["decoded"] for r in back.collect()} == {r["row_id"]: r["decoded"] for r in want.collect()}


def test_a_vocabulary_beyond_the_broadcast_is_joined(spark, monkeypatch):
    v = vocabulary(spark)
    want = encoded(spark, v)
    df = docs(spark, TEXTS)
    text = {r["row_id"]: r["decoded"] for r in encode.decode(encode.encode_words(df, v), v).collect()}
    pieces_of = vocab.pieces_of
    for refuse in (lambda t: pieces_of(t, limit=7), None):
        if refuse:
            monkeypatch.setattr(encode, "pieces_of", refuse)
        else:
            monkeypatch.setattr(encode, "pieces_of", pieces_of)
            monkeypatch.setattr(vocab, "MAX_BYTES", 3)
        plan = encode.encode_words(df, v)
        assert "_salt" in plan._jdf.queryExecution().toString()
        assert {int(r["row_id"]): r["input_ids"] for r in plan.collect()} == want
        assert {r["row_id"]: r["decoded"] for r in encode.decode(plan, v).collect()} == text


def test_hot_words_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(encode, "HOT_SHARE", 1e-9)
    df = spark.range(200).select(F.col("id").cast("string").alias("row_id"), F.split(F.lit("the the the the other"), " ").alias("w"))
    table = spark.createDataFrame([("the", 1), ("other", 2)], "item string, value int")
    found = encode.looked_up(df, "row_id", F.col("w"), table, hot_rows=50)
    assert [r["_values"] for r in found.collect()] == [[1, 1, 1, 1, 2]] * 200
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "_places" in plan
    salts = df.select("row_id", F.posexplode("w").alias("at", "item")).where("item = 'the'").groupBy(F.pmod(F.xxhash64("row_id", "at"), F.lit(16))).count()
    assert salts.count() == 16 and salts.agg(F.max("count")).first()[0] < 100


def test_text_equal_to_a_reserved_piece_is_no_reserved_id(spark):
    v = vocabulary(spark, texts=["<pad> x"])
    ids = encode.word_ids(F.array(F.lit("<pad>"), F.lit("</s>")), v, append_eos=False)
    assert spark.range(1).select(ids).first()[0] == [1, 1]


def test_round_trip(spark):
    texts = [t for t in TEXTS if t is not None] + ["Don't  stop, 智能2024!", "a😀b"]
    v = vocabulary(spark, texts=texts)
    df = docs(spark, texts).withColumn("want", collapse_whitespace(F.col("text")))
    coded = df.withColumn("input_ids", encode.word_ids(tokens_of(F.col("text")), v))
    assert encode.decode(coded, v).where(F.col("decoded") != F.col("want")).count() == 0


def test_decode_skips_special_and_foreign_ids(spark):
    v = vocabulary(spark)
    df = spark.createDataFrame([(0, [2, 4, 1, 5, 3, 0, 99, -5]), (1, []), (2, None), (3, [3, 3])], "i int, input_ids array<int>")
    assert {r["i"]: r["decoded"] for r in encode.decode(df, v).collect()} == {0: "a b", 1: "", 2: None, 3: ""}


def test_show_pieces(spark):
    shown = encode.show_pieces(docs(spark, ["a q智能"]), vocabulary(spark)).first()["pieces"]
    assert shown == ["▁a", "<unk>", "<unk>"]


def test_char_coverage(spark):
    counts = spark.createDataFrame([("a", 90), ("b", 5), ("c", 5)], "ch string, n long")
    for share, want in [(0.9, ["a"]), (0.91, ["a", "b"]), (0.95, ["a", "b"]), (0.96, ["a", "b", "c"]), (1.0, ["a", "b", "c"])]:
        assert sorted(r["ch"] for r in vocab.covering_chars(counts, share).collect()) == want
    got = {r["ch"]: r["n"] for r in vocab.char_counts(docs(spark, ["a😀a", "", None, "智"])).collect()}
    assert got == {"a": 2, "😀": 1, "智": 1}


def test_vocabulary_files(spark, tmp_path):
    lines = "<pad>\t0\n<unk>\t0\n<s>\t0\n</s>\t0\n▁a\t-2.5\nmalformed\n\n智\t-3\n"
    (tmp_path / "v.vocab").write_text(lines, encoding="utf-8")
    rows = [tuple(r) for r in vocab_file.read_vocab_tsv(spark, str(tmp_path / "v.vocab")).orderBy("id").collect()]
    assert rows == [(0, "<pad>", 0.0, True), (1, "<unk>", 0.0, True), (2, "<s>", 0.0, True), (3, "</s>", 0.0, True),
                    (4, "▁a", -2.5, False), (5, "智", -3.0, False)]
    v = vocabulary(spark)
    vocab_file.write_vocab(v, str(tmp_path / "table"))
    vocab_file.write_vocab_tsv(v, str(tmp_path / "tsv"))
    want = sorted(map(tuple, v.collect()))
    assert sorted(map(tuple, vocab_file.read_vocab(spark, str(tmp_path / "table")).collect())) == want
    assert sorted(map(tuple, vocab_file.read_vocab_tsv(spark, str(tmp_path / "tsv")).collect())) == want


def test_guards(spark):
    v = vocabulary(spark)
    assert checks.require_vocab(v, 8) == 8
    with pytest.raises(RuntimeError, match="fewer than 1000"):
        checks.require_vocab(v)
    with pytest.raises(RuntimeError, match="not unique"):
        checks.require_vocab(v.unionByName(v.where("id = 5")), 1)
    checks.require_same_vocab_size(8, v)
    with pytest.raises(ValueError, match="model 3, tokenizer 8"):
        checks.require_same_vocab_size(3, v)
    with pytest.raises(ValueError, match="more than 7"):
        vocab.pieces_of(v, limit=7)
    with pytest.raises(ValueError, match="not 0..V-1"):
        vocab.pieces_of(v.where("id <> 2"))
    df = docs(spark, ["x" * 10, "a\nb"])
    assert tuple(checks.corpus_size(df).first()) == (15, 3, 2)
    assert checks.corpus_size(df, last_newline=False).first()["bytes"] == 14
    assert checks.corpus_size(docs(spark, []), last_newline=False).first()["bytes"] == 0
    assert checks.require_corpus_bytes(df, 15) == 15
    with pytest.raises(RuntimeError, match="15 bytes"):
        checks.require_corpus_bytes(df)


def test_a_batch_is_looked_up_in_parts(spark, monkeypatch):
    """What a lookup makes besides its result is bounded by ``AT_ONCE`` tokens, whatever the batch; parts may end inside a row."""
    asked = []
    real = encode.pc.index_in
    monkeypatch.setattr(encode.pc, "index_in", lambda values, **how: (asked.append(len(values)), real(values, **how))[1])
    monkeypatch.setattr(encode, "AT_ONCE", 3, raising=False)
    monkeypatch.setattr(encode.F, "arrow_udf", lambda kind: lambda f: lambda column: f)
    shared = type("Shared", (), {"value": encode.pa.array(["<pad>", "<unk>", "<s>", "</s>", "a", "b"])})
    monkeypatch.setattr(encode, "shared_pieces", lambda found: shared)
    rows = [["a", "b", "x", "a", "b", "a", "b"], None, [], ["b"], ["x", "x"], ["a", "x", "b"], []]
    ids = encode.word_ids(F.lit(1), shared)(encode.pa.array(rows))
    number = {"a": 4, "b": 5, "x": 1}
    assert ids.to_pylist() == [None if r is None else [*map(number.get, r), 3] for r in rows]
    assert encode.id_pieces(F.lit(1), shared)(ids).to_pylist() == [None if r is None else [w for w in r if w != "x"] for r in rows]
    assert max(asked) <= 3


def test_the_arrays_of_a_join_are_made_once(spark):
    """Counting, dealing out and joining read the written arrays; the text is cut by one job."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def cut(text):
        seen.add(1)
        return None if text is None else text.split()

    df = docs(spark, ["a b a", None, "", "b"])
    table = spark.createDataFrame([("a", 1)], "item string, value int")
    found = encode.looked_up(df, "row_id", cut("text"), table)
    assert {int(r["row_id"]): r["_values"] for r in found.collect()} == {0: [1, None, 1], 1: None, 2: [], 3: [None]}
    assert seen.value == 4


def test_only_different_words_are_cut_by_script(spark):
    df = docs(spark, ["a b-c a", "", None, "a  智能2024!", "x▁y ▁"])
    for mode in ("whitespace", "none"):
        found = vocab.token_counts(df, mode)
        want = df.select(F.explode(encode.tokens_of(F.col("text"), mode)).alias("tok")).groupBy("tok").count()
        assert {tuple(r) for r in found.collect()} == {tuple(r) for r in want.collect()}
        cut, below = found._jdf.queryExecution().optimizedPlan().toString().split("regexp_extract_all", 1)
        assert "Aggregate" in cut and "Aggregate" in below


def test_only_the_different_items_of_a_chunk_are_joined(spark, monkeypatch):
    """What is joined grows with the different items of a chunk, not with the elements; chunks end between rows, and every chunk, also a small one, gives the same."""
    rows = [(0, ["a", "b", "a", None, "x"]), (1, None), (2, []), (3, ["b"] * 40), (4, ["x", "a"]), (5, ["c"]), (6, [None])] + [(i, ["a", "b", "c"] * 30) for i in range(7, 60)]
    df = spark.createDataFrame(rows, "i int, w array<string>").withColumn("odd.name", F.lit(1)).coalesce(1)
    table = spark.createDataFrame([("a", [1]), ("b", [2, 2]), ("c", None)], "item string, value array<int>")
    value = {"a": [1], "b": [2, 2]}
    want = {i: None if r is None else [value.get(x) for x in r] for i, r in rows}
    real, paths = encode.written, []
    monkeypatch.setattr(encode, "written", lambda t, name: (paths.append(real(t, name)), paths[-1])[1])
    for size, at_once in ((1 << 22, 1 << 18), (50, 7), (1, 1)):
        monkeypatch.setattr(encode, "CHUNK", size)
        monkeypatch.setattr(encode, "AT_ONCE", at_once)
        found = encode.looked_up(df, "i", F.col("w"), table)
        assert found.columns == ["i", "w", "odd.name", "_values"]
        assert {r["i"]: r["_values"] for r in found.collect()} == want
        seen = paths.pop().groupBy("_chunk").agg(F.sum(F.size("_places")).alias("n"), F.sum(F.size("_fresh")).alias("joined"), F.count("*").alias("rows")).collect()
        assert all(r["joined"] <= 4 for r in seen) and all(r["rows"] == 1 or r["n"] <= size for r in seen if r["n"])
        assert (len(seen) == 1) == (size == 1 << 22)
        again = encode.looked_up(df, "i", F.col("w"), table, restored="w")
        assert {r["i"]: (r["w"], r["_values"]) for r in again.collect()} == {i: (r, want[i]) for i, r in rows}


def test_rows_that_share_a_key_become_one(spark):
    """As a grouping by the key makes them: the elements of all by place, none if an array is null."""
    df = spark.createDataFrame([("a", ["x", "y"]), ("a", ["y"]), ("b", None), ("b", ["x"]), (None, ["y"]), ("c", [])], "k string, w array<string>")
    table = spark.createDataFrame([("x", 1), ("y", 2)], "item string, value int")
    got = {r["k"]: r["_values"] for r in encode.looked_up(df, "k", F.col("w"), table).collect()}
    assert got == {"a": [1, 2, 2], "b": None, None: [2], "c": []}
