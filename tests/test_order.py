import hashlib

import pytest
from pyspark.sql import functions as F

from loomtext.operators import order, sample


def ids(spark, n, parts=4):
    return spark.range(n).select(F.concat(F.lit("a:"), F.col("id").cast("string")).alias("row_id"), "id").repartition(parts)


def shuffled(n, seed=42):
    names = [f"a:{i}" for i in range(n)]
    return sorted(names, key=lambda x: (hashlib.md5(f"{seed}:{x}".encode()).hexdigest(), x))


@pytest.mark.parametrize("parts", [1, 4, 7])
@pytest.mark.parametrize("digits", [1, 4])
def test_shuffled_positions(spark, parts, digits):
    got = order.shuffled_positions(ids(spark, 500, parts), digits=digits).orderBy("pos").collect()
    assert [r["pos"] for r in got] == list(range(500))
    assert [r["row_id"] for r in got] == shuffled(500)


def test_shuffle_depends_on_seed(spark):
    rows = [r["row_id"] for r in order.seeded_shuffle(ids(spark, 100), 7).collect()]
    assert rows == shuffled(100, 7) != shuffled(100)


@pytest.mark.parametrize("values", [
    list(range(300)),
    [0, 1, 2, 10**12, 10**12 + 1, 10**15] + list(range(-50, 0)),
    [i * 10**9 for i in range(20)] + list(range(5, 400)),
    [-(2**62), 0, 2**62],
    [7],
])
def test_source_positions_and_ranks(spark, values):
    values = sorted(set(values))
    df = spark.createDataFrame([(v,) for v in values], "k long").repartition(5)
    got = {r["k"]: r["pos"] for r in order.source_positions(df, "k", bucket_rows=20).collect()}
    assert got == {v: i for i, v in enumerate(values)}
    for rank in {1, 2, len(values) // 2, len(values)} - {0}:
        if rank <= len(values):
            assert order.value_at_rank(df, "k", rank, bins=8) == values[rank - 1]
    assert order.value_at_rank(df, "k", 0) is None


def test_value_at_rank_with_one_hot_value(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 77).otherwise(F.col("id")).alias("k"))
    want = sorted(r["k"] for r in df.collect())
    assert [order.value_at_rank(df, "k", r, bins=4) for r in (1, 400, 401, 1000)] == [want[0], want[399], want[400], want[999]]


@pytest.mark.parametrize("n", [0, 1, 99, 100, 199, 1000])
def test_sample_sizes(spark, n):
    df = ids(spark, n)
    for size in (0, 1, 100, 5000):
        got = sorted(r["row_id"] for r in sample.exact_sample(df, size).collect())
        assert got == sorted(shuffled(n)[:size])
    picked = [r["id"] for r in sample.systematic_sample(df.select("id"), "id").collect()] if n else []
    assert sorted(picked) == list(range(0, n, max(1, n // 100)))


@pytest.mark.parametrize("n,test", [(1, 1), (49, 1), (50, 1), (51, 2), (1000, 20)])
def test_split_is_disjoint_and_exact(spark, n, test):
    rows = sample.train_test_split(ids(spark, n)).collect()
    assert sorted(r["row_id"] for r in rows if r["split"] == "test") == sorted(shuffled(n)[:test])
    assert len(rows) == n and {r["split"] for r in rows} <= {"train", "test"}


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_holdouts(spark, parts):
    df = ids(spark, 60, parts)
    train, held = sample.random_holdout(df, 10)
    assert sorted(r["row_id"] for r in held.collect()) == sorted(shuffled(60)[:10])
    assert sorted(r["row_id"] for r in train.collect()) == sorted(shuffled(60)[10:])
    overlap, _ = sample.random_holdout(df, 10, exclude_from_train=False)
    assert overlap.count() == 60
    train, held = sample.random_holdout(df, 100)
    assert (train.count(), held.count()) == (0, 60)
    assert [r["id"] for r in sample.head_holdout(df, ["id"], 3).collect()] == [0, 1, 2]


@pytest.mark.parametrize("n,percent,kept", [(100, 10, 10), (5, 10, 1), (4, 10, 0), (15, 10, 2), (0, 10, 0), (10, 100, 10)])
def test_prefix_slice(spark, n, percent, kept):
    df = spark.range(n).select((F.col("id") * 3).alias("doc_id")).repartition(3)
    assert sorted(r["doc_id"] for r in sample.prefix_slice(df, percent, "doc_id").collect()) == [3 * i for i in range(kept)]


def test_prefix_slice_pushes_the_cut_to_the_scan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    plan = sample.prefix_slice(docs, 10, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(doc_id" in plan


def test_select_positions_and_sentences(spark):
    wanted = spark.createDataFrame([(0,), (3,), (3,), (99,)], "pos long")
    got = sample.select_positions(order.shuffled_positions(ids(spark, 10)), wanted).collect()
    assert sorted(r["row_id"] for r in got) == sorted([shuffled(10)[0], shuffled(10)[3]])
    docs = spark.createDataFrame([("d", "ab\n\näö"), ("e", None), ("f", "")], "row_id string, text string")
    rows = {(r["row_id"], r["line_no"]): r["sentence"] for r in sample.sentences(docs).collect()}
    assert rows == {("d", 0): "ab", ("d", 1): "", ("d", 2): "äö", ("f", 0): ""}
    assert sample.sentences(docs, max_bytes=3).count() == 3
    assert sample.sample_sentences(docs, 2).count() == 2
