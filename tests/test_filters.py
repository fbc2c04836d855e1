from pyspark.sql import functions as F

from loomtext.operators import checks, filters


def docs(spark, texts):
    return spark.createDataFrame([(str(i), "a", t) for i, t in enumerate(texts)], "row_id string, source_ds string, text string")


EDGES = ["x" * n for n in (0, 49, 50, 51, 4999, 5000, 5001)] + [" " * 60, "　" * 60, " " + "x" * 50 + "\n", None, "智" * 51]


def ids(df):
    return sorted(int(r["row_id"]) for r in df.collect())


def test_bounds_are_strict(spark):
    df = docs(spark, EDGES)
    assert ids(filters.keep_min_length(df)) == [3, 4, 5, 6, 11]
    assert ids(filters.keep_length_band(df)) == [3, 4, 11]
    assert ids(filters.keep_length_band(df, 50, None)) == [3, 4, 5, 6, 11]


def test_flag(spark):
    got = {int(r["row_id"]): (r["valid"], r["text"]) for r in filters.flag_valid(docs(spark, [*EDGES, " " + "y" * 51 + " "])).collect()}
    assert got[12] == (True, "y" * 51)
    assert all(got[i] == (False, "") for i in (0, 1, 2, 5, 6, 7, 8, 9, 10))


def test_prompt_guard(spark):
    df = spark.createDataFrame([(0, None), (1, ""), (2, " 　"), (3, " hi \n")], "i int, p string")
    assert [r[0] for r in df.orderBy("i").select(filters.guard_prompt(F.col("p"))).collect()] == [None, None, None, "hi"]


def test_reported_steps(spark):
    steps = spark.range(0, 1001)
    got = [r[0] for r in steps.where(filters.is_reported_step(F.col("id"))).orderBy("id").collect()]
    assert got == list(range(11)) + list(range(100, 1001, 100))
    got = [r[0] for r in steps.where(filters.is_milestone(F.col("id"))).orderBy("id").collect()]
    assert got == [0, 1, 500, 1000]


def test_retention_and_counts(spark):
    df = docs(spark, EDGES).unionByName(docs(spark, ["z" * 60]).withColumn("source_ds", F.lit("b")))
    got = {r["source_ds"]: (r["texts"], r["min_length"], r["in_band"]) for r in checks.retention(df).collect()}
    assert got == {"a": (12, 5, 3), "b": (1, 1, 1)}
    assert {r["source_ds"]: r["texts"] for r in checks.source_counts(df).collect()} == {"a": 12, "b": 1, None: 13}
