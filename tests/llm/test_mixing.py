import hashlib
import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loomtext.llm import mixing
from tests.llm.fixtures import empty_documents, odd_documents, odd_rows, with_clashes


def words(text):
    return len((text or "").encode().split())


def water(sizes, share=1.5, cap=2.0, weights=(5, 2, 1)):
    """Targets by resharing the excess, again and again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free = dict.fromkeys(names, 0.0), set(names)
    rest = share * sum(sizes.values())
    while free:
        level = rest / sum(weight[s] for s in free)
        full = {s for s in free if cap * sizes[s] <= level * weight[s]}
        if not full:
            return target | {s: level * weight[s] for s in free}
        for s in full:
            target[s] = cap * sizes[s]
            rest -= target[s]
        free -= full
    return target


def test_targets_and_taken_words_against_brute_force(spark):
    rows = mixing.mix(with_clashes(odd_documents(spark))).collect()
    sizes = defaultdict(int)
    for r in odd_rows():
        sizes[r[3]] += words(r[1])
    target = water(sizes)
    assert len(rows) == len(odd_rows())
    taken, longest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["size"] == words(r["text"]) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] <= 2 * r["size"] and len(r["positions"]) * r["size"] == r["taken"]
        assert all(0 <= p <= 1 for p in r["positions"]) and r["positions"] == sorted(r["positions"])
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 + 1e-6 for s in sizes)


def test_reruns_agree_on_any_partitioning(spark):
    docs = odd_documents(spark)
    pick = lambda d: sorted(map(str, mixing.mix(d).select("doc_id", "size", "taken", "positions").collect()))
    assert pick(docs) == pick(docs.repartition(11, "text"))


@pytest.mark.parametrize("knots", [[(0, 1), (1, 1)], [(0, 1.5), (1, 0.5)], [(0, 0), (1, 2)], [(0, 2), (0.5, 0), (1, 3)], [(0, 0), (0.3, 0), (1, 1)]])
def test_times_invert_the_integrated_schedule(spark, knots):
    def demand(t):
        area = 0.0
        for (t0, r0), (t1, r1) in zip(knots, knots[1:], strict=False):
            x = min(max(t, t0), t1) - t0
            area += r0 * x + (r1 - r0) / (t1 - t0) * x * x / 2
        return area

    df = spark.range(1, 101).select((F.col("id") / 100).alias("u"))
    for r in df.select("u", mixing.time_of(F.col("u"), knots).alias("t")).collect():
        assert 0 <= r["t"] <= 1 and math.isclose(demand(r["t"]), r["u"] * demand(1), abs_tol=1e-9)


def test_schedules_must_cover_the_time():
    with pytest.raises(ValueError):
        mixing.time_of(F.lit(0.5), [(0, 1), (0.9, 1)])


def test_order_follows_the_curriculum(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 10).alias("text"), F.concat(F.lit("s"), F.col("id") % 3).alias("source")
    )
    ordered = mixing.training_order(docs)
    assert ordered.columns == docs.columns
    rows = [r["source"] for r in ordered.collect()]
    half = len(rows) // 2
    early = rows[:half].count("s0") / rows.count("s0")
    late = rows[:half].count("s2") / rows.count("s2")
    assert len(rows) == 6000 and early > 0.55 and late < 0.45


def test_hash_order_is_that_of_md5(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("one").alias("text"), F.lit("only").alias("source"))
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs, share=0.5).collect()}
    first = sorted(range(50), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())[:25]
    assert {i for i, n in taken.items() if n} == set(first)


def test_empty_tables_and_sources_without_words(spark):
    assert mixing.mix(empty_documents(spark)).collect() == []
    assert mixing.training_order(empty_documents(spark)).collect() == []
    blank = spark.createDataFrame([(1, None, None), (2, "  ", "a")], "doc_id bigint, text string, source string")
    assert [(r["taken"], r["target"], r["positions"]) for r in mixing.mix(blank).collect()] == [(0, 0.0, [])] * 2


def test_training_order_keeps_the_users_columns(spark):
    docs = odd_documents(spark).selectExpr("*", "77 AS size", "'t' AS target", "'p' AS positions", "1 AS position", "'x' AS __start", "2 AS document", "3L AS source_size")
    rows = mixing.training_order(docs)
    assert rows.columns == docs.columns and rows.schema == docs.schema
    assert {(r["size"], r["target"], r["positions"], r["__start"], r["document"]) for r in rows.collect()} == {(77, "t", "p", "x", 2)}


def test_null_ids_are_spread_over_the_order(spark):
    docs = spark.range(600).selectExpr("IF(id % 3 = 0, NULL, id) AS doc_id", "concat('word ', id) AS text", "'one' AS source")
    from pyspark.sql import functions as F

    slices = docs.where("doc_id IS NULL").select(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.xxhash64("text").cast("string"))), 1, 3).alias("s"))
    assert slices.distinct().count() > 150
    assert sum(r["taken"] for r in mixing.mix(docs).collect()) == 1800
