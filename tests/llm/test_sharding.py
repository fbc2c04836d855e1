from collections import Counter, defaultdict

from pyspark.sql import functions as F

from loomtext.llm import sharding
from tests.llm.fixtures import empty_documents, odd_documents, with_clashes


def sizes(rows):
    total = Counter()
    for r in rows:
        total[r["shard"]] += r["size"]
    return total


def gapless(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    return all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_are_even_and_slots_gapless(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab "), (F.col("id") % 50).cast("int")).alias("text"))
    rows = sharding.shard_documents(docs, shards=7).collect()
    total = sum(r["size"] for r in rows)
    assert len(rows) == 5000 and gapless(rows)
    assert all(abs(n - total / 7) <= 152 + 0.001 * total / 7 for n in sizes(rows).values())


def test_one_text_that_fills_most_shards_is_cut_by_id(spark):
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same text").alias("text"))
    rest = spark.range(3000, 3100).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    rows = sharding.shard_documents(hot.union(rest), shards=10, tolerance=0.01).collect()
    assert len(sizes(rows)) == 10 and max(sizes(rows).values()) <= 1.05 * sum(sizes(rows).values()) / 10
    assert gapless(rows)


def test_many_ranges_per_shard_keep_the_order(spark):
    df = spark.range(2000).select("id", (F.col("id") * 37 % 2000).alias("k"))
    rows = sharding.histogram_sort(df, F.col("k"), F.lit(0), F.lit(10), 3, range_bytes=1000).collect()
    ordered = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["k"] for r in ordered] == list(range(2000)) and gapless(rows)


def test_exact_shares_of_rows(spark):
    df = spark.range(1000).select((F.col("id") * F.col("id")).alias("k"))
    rows = sharding.histogram_sort(df, F.col("k"), F.lit(0), F.lit(1), 4, tolerance=0.0, shares=[300, 600, 900]).collect()
    assert Counter(r["shard"] for r in rows) == {0: 300, 1: 300, 2: 300, 3: 100}


def test_splitters_reach_the_ends_of_the_key_range(spark):
    df = spark.createDataFrame([(-(2**63),), (-1,), (0,), (2**63 - 1,), (None,)], "k bigint")
    rows = sharding.histogram_sort(df, F.col("k"), F.lit(None), F.lit(1), 5).collect()
    assert [r["k"] for r in sorted(rows, key=lambda r: r["shard"])] in (
        [None, -(2**63), -1, 0, 2**63 - 1], [-(2**63), None, -1, 0, 2**63 - 1])


def test_odd_rows_and_clashing_columns(spark):
    docs = with_clashes(odd_documents(spark))
    rows = sharding.shard_documents(docs, shards=4)
    assert set(rows.columns) == set(docs.columns)
    found = rows.collect()
    assert len(found) == docs.count() and gapless(found)
    assert all(r["size"] == len((r["text"] or "").encode()) + 1 for r in found)


def test_empty_table(spark):
    assert sharding.shard_documents(empty_documents(spark)).collect() == []
