"""Bands, rows addressed on disk, and sums that follow the files."""

import math
import random

import pytest
from pyspark.sql import functions as F

from loomtext.operators.bands import band_join
from loomtext.sources import indexed
from loomtext.sources.incremental import refreshed_sums


@pytest.mark.parametrize("closed", [False, True])
def test_band_join_against_all_pairs(spark, closed):
    rng = random.Random(6)
    values = [None, math.nan, math.inf, -math.inf, 0.0, 5.0, 5.0, *(round(rng.uniform(-20, 40), 1) for _ in range(300)), *[7.0] * 100]
    bands = [("all", None, None), ("low", None, 5.0), ("high", 5.0, None), ("point", 7.0, 7.0), ("wrong", 9.0, 3.0), ("far", 1e6, 2e6), ("below", -1e6, -30.0)]
    bands += [(f"b{i}", lo := round(rng.uniform(-30, 50), 1), lo + rng.choice([0.5, 3.0, 30.0])) for i in range(40)]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    found = band_join(rows, "v", spark.createDataFrame(bands, "band string, low double, high double"), closed=closed, bins=64)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    below = lambda v, hi: hi is None or (v <= hi if closed else v < hi)
    inside = lambda v, lo, hi: (lo is None or hi is None or lo <= hi) and (lo is None or v >= lo) and below(v, hi)
    want = [(i, b) for i, v in enumerate(values) if v is not None and not math.isnan(v) for b, lo, hi in bands if inside(v, lo, hi)]
    assert sorted((r["i"], r["band"]) for r in found.collect()) == sorted(want)


def test_band_join_of_nothing(spark):
    rows, bands = spark.createDataFrame([], "v double"), spark.createDataFrame([("a", 1.0, 2.0)], "band string, low double, high double")
    assert band_join(rows, "v", bands).count() == 0
    assert band_join(spark.createDataFrame([(1.0,)], "v double"), "v", bands.limit(0)).count() == 0


def test_rows_are_read_from_their_files_only(spark, tmp_path):
    path = str(tmp_path / "all blocks")
    rows = spark.range(1000).select((F.col("id") * 3).alias("block_id"), F.md5(F.col("id").cast("string")).alias("ids"))
    rows = rows.union(spark.createDataFrame([(None, "none")], "block_id long, ids string"))
    indexed.save_indexed(rows, path, "block_id", files=8, row_group=1024)
    every = spark.read.parquet(f"{path}.index")
    assert every.count() == 8 and every.agg(F.sum("rows")).first()[0] == 1001
    wanted = spark.createDataFrame([(30,), (31,), (33,), (33,), (None,), (2997,), (10**12,)], "key long")
    found = indexed.rows_at(spark, path, "block_id", wanted)
    assert sorted(r["block_id"] for r in found.collect()) == [30, 33, 2997]
    assert len(indexed.files_with(spark, path, wanted)) == 2
    scans = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in line and "ids" in line]
    assert len(found.inputFiles()) == 2 and all("PushedFilters" in line for line in scans)
    one = indexed.rows_at(spark, path, "block_id", spark.createDataFrame([(600,)], "key long"))
    assert len(one.inputFiles()) == 1 and [r["ids"] for r in one.collect()] == [rows.where("block_id = 600").first()["ids"]]
    assert indexed.rows_at(spark, path, "block_id", wanted.where("key = 31")).count() == 0
    assert indexed.rows_at(spark, path, "block_id", wanted.where("key = 10")).columns == ["block_id", "ids"]


def test_sums_follow_added_changed_and_removed_files(spark, tmp_path):
    source, root, read = tmp_path / "in", str(tmp_path / "kept"), []

    def put(name, texts):
        spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).write.mode("overwrite").parquet(str(source / name))

    def reading(paths):
        read.append(len(paths))
        return spark.read.parquet(*paths)

    def sums():
        rows = lambda df: df.select("_file", F.explode(F.split("text", " ")).alias("w"), F.lit(1).alias("n"), F.length("text").alias("c"))
        return {r["w"]: r["n"] for r in refreshed_sums(spark, str(source), root, rows, {"w": "string"}, ["n", "c"], reading).collect()}

    put("a b%20ä", ["x y", "x"])
    put("b", ["y z"])
    put("c", [])
    assert sums() == {"x": 2, "y": 2, "z": 1} and read == [sum(1 for _ in source.rglob("*.parquet"))]
    assert sums() == {"x": 2, "y": 2, "z": 1} and len(read) == 1  # nothing is new, nothing is read
    put("d", ["new x"])
    assert sums() == {"x": 3, "y": 2, "z": 1, "new": 1} and read[1:] == [1]
    put("b", ["z z longer"])
    assert sums() == {"x": 3, "y": 1, "z": 2, "new": 1, "longer": 1} and read[2:] == [1]
    for file in (source / "a b%20ä").rglob("*"):
        file.unlink()
    assert sums() == {"x": 1, "z": 2, "new": 1, "longer": 1} and len(read) == 3
