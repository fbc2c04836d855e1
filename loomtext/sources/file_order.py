"""The order rows have in their files: places without a numeric id, a sort or a shuffle of rows.

A file's rows are counted from its footer; the files follow each other by path, the rows by their place in the file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FILE, PLACE = "_metadata.file_path", "_metadata.row_index"


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """``(file, rows, start)``: the rows of each Parquet file below ``path`` and of all files before it. One row per file, numbered in one task."""
    counted = spark.read.parquet(path).groupBy(F.col(FILE).alias("file")).agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    return counted.withColumn("start", F.coalesce(before, F.lit(0)).cast("bigint"))


def file_positions(spark: SparkSession, path: str, out: str = "pos") -> DataFrame:
    """The rows below ``path`` with their place from 0. Only the small table of files is joined; an input column named ``out`` is replaced."""
    starts = file_starts(spark, path).select(F.col("file").alias("_file"), F.col("start").alias("_start"))
    rows = spark.read.parquet(path)
    kept = [c for c in rows.columns if c != out]
    placed = rows.select(*[F.col(f"`{c}`") for c in kept], F.col(FILE).alias("_file"), F.col(PLACE).alias("_place"))
    return placed.join(starts, "_file").withColumn(out, F.col("_start") + F.col("_place")).drop("_file", "_start", "_place")


def first_rows(spark: SparkSession, path: str, percent: float) -> DataFrame:
    """The first ``percent`` of the rows below ``path`` in the order of files, half a row rounding up.

    The cut is a file and a place in it, both literals: files behind it are not opened, and the one it lies in is read up to there.
    """
    starts = file_starts(spark, path)
    rows = spark.read.parquet(path)
    total = starts.agg(F.sum("rows")).first()[0] or 0
    wanted = int(total * percent / 100 + 0.5)
    last = starts.where(F.col("start") < wanted).agg(F.max(F.struct("start", "file"))).first()[0]
    if last is None:
        return rows.where(F.lit(False))
    inside = (F.col(FILE) < last["file"]) | (F.col(PLACE) < wanted - last["start"])
    return rows.where((F.col(FILE) <= last["file"]) & inside)
