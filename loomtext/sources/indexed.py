"""Rows addressed by a number on disk: sorted files with an index of the numbers each holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.operators.bands import band_join

#: Bytes of a row group; a reader skips those whose range of keys it does not need.
ROW_GROUP = 8 << 20


def save_indexed(df: DataFrame, path: str, key: str, files: int | None = None, row_group: int = ROW_GROUP) -> None:
    """Write ``df`` by ranges of the whole-number ``key`` (a null one is in no range and is never found), sorted in each file, and ``<path>.index`` with a row per file."""
    spark = df.sparkSession
    dealt = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    dealt.sortWithinPartitions(key).write.option("parquet.block.size", row_group).parquet(path)
    saved = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file"), F.col(key).cast("bigint").alias("key"))
    ranges = saved.groupBy("file").agg(F.min("key").alias("first"), F.max("key").alias("last"), F.count("*").alias("rows"))
    ranges.where("first IS NOT NULL").write.parquet(f"{path}.index")


def files_with(spark: SparkSession, path: str, wanted: DataFrame) -> list[str]:
    """The files that may hold a number of ``wanted(key)``, by the index alone; not more than there are files."""
    index = spark.read.parquet(f"{path}.index").select("file", "first", "last")
    held = band_join(wanted.select("key"), "key", index, "first", "last", closed=True)
    return [f"{path}/{r['file']}" for r in held.select("file").distinct().orderBy("file").collect()]


def rows_at(spark: SparkSession, path: str, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``key`` is in ``wanted(key)``: only files that may hold one are read, and of these only row groups within the range asked for.

    A number that is asked for twice gives its rows once; one that is not there gives none.
    """
    asked = wanted.select(F.col("key").cast("bigint").alias("key")).where("key IS NOT NULL").distinct()
    schema = spark.read.parquet(path).schema
    files = files_with(spark, path, asked)
    if not files:
        return spark.createDataFrame([], schema)
    low, high = asked.agg(F.min("key"), F.max("key")).first()
    found = spark.read.schema(schema).parquet(*files).where(F.col(key).between(low, high))
    return found.join(asked, found[key] == asked["key"], "left_semi")
