"""Sums over a folder of files that is added to: what each file gives is kept, and only new or changed files are read again."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.sources.corpus import files_below

FILE = "_file"


def _spelled(path: Column, encoded: bool) -> Column:
    """One spelling of a path, whether or not special characters are percent-encoded and whatever slashes follow the scheme."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))) if encoded else path
    return F.regexp_replace(plain, "^([^:/]+):/+", "$1:/")


def _kept(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows below ``path``, none if nothing was written yet."""
    names = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = names.getFileSystem(spark._jsc.hadoopConfiguration()).exists(names)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def refreshed_sums(
    spark: SparkSession, source: str, root: str, rows_of: Callable[[DataFrame], DataFrame], keys: dict[str, str], sums: list[str],
    read: Callable[[list[str]], DataFrame] | None = None,
) -> DataFrame:
    """The ``sums`` (whole numbers) by ``keys`` (name to type) of ``rows_of`` over the Parquet files below ``source``.

    ``rows_of`` takes the rows of the files and keeps their column ``_file``. What one file gives is summed by its keys, written below ``root`` and
    never computed again while name, size and time of the file stay; a changed file counts as a new one, and what an old or removed file gave is left out, as it is not
    in the listing any more. A file is noted after its sums are written, so an attempt that failed is made again and replaces its own rows.
    The driver sees the names of the new files, as any reader does.
    """
    listed = ", ".join(f"{n} {t}" for n, t in keys.items())
    parts = f"{FILE} string, {listed}, {', '.join(f'{s} bigint' for s in sums)}" if keys else f"{FILE} string, {', '.join(f'{s} bigint' for s in sums)}"
    name = F.sha2(F.concat_ws("\n", "path", F.col("length").cast("string"), F.col("at").cast("string")), 256)
    present = files_below(spark, source).select("path", name.alias("name"))
    noted = _kept(spark, f"{root}/noted", "name string")
    fresh = sorted(map(tuple, present.join(noted, "name", "left_anti").collect()), key=lambda r: r[0])
    if fresh:
        batch = hashlib.sha256("\n".join(n for n, _ in fresh).encode()).hexdigest()[:16]
        named = spark.createDataFrame(fresh, f"{FILE} string, path string").select(FILE, _spelled(F.col("path"), False).alias("_path"))
        paths = [p for _, p in fresh]
        rows = (read or (lambda files: spark.read.parquet(*files)))(paths).withColumn("_path", _spelled(F.col("_metadata.file_path"), True))
        given = rows_of(rows.join(F.broadcast(named), "_path").drop("_path"))
        given.groupBy(FILE, *keys).agg(*[F.sum(s).cast("bigint").alias(s) for s in sums]).write.mode("overwrite").parquet(f"{root}/sums/batch={batch}")
        named.select(F.col(FILE).alias("name")).write.mode("overwrite").parquet(f"{root}/noted/batch={batch}")
    kept = _kept(spark, f"{root}/sums", parts)
    here = kept.join(present.select(F.col("name").alias(FILE)), FILE, "left_semi")
    return here.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])
