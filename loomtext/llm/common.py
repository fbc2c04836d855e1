"""Helpers the operators share: text normalisation, intermediate tables, the choice of one row per key."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.session import scratch_path

#: Words are runs of anything but these six ASCII characters.
WORD = r"[^\x20\x09-\x0D]+"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with a table that survives lost executors; rows and names made by the job are
    fixed from here on. The cluster's cleaner of that folder removes the tables.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. ``translate`` walks code points, so pure ASCII text takes the short way."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of all columns that have one; rows alike in every column have the same."""
    names = [f.name for f in df.schema if not _has_map(f.dataType)]
    return F.xxhash64(*[F.col(f"`{n}`") for n in names])


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, (T.MapType, T.VariantType))


def keep_rows(docs: DataFrame, winners: DataFrame, row_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` named by ``winners`` (id, hash, copies), each once.

    ``hash`` is ``row_hash(docs)``, ``copies`` how many rows share id and hash. Only where rows repeat
    in every column are they grouped again; the usual case is one semi-join.
    """
    winners = winners.select(F.col(row_id).alias("__id"), F.col("hash").alias("__hash"), F.col("copies").alias("__copies"))
    keyed = docs.withColumn("__row", row_hash(docs))

    def matched(some: DataFrame) -> DataFrame:
        same = keyed[row_id].eqNullSafe(some["__id"]) & (keyed["__row"] == some["__hash"])
        return keyed.join(some, same, "left_semi")

    once = matched(winners).drop("__row")
    repeated = winners.where("__copies > 1")
    if repeated.isEmpty():
        return once
    single = matched(winners.where("__copies = 1")).drop("__row")
    return single.unionByName(matched(repeated).dropDuplicates([row_id, "__row"]).drop("__row"))
