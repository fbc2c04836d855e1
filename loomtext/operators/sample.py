"""Samples, slices and splits. All are exact and do not depend on the partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.functions.text import byte_length, lines_of
from loomtext.operators.filters import keep_length_band
from loomtext.operators.order import cut_key, shuffle_key, source_positions, value_at_rank


def prefix_slice(df: DataFrame, percent: float, column: str) -> DataFrame:
    """First ``percent`` of the rows in source order, half a row rounding up.

    ``column`` numbers the rows uniquely. The cut is a literal, so the scan gets it as a pushed filter.
    """
    wanted = int(df.count() * percent / 100 + 0.5)
    cut = value_at_rank(df, column, wanted)
    return df.where(F.lit(False)) if cut is None else df.where(F.col(column) <= cut)


def exact_sample(df: DataFrame, size: int, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """``min(size, n)`` rows without replacement: the first ones of the seeded shuffle."""
    key = shuffle_key(F.col(row_id), seed)
    return df.where(key <= cut_key(df, key, lambda n: F.least(F.lit(size), n)))


def sample_then_filter(df: DataFrame, size: int, low: int = 50, high: int | None = 5000, seed: int = 42) -> DataFrame:
    """Sample first, filter second: the result may hold fewer than ``size`` rows."""
    return keep_length_band(exact_sample(df, size, seed), low, high)


def train_test_split(df: DataFrame, test_share: float = 0.02, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """Add ``split``: the first ceil(share * n) rows of the shuffle are ``test``, the others ``train``."""
    key = shuffle_key(F.col(row_id), seed)
    cut = cut_key(df, key, lambda n: F.ceil(n * F.lit(test_share)))
    return df.withColumn("split", F.when(key <= cut, F.lit("test")).otherwise(F.lit("train")))


def random_holdout(
    df: DataFrame, size: int = 1000, seed: int = 42, row_id: str = "row_id", exclude_from_train: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(train, held out). With ``exclude_from_train=False`` the train side keeps the held-out rows."""
    key = shuffle_key(F.col(row_id), seed)
    cut = cut_key(df, key, lambda n: F.least(F.lit(size), n))
    held = df.where(key <= cut)
    return (df.where(F.coalesce(key > cut, F.lit(True))) if exclude_from_train else df), held


def head_holdout(df: DataFrame, order: list[str], size: int = 1000) -> DataFrame:
    """The first ``size`` rows in a unique order, of a saved table.

    Only the order columns are sorted, to find the last row to keep; the rows themselves stay where
    they are.
    """
    place = F.struct(*order)
    first = df.select(place.alias("place")).orderBy("place").limit(size)
    return df.where(place <= first.agg(F.max("place")).scalar())


def systematic_sample(df: DataFrame, column: str, target: int = 100) -> DataFrame:
    """Every max(1, n // target)-th row from the first one on, in the order of ``column``."""
    stride = max(1, df.count() // target)
    return source_positions(df, column).where(F.col("pos") % stride == 0)


def select_positions(positioned: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose ``pos`` is in the index list ``wanted(pos)``."""
    return positioned.join(wanted.select("pos"), "pos", "left_semi")


def sentences(corpus: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``(row_id, line_no, sentence)``, without sentences longer than ``max_bytes`` of UTF-8."""
    # The outer form keeps Spark from evaluating the split a second time to look for empty arrays.
    rows = corpus.select("row_id", F.posexplode_outer(lines_of(F.col("text"))).alias("line_no", "sentence"))
    rows = rows.where(F.col("sentence").isNotNull())
    return rows.where(byte_length(F.col("sentence")) <= max_bytes) if max_bytes else rows


def sample_sentences(corpus: DataFrame, size: int, max_bytes: int | None = None, seed: int = 42) -> DataFrame:
    """At most ``size`` sentences, chosen by seeded shuffle."""
    rows = sentences(corpus, max_bytes).withColumn("line_id", F.concat_ws(":", "row_id", F.col("line_no").cast("string")))
    return exact_sample(rows, size, seed, "line_id")
