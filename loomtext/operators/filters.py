"""Row filters and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions.text import strip_text, stripped_length


def keep_min_length(df: DataFrame, low: int = 50) -> DataFrame:
    """More than ``low`` code points after stripping."""
    return df.where(stripped_length(F.col("text")) > low)


def in_length_band(text: Column, low: int = 50, high: int | None = 5000) -> Column:
    """Strictly between ``low`` and ``high`` code points after stripping."""
    n = stripped_length(text)
    inside = n > low
    return inside if high is None else inside & (n < high)


def keep_length_band(df: DataFrame, low: int = 50, high: int | None = 5000) -> DataFrame:
    return df.where(in_length_band(F.col("text"), low, high))


def flag_valid(df: DataFrame, low: int = 50, high: int = 5000) -> DataFrame:
    """Stripped text and ``valid``; the text of an invalid row is blank."""
    valid = F.coalesce(in_length_band(F.col("text"), low, high), F.lit(False))
    return df.withColumn("valid", valid).withColumn(
        "text", F.when(F.col("valid"), strip_text(F.col("text"))).otherwise(F.lit(""))
    )


def guard_prompt(prompt: Column) -> Column:
    """Stripped prompt, or null where it is missing or blank."""
    stripped = strip_text(prompt)
    return F.when(F.length(stripped) > 0, stripped)


def is_reported_step(step: Column, first: int = 10, every: int = 100) -> Column:
    """The steps a run prints: the first ones and then every ``every``-th."""
    return (step <= first) | (step % every == 0)


def is_milestone(step: Column, every: int = 500) -> Column:
    return (step == 1) | (step % every == 0)
