"""Statistics of neighbouring tokens: counts, candidate filters, held-out loss, repetition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def pairs_of(ids: Column) -> Column:
    """Array of (prev, next): position i predicts position i + 1."""
    n = F.greatest(F.size(ids) - 1, F.lit(0))
    return F.zip_with(
        F.slice(ids, 1, n), F.slice(ids, 2, n), lambda a, b: F.struct(a.alias("prev"), b.alias("next"))
    )


def _pairs(rows: DataFrame, *keep: str) -> DataFrame:
    pairs = rows.select(*keep, F.explode_outer(pairs_of(F.col("input_ids"))).alias("p")).where(F.col("p").isNotNull())
    return pairs.select(*keep, "p.prev", "p.next")


def pair_counts(rows: DataFrame) -> DataFrame:
    """``(prev, next, n)``; pairs never cross a row."""
    return _pairs(rows).groupBy("prev", "next").agg(F.count("*").alias("n"))


def sampling_candidates(
    counts: DataFrame, temperature: float = 0.8, top_k: int = 50, top_p: float = 0.95
) -> DataFrame:
    """Next-token choices per context: temperature, then top-k, then the nucleus of mass ``top_p``.

    A window holds the successors of one context, at most the vocabulary size. Spark cuts to top-k
    in every task before the shuffle.
    """
    by_weight = Window.partitionBy("prev").orderBy(F.desc("n"), "next")
    weighted = counts.withColumn("rank", F.row_number().over(by_weight)).where(F.col("rank") <= top_k)
    weighted = weighted.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(1.0 / temperature)))
    before = F.coalesce(F.sum("w").over(by_weight.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    total = F.sum("w").over(Window.partitionBy("prev"))
    return (
        weighted.withColumn("before", before)
        .withColumn("total", total)
        .where(F.col("before") < F.lit(top_p) * F.col("total"))
        .select("prev", "next", "n", "rank", (F.col("w") / F.col("total")).alias("share"))
    )


def heldout_cross_entropy(blocks: DataFrame, vocab_size: int, alpha: float = 1.0) -> DataFrame:
    """Loss of a smoothed pair model counted on ``train`` rows and read on ``test`` rows of ``split``.

    One grouping by (prev, next) counts both sides and replaces the join of test to train; a
    frequent pair is one row per task before the shuffle. A window holds the successors of one token,
    at most the vocabulary size.
    """
    counts = _pairs(blocks, "split").groupBy("prev", "next").agg(
        F.count_if(F.col("split") == "train").alias("seen"), F.count_if(F.col("split") == "test").alias("asked")
    )
    context = counts.withColumn("context", F.sum("seen").over(Window.partitionBy("prev")))
    nll = -F.log((F.col("seen") + alpha) / (F.col("context") + alpha * vocab_size))
    loss = context.where(F.col("asked") > 0).agg(
        F.sum("asked").alias("pairs"), (F.sum(F.col("asked") * nll) / F.sum("asked")).alias("cross_entropy")
    )
    return loss.withColumn("perplexity", F.exp("cross_entropy"))


def repeated_pair_share(ids: Column) -> Column:
    """1 - distinct pairs / pairs of one text; null below two tokens. Pairs are packed into one number
    each, so that finding the distinct ones takes linear time."""
    n = F.greatest(F.size(ids) - 1, F.lit(0))
    packed = F.zip_with(
        F.slice(ids, 1, n), F.slice(ids, 2, n), lambda a, b: a.cast("bigint") * F.lit(4294967296) + b.cast("bigint")
    )
    return F.when(n > 0, 1 - F.size(F.array_distinct(packed)) / n)
