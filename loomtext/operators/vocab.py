"""Vocabulary tables ``(id, piece, score, is_special)``.

A vocabulary is bounded by its size parameter (32,000 by default); ``pieces_of`` checks that bound
before anything is sent to the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loomtext.functions.text import METASPACE, normalize, script_tokens

# The reserved pieces; the id of each is its place in this list.
SPECIAL_PIECES = ["<pad>", "<unk>", "<s>", "</s>"]
PAD_ID, UNK_ID, BOS_ID, EOS_ID = 0, 1, 2, 3

VOCAB_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("piece", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("is_special", T.BooleanType()),
    ]
)

MAX_PIECES = 1_000_000
# Bytes of all pieces that may be sent to every task; a piece may be a word of any length.
MAX_BYTES = 256 << 20


def token_rows(docs: DataFrame, words: Column, *keep: str) -> DataFrame:
    """One row per token. The outer explode avoids a second evaluation of ``words`` by an inferred filter."""
    return docs.select(*keep, F.explode_outer(words).alias("tok")).where(F.col("tok").isNotNull())


def token_counts(docs: DataFrame, mode: str = "whitespace") -> DataFrame:
    """``(tok, n)`` over all texts; counted per task before the shuffle, so a hot word is one row per task.

    Words between spaces are counted first and only the different ones are cut where the script changes: no token spans a space.
    """
    plain = docs.select(normalize(F.col("text"), mode).alias("_plain"))
    words = token_rows(plain, F.when(F.col("_plain") != "", F.split("_plain", " "))).groupBy("tok").agg(F.count("*").alias("n"))
    cut = script_tokens(F.concat(F.lit(METASPACE), F.col("tok")))
    return token_rows(words, cut, "n").groupBy("tok").agg(F.sum("n").alias("n"))


def special_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, p, 0.0, True) for i, p in enumerate(SPECIAL_PIECES)], VOCAB_SCHEMA)


def number_pieces(scored: DataFrame) -> DataFrame:
    """Ids after the reserved ones, by falling score, ties by piece. The input is bounded by the vocabulary size."""
    rank = F.row_number().over(Window.orderBy(F.desc("score"), "piece"))
    pieces = scored.select(
        (rank + len(SPECIAL_PIECES) - 1).cast("int").alias("id"), "piece", "score", F.lit(False).alias("is_special")
    )
    return special_rows(scored.sparkSession).unionByName(pieces)


def least_kept_count(counts: DataFrame, keep: int) -> Column:
    """Scalar subquery: a count ``c`` such that the ``keep`` most frequent tokens all have ``n >= c``.

    It reads the table of how many tokens have each count, which is small: the distinct counts of
    a text of T tokens number at most the square root of 2 T.
    """
    levels = counts.groupBy("n").agg(F.count("*").alias("tokens"))
    above = F.sum("tokens").over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1))
    return levels.withColumn("above", F.coalesce(above, F.lit(0))).where(F.col("above") < keep).agg(F.min("n")).scalar()


def frequency_vocab(counts: DataFrame, size: int = 32000) -> DataFrame:
    """The most frequent tokens with log shares as scores.

    Tokens too rare to be among them are dropped before the top-k; without that, every task would
    send its own ``size`` best to the last one. The numbering window sees at most ``size`` rows.
    """
    keep = size - len(SPECIAL_PIECES)
    frequent = counts.where(F.col("n") >= least_kept_count(counts, keep))
    top = frequent.orderBy(F.desc("n"), "tok").limit(keep)
    share = F.col("n") / F.sum("n").over(Window.partitionBy())
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "tok"))
    pieces = top.select(
        (rank + len(SPECIAL_PIECES) - 1).cast("int").alias("id"),
        F.col("tok").alias("piece"),
        F.log(share).alias("score"),
        F.lit(False).alias("is_special"),
    )
    return special_rows(counts.sparkSession).unionByName(pieces)


def char_counts(docs: DataFrame) -> DataFrame:
    """``(ch, n)`` per code point; at most as many rows as Unicode has characters."""
    return (
        docs.select(F.explode_outer(F.split(F.col("text"), "")).alias("ch"))
        .where(F.col("ch") != "")
        .groupBy("ch")
        .agg(F.count("*").alias("n"))
    )


def covering_chars(counts: DataFrame, coverage: float = 0.9995) -> DataFrame:
    """The most frequent characters that together reach ``coverage`` of the text."""
    earlier = Window.orderBy(F.desc("n"), "ch").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    total = F.sum("n").over(Window.partitionBy())
    return (
        counts.select("ch", "n", before.alias("before"), total.alias("total"))
        .where(F.col("before") < F.col("total") * F.lit(coverage))
        .drop("before", "total")
    )


class TooLarge(ValueError):
    """A vocabulary that is not to be sent to every task."""


def pieces_of(vocab: DataFrame, limit: int = MAX_PIECES) -> list[str]:
    """Pieces in id order, for a broadcast. Refuses tables beyond ``limit`` or ``MAX_BYTES`` and ids that are not 0..V-1.

    One pass over ``vocab``: a row too many or the running size stops the collection.
    """
    rows, size = [], 0
    for row in vocab.select("id", "piece").limit(limit + 1).toLocalIterator():
        size += len(row["piece"].encode())
        if size > MAX_BYTES:
            raise TooLarge(f"vocabulary pieces are longer than {MAX_BYTES} bytes together")
        rows.append(row)
    if len(rows) > limit:
        raise TooLarge(f"vocabulary has more than {limit} pieces")
    rows.sort()
    if [r["id"] for r in rows] != list(range(len(rows))):
        raise ValueError("vocabulary ids are not 0..V-1")
    return [r["piece"] for r in rows]
