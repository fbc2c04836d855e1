"""Checks over whole tables. ``require_*`` raise; the others return what they found."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.functions.text import byte_length, lines_of, stripped_length


def corpus_size(docs: DataFrame, last_newline: bool = True) -> DataFrame:
    """Bytes and lines of the newline-separated export, without writing it; the newline after the
    last text may be left out."""
    size = F.coalesce(F.sum(byte_length(F.col("text")) + 1), F.lit(0))
    return docs.agg(
        (size if last_newline else F.greatest(size - 1, F.lit(0))).cast("bigint").alias("bytes"),
        F.coalesce(F.sum(F.size(lines_of(F.col("text")))), F.lit(0)).cast("bigint").alias("lines"),
        F.count("text").alias("texts"),
    )


def require_corpus_bytes(docs: DataFrame, least: int = 1_000_000) -> int:
    size = corpus_size(docs).first()["bytes"]
    if size < least:
        raise RuntimeError(f"corpus has {size} bytes, fewer than {least}")
    return size


def vocab_summary(vocab: DataFrame) -> DataFrame:
    return vocab.agg(
        F.count("*").alias("pieces"),
        F.count_distinct("id").alias("distinct_ids"),
        F.count_distinct("piece").alias("distinct_pieces"),
        F.max("id").alias("max_id"),
        F.sum(F.col("is_special").cast("bigint")).alias("special"),
    )


def require_vocab(vocab: DataFrame, least: int = 1000) -> int:
    found = vocab_summary(vocab).first()
    if found["pieces"] < least:
        raise RuntimeError(f"vocabulary has {found['pieces']} pieces, fewer than {least}")
    if not found["pieces"] == found["distinct_ids"] == found["distinct_pieces"] == found["max_id"] + 1:
        raise RuntimeError("vocabulary ids or pieces are not unique")
    return found["pieces"]


def require_same_vocab_size(model_size: int, vocab: DataFrame) -> None:
    size = vocab.count()
    if size != model_size:
        raise ValueError(f"vocabulary size mismatch: model {model_size}, tokenizer {size}")


def model_fit(vocab: DataFrame, sizes: list[int]) -> DataFrame:
    """(model_size, pieces, fits): the size of the vocabulary held against those of models."""
    listed = F.array(*[F.lit(n).cast("bigint") for n in sizes])
    counted = vocab.agg(F.count("*").alias("pieces")).select(F.explode(listed).alias("model_size"), "pieces")
    return counted.withColumn("fits", F.col("model_size") == F.col("pieces"))


def token_range(blocks: DataFrame, vocab_size: int) -> DataFrame:
    """Highest id and the number of blocks with an id outside the vocabulary, over all blocks."""
    top = F.array_max("input_ids")
    return blocks.agg(
        F.count("*").alias("blocks"), F.max(top).alias("max_id"), F.count_if(top >= vocab_size).alias("bad_blocks")
    )


def token_range_offenders(blocks: DataFrame, vocab_size: int, first: int = 5) -> DataFrame:
    """The first blocks whose highest id is outside the vocabulary."""
    bad = blocks.select("batch", "block", F.array_max("input_ids").alias("max_id"))
    return bad.where(F.col("max_id") >= vocab_size).orderBy("batch", "block").limit(first)


def require_token_range(blocks: DataFrame, vocab_size: int) -> None:
    found = token_range(blocks, vocab_size).first()
    if found["bad_blocks"]:
        where = [tuple(r) for r in token_range_offenders(blocks, vocab_size).collect()]
        raise ValueError(f"{found['bad_blocks']} blocks have ids >= {vocab_size}; first (batch, block, id): {where}")


def block_shape(blocks: DataFrame, block_size: int) -> DataFrame:
    n = F.size("input_ids")
    return blocks.agg(
        F.count("*").alias("blocks"),
        F.min(n).alias("min_size"),
        F.max(n).alias("max_size"),
        F.count_if(n != block_size).alias("wrong_size"),
        F.count_if(~F.col("input_ids").eqNullSafe(F.col("labels"))).alias("wrong_labels"),
    )


def retention(docs: DataFrame, low: int = 50, high: int = 5000) -> DataFrame:
    """Per source: texts, and how many of them the length filters keep, in one pass."""
    n = stripped_length(F.col("text"))
    return docs.groupBy("source_ds").agg(
        F.count("*").alias("texts"),
        F.count_if(n > low).alias("min_length"),
        F.count_if((n > low) & (n < high)).alias("in_band"),
    )


def source_counts(docs: DataFrame) -> DataFrame:
    """Texts per source and in total (``source_ds`` null). The rollup runs on the counts, not on the texts."""
    counts = docs.groupBy("source_ds").agg(F.count("*").alias("n"))
    return counts.rollup("source_ds").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("texts"))


def run_size(
    totals: DataFrame, batch_size: int, accumulation: int, gpus: int, block_size: int = 1024, epochs: int = 2
) -> DataFrame:
    """Steps, tokens per update and warmup that a number of blocks leads to."""
    effective = batch_size * accumulation * gpus
    per_epoch = F.expr(f"blocks div {effective}L")
    total = per_epoch * epochs
    return totals.select(
        "blocks",
        F.lit(effective).cast("bigint").alias("effective_batch"),
        F.lit(effective * block_size).cast("bigint").alias("tokens_per_update"),
        per_epoch.alias("steps_per_epoch"),
        total.alias("total_steps"),
        F.least(F.lit(500).cast("bigint"), F.floor(total / 10)).alias("warmup_steps"),
    )
