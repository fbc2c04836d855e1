"""Guards that ride along: what a stage must satisfy is measured by the job that writes it, not by passes of its own."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from loomtext.functions.text import byte_length, lines_of


@dataclass(frozen=True)
class Watch:
    """Aggregates over the rows of a stage (without DISTINCT, which cannot be observed), and a judge of their values that raises."""

    metrics: Callable[[], list[Column]]
    judge: Callable[[dict], None] = lambda found: None


def watched(df: DataFrame, watch: Watch, write: Callable[[DataFrame], None]) -> dict:
    """``write(df)`` and the values of the metrics, measured in the same job; the judge speaks after it. Rows that a failed or repeated task saw count once."""
    seen = Observation()
    write(df.observe(seen, *watch.metrics()))
    found = dict(seen.get)
    watch.judge(found)
    return found


def corpus_watch(least_bytes: int = 1_000_000) -> Watch:
    """Texts, lines and bytes of the export of ``text``; fewer bytes than ``least_bytes`` are refused."""

    def metrics() -> list[Column]:
        text = F.col("text")
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
        return [F.count("text").alias("texts"), total(F.size(lines_of(text))).alias("lines"), total(byte_length(text) + 1).alias("bytes")]

    def judge(found: dict) -> None:
        if found["bytes"] < least_bytes:
            raise RuntimeError(f"corpus has {found['bytes']} bytes, fewer than {least_bytes}")

    return Watch(metrics, judge)


def vocab_watch(least: int = 1000, model_size: int | None = None) -> Watch:
    """Pieces and the range and sum of ids; refused are fewer than ``least`` pieces, ids that cannot be 0..V-1, and another size than the model's."""

    def metrics() -> list[Column]:
        return [F.count("*").alias("pieces"), F.min("id").alias("min_id"), F.max("id").alias("max_id"), F.sum(F.col("id").cast("bigint")).alias("id_sum")]

    def judge(found: dict) -> None:
        n = found["pieces"]
        if n < least:
            raise RuntimeError(f"vocabulary has {n} pieces, fewer than {least}")
        if (found["min_id"], found["max_id"], found["id_sum"]) != (0, n - 1, n * (n - 1) // 2):
            raise RuntimeError("vocabulary ids are not 0..V-1")
        if model_size is not None and n != model_size:
            raise ValueError(f"vocabulary size mismatch: model {model_size}, tokenizer {n}")

    return Watch(metrics, judge)


def block_watch(vocab_size: int, block_size: int | None = None) -> Watch:
    """Blocks, tokens, highest id, blocks with an id outside of the vocabulary (the first of them is named) and blocks of a wrong size; both are refused."""

    def metrics() -> list[Column]:
        top, n = F.array_max("input_ids"), F.size("input_ids")
        outside = (top >= vocab_size) | (F.array_min("input_ids") < 0)
        wrong = F.lit(False) if block_size is None else n != block_size
        return [
            F.count("*").alias("blocks"), F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("tokens"), F.max(top).alias("max_id"),
            F.count_if(outside).alias("bad_blocks"), F.min(F.when(outside, F.struct("batch", "block"))).alias("first_bad"), F.count_if(wrong).alias("wrong_size"),
        ]

    def judge(found: dict) -> None:
        if found["bad_blocks"]:
            raise ValueError(f"{found['bad_blocks']} blocks have ids outside of 0..{vocab_size - 1}; first (batch, block): {tuple(found['first_bad'])}")
        if found["wrong_size"]:
            raise ValueError(f"{found['wrong_size']} blocks are not of {block_size} tokens")

    return Watch(metrics, judge)
