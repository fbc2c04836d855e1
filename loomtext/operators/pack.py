"""Packing token arrays into fixed-length blocks.

Documents are taken in batches of ``batch_rows`` by position. The tokens of a batch are not put in one
array: a running sum gives each document its offset, the document is cut at the block borders, and a
block collects its own pieces. So no task holds more than one document or one block at a time, and
one long document costs no more than its length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomtext.operators.order import shuffle_groups, with_position


def _batch(batch_rows: int):
    return F.expr(f"pos div {batch_rows}L").alias("batch")


def _cut(placed: DataFrame, keys: list[str], block_size: int, keep_short: bool) -> DataFrame:
    """Cut documents at block borders and put the parts of each block together.

    ``placed`` has ``pos``, ``input_ids``, their number ``n`` and ``start``, the tokens before them in the batch.
    """
    first, last = F.expr(f"start div {block_size}L"), F.expr(f"(start + n - 1) div {block_size}L")

    def fragment(block):
        low = F.greatest(block * block_size, F.col("start"))
        high = F.least((block + 1) * block_size, F.col("start") + F.col("n"))
        part = F.slice("input_ids", (low - F.col("start") + 1).cast("int"), (high - low).cast("int"))
        return F.struct(block.alias("block"), part.alias("part"))

    fragments = placed.where(F.col("n") > 0).select(
        *keys, "pos", F.inline(F.transform(F.sequence(first, last), fragment))
    )
    in_order = F.array_sort(F.collect_list(F.struct("pos", "part")))
    blocks = fragments.groupBy(*keys, "block").agg(F.flatten(F.transform(in_order, lambda x: x["part"])).alias("input_ids"))
    keep = F.size("input_ids") == block_size
    if keep_short:
        keep = keep | (F.col("block") == 0)
    return blocks.where(keep).select("batch", "block", "input_ids", F.col("input_ids").alias("labels"))


def pack_blocks(docs: DataFrame, block_size: int = 1024, batch_rows: int = 2000, keep_short: bool = False) -> DataFrame:
    """``docs(pos, input_ids)`` to ``(batch, block, input_ids, labels)``.

    The remainder of a batch is dropped. With ``keep_short`` a batch with less than one block of
    tokens gives one short block instead of none. The window and the grouping by (batch, block)
    share one shuffle.
    """
    earlier = Window.partitionBy("batch").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        docs.where(F.size("input_ids") > 0)
        .select(_batch(batch_rows), "pos", "input_ids", F.size("input_ids").cast("bigint").alias("n"))
        .withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    )
    return _cut(placed, ["batch"], block_size, keep_short)


def pack_shuffled(
    docs: DataFrame, block_size: int = 1024, batch_rows: int = 2000, keep_short: bool = False, seed: int = 42,
    row_id: str = "row_id",
) -> DataFrame:
    """``pack_blocks`` in seeded order, with one shuffle of the ids for order, batches and blocks together.

    Rows are partitioned into runs of whole batches. Inside a run, in key order, running sums give
    the position, the tokens so far, and the tokens up to the start of the current batch.
    """
    order = Window.partitionBy("_group").orderBy("_key")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.coalesce(F.size("input_ids"), F.lit(0)).cast("bigint")
    counted = (
        shuffle_groups(docs, batch_rows, seed, row_id)
        .withColumn("n", F.greatest(size, F.lit(0)))
        .withColumn("_rank", F.row_number().over(order))
        .withColumn("_ahead", F.sum("n").over(so_far) - F.col("n"))
        .withColumn("pos", F.col("_group") * F.col("_step") + F.col("_rank") - 1)
    )
    begins = F.when(F.col("pos") % batch_rows == 0, F.col("_ahead"))
    placed = counted.withColumn("start", F.col("_ahead") - F.max(begins).over(so_far)).select(
        "_group", _batch(batch_rows), "pos", "input_ids", "n", "start"
    )
    return _cut(placed, ["_group", "batch"], block_size, keep_short)


def packing_loss(docs: DataFrame, block_size: int = 1024, batch_rows: int = 2000) -> DataFrame:
    """Per batch: tokens, full blocks, tokens dropped. Needs ``docs(pos, n)`` only, no arrays."""
    return docs.groupBy(_batch(batch_rows)).agg(F.sum("n").alias("tokens")).select(
        "batch",
        "tokens",
        F.expr(f"tokens div {block_size}L").alias("blocks"),
        (F.col("tokens") % block_size).alias("dropped"),
    )


def number_blocks(blocks: DataFrame, buckets: int = 4096) -> DataFrame:
    """Add the dense ``block_id`` of saved blocks. Reads them repeatedly, so call it on a written table."""
    highest = blocks.agg(F.max("batch")).first()[0] or 0
    return with_position(blocks, ["batch", "block"], F.expr(f"batch div {highest // buckets + 1}L"), "block_id")


def block_totals(blocks: DataFrame) -> DataFrame:
    return blocks.agg(
        F.count("*").alias("blocks"), F.coalesce(F.sum(F.size("input_ids")), F.lit(0)).cast("bigint").alias("tokens")
    )
