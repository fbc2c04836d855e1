"""Row order without a global sort in one task.

Two tools. ``with_position`` gives every row its dense position: rows are bucketed by a monotone
function of their order, each bucket is numbered on its own, and the small table of bucket sizes
supplies the offsets. ``cut_key`` finds only the key at a wanted rank, so a sample or split becomes a
filter over the scan and no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Hex digits of the hash that name a bucket: 16**4 = 65,536 buckets, the bound on every bucket table.
BUCKET_DIGITS = 4


def shuffle_key(row_id: Column, seed: int = 42) -> Column:
    """Key whose order is the seeded shuffle: the hash, then the id itself to make ties impossible.

    It depends on the seed and the id alone, so any partitioning gives the same order.
    """
    text = row_id.cast("string")
    return F.concat(F.md5(F.concat(F.lit(f"{seed}:"), text)), text)


def hash_bucket(key: Column, digits: int = BUCKET_DIGITS) -> Column:
    return F.substring(key, 1, digits)


def offsets(sizes: DataFrame, bucket: str, size: str) -> DataFrame:
    """Add ``before``, the sum of all earlier buckets, to a bounded table of bucket sizes."""
    earlier = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("before", F.coalesce(F.sum(size).over(earlier), F.lit(0)))


def with_position(df: DataFrame, order: list[str], bucket: Column, out: str = "pos") -> DataFrame:
    """Add the 0-based position in ``order``.

    ``bucket`` must not decrease along ``order`` and should have a bounded number of values. The join
    with the bucket starts has the key of the window, so it costs no second shuffle of the rows;
    whether the starts are broadcast is left to Spark, which knows their size by then.
    """
    tagged = df.withColumn("_bucket", bucket)
    sizes = tagged.groupBy("_bucket").agg(F.count("*").alias("_n"))
    starts = offsets(sizes, "_bucket", "_n").select("_bucket", "before")
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    return (
        tagged.withColumn("_rank", rank)
        .join(starts, "_bucket")
        .withColumn(out, (F.col("before") + F.col("_rank") - 1).cast("bigint"))
        .drop("_bucket", "_rank", "before")
    )


def shuffled_positions(df: DataFrame, seed: int = 42, row_id: str = "row_id", digits: int = BUCKET_DIGITS) -> DataFrame:
    """Seeded shuffle as a column: ``pos`` is the place of the row in the shuffled corpus."""
    keyed = df.withColumn("_key", shuffle_key(F.col(row_id), seed))
    return with_position(keyed, ["_key"], hash_bucket(F.col("_key"), digits)).drop("_key")


def shuffle_groups(df: DataFrame, rows: int, seed: int = 42, row_id: str = "row_id", groups: int = 65536) -> DataFrame:
    """Add ``_key``, ``_group`` and ``_step``: the seeded shuffle cut into at most about ``groups`` runs of ``_step`` rows.

    ``_step`` is a multiple of ``rows``, so a batch of ``rows`` consecutive rows never spans two groups,
    and whoever partitions by ``_group`` needs no second shuffle for batches. The borders come from
    a pass over the keys alone: the key of every ``_step``-th row, found per hash bucket. The table
    that is broadcast has one row per bucket and one key per group, whatever the size of ``df``.
    """
    keyed = df.withColumn("_key", shuffle_key(F.col(row_id), seed)).withColumn("_bucket", hash_bucket(F.col("_key")))
    keys = keyed.select("_key", "_bucket")
    sizes = offsets(keys.groupBy("_bucket").agg(F.count("*").alias("_n")), "_bucket", "_n")
    total = F.sum("_n").over(Window.partitionBy())
    table = sizes.select("_bucket", "before", (F.ceil(total / (rows * groups)) * rows).alias("_step"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_key"))
    firsts = (
        keys.withColumn("_rank", rank)
        .join(F.broadcast(table), "_bucket")
        .where((F.col("before") + F.col("_rank") - 1) % F.col("_step") == 0)
        .groupBy("_bucket")
        .agg(F.collect_list("_key").alias("_firsts"))
    )
    borders = table.join(firsts, "_bucket", "left").select(
        "_bucket",
        "_step",
        # Groups that began in earlier buckets, less one: the number of the group the bucket starts in.
        (F.ceil(F.col("before") / F.col("_step")) - 1).alias("_base"),
        F.coalesce("_firsts", F.array().cast("array<string>")).alias("_firsts"),
    )
    begun = F.size(F.filter("_firsts", lambda k: k <= F.col("_key")))
    return (
        keyed.join(F.broadcast(borders), "_bucket")
        .withColumn("_group", F.col("_base") + begun)
        .drop("_bucket", "_base", "_firsts")
    )


def seeded_shuffle(df: DataFrame, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """Rows physically in shuffled order (a range-partitioned sort)."""
    return df.orderBy(shuffle_key(F.col(row_id), seed))


def source_positions(df: DataFrame, column: str, out: str = "pos", bucket_rows: int = 200_000) -> DataFrame:
    """Positions in the order of a unique number column, however unevenly its values are spread.

    The bucket borders are quantiles of the column (one pass over that column), so all buckets hold about
    ``bucket_rows`` rows, however many there are; at most 65,536 borders come back.
    """
    buckets = min(65_536, max(16, df.count() // bucket_rows))
    borders = df.select(F.col(column).cast("double").alias(column)).approxQuantile(
        column, [i / buckets for i in range(1, buckets)], 0.25 / buckets
    )
    splits = [float("-inf"), *sorted(set(borders)), float("inf")]
    tagged = Bucketizer(splits=splits, inputCol="_value", outputCol="_slot").transform(
        df.withColumn("_value", F.col(column).cast("double"))
    )
    return with_position(tagged, [column], F.col("_slot"), out).drop("_value", "_slot")


def cut_key(df: DataFrame, key: Column, take: Callable[[Column], Column], digits: int = BUCKET_DIGITS) -> Column:
    """Scalar subquery: the key of rank ``take(n)`` (1-based) among the ``n`` rows of ``df``.

    Counts per bucket show which bucket holds the rank; only the keys of that bucket are sorted.
    ``key`` must be a unique hash key as made by ``shuffle_key``. A rank of zero gives null.
    """
    keys = df.select(key.alias("key")).withColumn("bucket", hash_bucket(F.col("key"), digits))
    sizes = keys.groupBy("bucket").agg(F.count("*").alias("n"))
    wanted = take(F.sum("n").over(Window.partitionBy())).cast("bigint")
    hit = (
        offsets(sizes, "bucket", "n")
        .withColumn("wanted", wanted)
        .where((F.col("wanted") > F.col("before")) & (F.col("wanted") <= F.col("before") + F.col("n")))
        .select("bucket", (F.col("wanted") - F.col("before")).alias("rank"))
    )
    inside = keys.join(F.broadcast(hit), "bucket")
    ranked = inside.withColumn("at", F.row_number().over(Window.partitionBy("bucket").orderBy("key")))
    return ranked.where(F.col("at") == F.col("rank")).select("key").scalar()


def value_at_rank(df: DataFrame, column: str, rank: int, bins: int = 4096) -> int | None:
    """The ``rank``-th smallest value (1-based) of a whole-number column.

    A histogram of at most ``bins`` + 2 counts narrows the value range, again and again, until one
    value is left: about three passes over one column for 10**10 rows, of which the later ones skip
    most row groups. No sort, no group larger than a counter.
    """
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None or rank < 1:
        return None
    while low < high:
        width = (high - low) // bins + 1
        # Division rounded down, also for negative values.
        slot = F.expr(f"(`{column}` - pmod(`{column}`, {width}L)) div {width}L")
        counts = df.where(F.col(column).between(low, high)).groupBy(slot.alias("slot")).count()
        for slot_no, n in sorted((r["slot"], r["count"]) for r in counts.collect()):
            if rank <= n:
                low, high = max(low, slot_no * width), min(high, (slot_no + 1) * width - 1)
                break
            rank -= n
        else:
            return None
    return low
