"""Mix sources to target weights along a curriculum.

Every source has a target of words and a schedule of rates over training time. The schedule is integrated to the
source's cumulative demand; a document's place in its source's (repeated) stream, put into the inverse of that
demand, is the time at which it is trained on. Sorting by time gives the training order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomtext.llm.common import WORD, saved

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Words the mix takes for each word there is; the most of a source and of a document.
SHARE, CAP = 1.5, 2.0
#: Relative rate at knots of training time from 0 to 1, linear in between; the weight class that comes first fades, the last grows.
Knots = Sequence[tuple[float, float]]
SCHEDULES: tuple[Knots, ...] = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))
#: Hex digits of the hash that name a slice of a source.
DIGITS = 3


def time_of(share: Column, knots: Knots) -> Column:
    """The time at which the integrated schedule reaches ``share`` (0 to 1) of its whole."""
    areas = [(t1 - t0) * (r0 + r1) / 2 for (t0, r0), (t1, r1) in zip(knots, knots[1:], strict=False)]
    if knots[0][0] != 0 or knots[-1][0] != 1 or min(r for _, r in knots) < 0 or sum(areas) <= 0:
        raise ValueError("knots go from time 0 to 1 with rates that are not negative and not all zero")
    whole, result, reached = sum(areas), None, 0.0
    for ((t0, r0), (t1, r1)), area in zip(zip(knots, knots[1:], strict=False), areas, strict=True):
        if area > 0:
            due = share * F.lit(whole) - F.lit(reached)
            slope = (r1 - r0) / (t1 - t0)
            # due = r0 x + slope x^2 / 2, solved for x in the form without cancellation.
            root = F.sqrt(F.greatest(F.lit(r0 * r0) + F.lit(2 * slope) * due, F.lit(0.0)))
            x = F.when(due <= 0, F.lit(0.0)).otherwise(F.lit(2.0) * due / (F.lit(r0) + root))
            here = F.least(F.lit(t0) + x, F.lit(t1))
            result = here if result is None else F.when(share * F.lit(whole) > F.lit(reached), here).otherwise(result)
        reached += area
    return result


def targets(sums: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, class, target) from (source, size): water filling under the caps.

    All sources rise in proportion to their weights until they reach ``cap`` times their size. The table has one row per
    source, a list to which weights are given; it is sorted in one task.
    """
    listed = sums.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("class") + 1)
    rows = (
        listed.withColumn("place", place)
        .withColumn("class", (F.col("place") % len(weights)).cast("int"))
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * F.lit(float(cap)))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("all", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)))
    )
    order = Window.orderBy("ratio", "place")
    full = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    levels = rows.withColumn("level", (F.col("all") - full) / rest)
    below = F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "place", "level"))
    common = levels.withColumn("water", F.min(below).over(Window.partitionBy())["level"])
    return common.select(
        "source",
        "source_size",
        "class",
        F.when(F.col("ratio") <= F.col("level"), F.col("most")).otherwise(F.col("water") * F.col("weight")).alias("target"),
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP,
        schedules: Sequence[Knots] = SCHEDULES, digits: int = DIGITS) -> DataFrame:
    """``docs`` with size, source_size, target, taken and positions.

    ``size`` is the number of words (null text: 0). A source's stream is its documents in the order of a hash of their ids; the
    mix takes it as often as its target wants, the last time up to the target, a document whole or not at all: it is taken if more
    than half of it lies below the target. ``positions`` has the training times of the copies. A null source is a source, the last; of null
    ids the texts are hashed. Rows alike in id, text and size have their turns in any order, with the same result. An empty table
    gives an empty result, a source without words a target of 0. Columns of the result's names are replaced.
    """
    hashed = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.xxhash64("text").cast("string")))
    sized = (
        docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint"))
        .withColumn("__order", hashed)
        .withColumn("__slice", F.substring("__order", 1, digits))
        # Never null, so that window and join below can share one exchange of the rows.
        .withColumn("__stream", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")))
        .withColumn("__text", F.xxhash64("text"))
    )
    sums = saved(sized.groupBy("source", "__stream", "__slice").agg(F.sum("size").alias("size")), "slices")
    earlier = Window.partitionBy("__stream").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    goal = saved(targets(sums, weights, share, cap), "targets")
    starts = sums.select("source", "__stream", "__slice", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("__start"))
    per_slice = saved(
        starts.join(goal.withColumnRenamed("source", "__of"), F.col("source").eqNullSafe(F.col("__of"))).drop("__of", "source"), "starts"
    ).withColumnsRenamed({"source_size": "__total", "target": "__goal", "class": "__class"})
    inside = Window.partitionBy("__stream", "__slice").orderBy("__order", "doc_id", "size", "__text")
    running = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = (
        sized.withColumn("__before", running)
        .join(per_slice, ["__stream", "__slice"])
        .withColumn("__before", F.col("__before") + F.col("__start"))
    )
    # The start of the last, partial round through the source; an empty source has none.
    rounds = F.when(F.col("__total") > 0, F.floor(F.col("__goal") / F.col("__total"))).otherwise(F.lit(0))
    left = F.col("__goal") - F.col("__rounds") * F.col("__total")
    again = (F.col("__before") * 2 + F.col("size") < left * 2) & (F.col("__rounds") < cap)
    middle = lambda i: i * F.col("__total") + F.col("__before") + F.col("size") / F.lit(2.0)

    def moment(knots: Knots):
        return lambda copy: time_of(F.least(middle(copy) / F.col("__goal"), F.lit(1.0)), knots)

    when = F.lit(None)
    for i, knots in enumerate(schedules):
        times = F.transform(F.sequence(F.lit(0), F.col("__copies").cast("int") - 1), moment(knots))
        when = F.when(F.col("__class") % len(schedules) == i, times).otherwise(when)
    return (
        placed.withColumn("__rounds", rounds.cast("bigint"))
        .withColumn("__copies", F.when(F.col("size") > 0, F.col("__rounds") + again.cast("bigint")).otherwise(F.lit(0)))
        .withColumn("source_size", F.col("__total"))
        .withColumn("target", F.col("__goal"))
        .withColumn("taken", F.col("size") * F.col("__copies"))
        .withColumn("positions", F.when(F.col("__copies") > 0, when).otherwise(F.array().cast("array<double>")))
        .drop(*["__order", "__slice", "__text", "__before", "__stream", "__total", "__goal", "__class", "__start", "__rounds", "__copies"])
    )


def training_order(docs: DataFrame, **settings) -> DataFrame:
    """The documents in the order of training, each as often as it is taken, with the columns of ``docs`` as they are, whatever their names."""
    whole = docs.select("doc_id", "source", "text", F.struct("*").alias("document"))
    copies = mix(whole, **settings).select("doc_id", "document", F.explode("positions").alias("position"))
    return copies.repartitionByRange("position").sortWithinPartitions("position", "doc_id").select("document.*")


def in_training_order(docs: DataFrame) -> DataFrame:
    """``training_order`` as read from the files it was written to: partitions that follow each other, with their rows in order.

    A scan deals files to tasks by size. The number of a file and the row's place in it are the order in which they were written.
    """
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("bigint")
    placed = docs.select(*docs.columns, part.alias("__part"), F.col("_metadata.row_index").alias("__row"))
    return placed.repartitionByRange("__part", "__row").sortWithinPartitions("__part", "__row").drop("__part", "__row")
