"""Ordered computations over long series.

A window per run puts a run in one task, and a log may be one run. Here a run is cut into spans of
the order column. Each span leaves one row in a summary; the last value of all earlier spans is
carried into the span by an equi-join, and the window works inside a span only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Order values per span; with one row per order value this is also the rows per window.
SPAN = 100_000
# Spans that are carried over together. Where there are more, they are put together in groups of as many, and these again.
FAN = 1000


def _carried(tails: DataFrame, partition: list[str], fan: int, depth: int) -> DataFrame:
    """Add ``_carry`` to (partition, _span, _tail): the last tail of all earlier spans of the partition.

    A window holds ``fan`` spans; what came before them is carried in from the spans put together, in the same way.
    """
    if not depth:
        earlier = Window.partitionBy(*partition).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
        return tails.withColumn("_carry", F.last("_tail", ignorenulls=True).over(earlier)).drop("_tail")
    grouped = tails.withColumn("_group", F.expr(f"_span div {fan}L"))
    last = F.max_by("_tail", F.when(F.col("_tail").isNotNull(), F.col("_span")))
    above = grouped.groupBy(*partition, F.col("_group").alias("_span")).agg(last.alias("_tail"))
    before = _carried(above, partition, fan, depth - 1).withColumnsRenamed({"_span": "_group", "_carry": "_before"})
    earlier = Window.partitionBy(*partition, "_group").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    return (
        grouped.join(before, [*partition, "_group"], "left")
        .withColumn("_carry", F.coalesce(F.last("_tail", ignorenulls=True).over(earlier), F.col("_before")))
        .drop("_tail", "_group", "_before")
    )


def last_known(
    df: DataFrame,
    value: Column,
    order: list[str],
    out: str,
    partition: list[str] | None = None,
    inclusive: bool = True,
    span: int = SPAN,
    fan: int = FAN,
) -> DataFrame:
    """Add ``out``: the latest non-null ``value`` at or before each row (before it, if not ``inclusive``).

    ``order`` starts with a whole-number column, and together its columns have no ties. Partition
    columns are not null. A first look at the range of the order column tells in how many levels the spans are carried.
    """
    partition = partition or []
    tagged = df.withColumn("_value", value).withColumn("_span", F.expr(f"`{order[0]}` div {span}L"))
    groups = [*partition, "_span"]
    # A plain number as the ordering keeps the grouping hash-based; a struct would make it sort.
    place = F.struct(*order) if len(order) > 1 else F.col(order[0])
    first, last = df.agg(F.min(F.expr(f"`{order[0]}` div {span}L")), F.max(F.expr(f"`{order[0]}` div {span}L"))).first()
    depth, spans = 0, (last - first + 1 if first is not None else 1)
    while spans > fan ** (depth + 1):
        depth += 1
    tails = tagged.groupBy(*groups).agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), place)).alias("_tail"))
    carried = _carried(tails, partition, fan, depth)
    end = Window.currentRow if inclusive else -1
    inside = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    # The join and the window have the same keys, so the rows are shuffled once.
    return (
        tagged.join(carried, groups, "left")
        .withColumn(out, F.coalesce(F.last("_value", ignorenulls=True).over(inside), F.col("_carry")))
        .drop("_value", "_span", "_carry")
    )
