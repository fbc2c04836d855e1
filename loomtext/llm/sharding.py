"""Histogram sort: exact splitters by counting below candidate keys, then one exchange.

Every round counts, in one pass over a narrow table, the exact bytes below a list of candidate keys,
and narrows the interval of each splitter that is not yet within tolerance. No sample is taken and
nothing but the counts of at most ``PROBES`` candidates (or one per splitter) comes to the driver.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomtext.llm.common import saved

#: Candidate keys of a round.
PROBES = 4096
#: Bytes of a range, the unit that is sorted in one task.
RANGE_BYTES = 128 << 20


def order_key(first: Column, second: Column) -> Column:
    """Whole number that orders by ``first``, then by the 63 low bits of ``second``.

    Both are bigint; null sorts first. A key with a third of all rows can so be cut by the second.
    """
    low = F.coalesce(second.cast("bigint"), F.lit(0)).bitwiseAND(F.lit(2**63 - 1)).cast("decimal(19,0)")
    high = F.coalesce(first.cast("bigint"), F.lit(-(2**63))).cast("decimal(20,0)")
    return (high * F.lit(Decimal(2**63)) + low).cast("decimal(38,0)")


def count_below(key: str, borders: Sequence[int]) -> Column:
    """How many of the sorted ``borders`` are at most ``key``: a binary search inside the row."""
    if not borders:
        return F.lit(0)
    n = len(borders)
    listed = f"cast(split('{','.join(map(str, borders))}', ',') as array<decimal(38,0)>)"
    steps = ",".join(str(1 << i) for i in reversed(range(n.bit_length())))
    return F.expr(
        f"aggregate(array({steps}), 0, (p, s) -> "
        f"if(p + s <= {n} AND element_at({listed}, least(p + s, {n})) <= `{key}`, p + s, p))"
    )


def splitters(keyed: DataFrame, targets: Sequence[float], tolerance: float, key: str = "__key", size: str = "__size") -> list[int]:
    """For every target the key below which the sizes add up to it, within ``tolerance`` or as near as keys allow.

    A candidate that falls between two keys next to each other can come no nearer; the nearer one is taken.
    """
    low, high, total = keyed.agg(F.min(key), F.max(key), F.sum(size)).first()
    if low is None:
        return []
    start = (int(low), 0, int(high) + 1, int(total))
    spans = dict.fromkeys(range(len(targets)), start)
    found: dict[int, int] = {}
    while True:
        for i, (a, below_a, b, below_b) in list(spans.items()):
            off_a, off_b = abs(targets[i] - below_a), abs(targets[i] - below_b)
            if min(off_a, off_b) <= tolerance or b - a <= 1:
                found[i] = a if off_a <= off_b else b
                del spans[i]
        if not spans:
            return [found[i] for i in range(len(targets))]
        open_spans = set(spans.values())
        fan = max(2, PROBES // len(open_spans))
        probes = sorted({a + (b - a) * j // fan for a, _, b, _ in open_spans for j in range(1, fan)} - {s[0] for s in open_spans})
        counts = keyed.groupBy(count_below(key, probes).alias("slot")).agg(F.sum(size).alias("n")).collect()
        per_slot = {r["slot"]: int(r["n"]) for r in counts}
        below, running = [], 0
        for i in range(len(probes)):
            running += per_slot.get(i, 0)
            below.append(running)
        for i, (a, below_a, b, below_b) in spans.items():
            at = bisect_left(probes, a + 1)
            while at < len(probes) and probes[at] < b:
                if below[at] <= targets[i]:
                    a, below_a = probes[at], below[at]
                else:
                    b, below_b = probes[at], below[at]
                    break
                at += 1
            spans[i] = (a, below_a, b, below_b)


def histogram_sort(
    df: DataFrame,
    first: Column,
    second: Column,
    size: Column,
    shards: int,
    tolerance: float = 0.001,
    range_bytes: int = RANGE_BYTES,
    shares: Sequence[float] | None = None,
) -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (long): ``df`` sorted by (first, second) and cut into shards of equal bytes.

    ``size`` is a row's bytes. The borders are exact: a shard's bytes differ from the mean by at most
    ``tolerance`` of the mean at either end, or by what the rows that share one key weigh. A shard is sorted as
    several ranges of about ``range_bytes``; ``slot`` counts the shard's rows from 0 without gaps.

    ``shares`` names other targets: the size below each of the inner borders. Null keys sort first and null sizes count 0. Rows alike in both keys stay in one shard. An empty table
    gives an empty result; an input column named ``shard`` or ``slot`` is replaced.
    """
    keyed = df.withColumn("__key", order_key(first, second)).withColumn("__size", F.coalesce(size.cast("bigint"), F.lit(0)))
    narrow = saved(keyed.select("__key", "__size"), "histogram")
    total = narrow.agg(F.sum("__size")).first()[0] or 0
    per_shard = max(1, math.ceil(total / shards / range_bytes))
    shard_targets = shares if shares is not None else [total * i / shards for i in range(1, shards)]
    borders = sorted(splitters(narrow, shard_targets, tolerance / 2 * total / shards))
    inner = [total * i / (shards * per_shard) for i in range(1, shards * per_shard) if i % per_shard]
    cuts = sorted({*borders, *splitters(narrow, inner, 0.1 * total / (shards * per_shard))})
    # A range's shard: borders at or below its first key.
    shard_of = [bisect_right(borders, c) for c in [-(10**38), *cuts]]
    rows = {r["r"]: r["n"] for r in narrow.groupBy(count_below("__key", cuts).alias("r")).agg(F.count("*").alias("n")).collect()}
    starts, running = [], 0
    for r, shard in enumerate(shard_of):
        running = running if r and shard == shard_of[r - 1] else 0
        starts.append(running)
        running += rows.get(r, 0)
    rank = F.row_number().over(Window.partitionBy("__range").orderBy("__key"))
    return (
        keyed.withColumn("__range", count_below("__key", cuts))
        .withColumn("shard", lookup("__range", shard_of, "int"))
        .withColumn("slot", lookup("__range", starts, "bigint") + rank - F.lit(1))
        .drop("__key", "__size", "__range")
    )


def lookup(index: str, values: list[int], kind: str) -> Column:
    """The value at the number in the column ``index``, from a list of bounded length."""
    listed = f"cast(split('{','.join(map(str, values))}', ',') as array<{kind}>)"
    return F.expr(f"element_at({listed}, `{index}` + 1)")


def shard_documents(docs: DataFrame, shards: int = 16, tolerance: float = 0.001) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot``: shards of near equal bytes in content order.

    The order is that of the text's hash, then of doc_id: copies lie side by side, topics and sources are mixed,
    and a text that fills more than a shard is cut by doc_id. ``size`` is the text's UTF-8 bytes plus 1 (null: 1).
    """
    sized = docs.withColumn("size", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint"))
    content = F.xxhash64(F.coalesce("text", F.lit("")))
    return histogram_sort(sized, content, F.col("doc_id"), F.col("size"), shards, tolerance)
