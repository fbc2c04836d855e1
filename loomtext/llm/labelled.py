"""Labelled examples for fitting: a bounded, reproducible sample that leaves the held-out rows alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int, max_bytes: int) -> list[tuple[int, str, int]]:
    """At most ``rows`` examples of each class 0 and 1 as (doc_id, whole text, class), in the order of a hash of the id.

    ``usable`` says which ids may be learnt from. The ids are chosen from the labels alone and are at most 2 x ``rows``, so the
    scan for their texts joins with a list of bounded size. Texts over ``max_bytes`` are left out whole, never cut.
    """
    order = F.md5(F.col("doc_id").cast("string"))
    wanted = labels.where(usable & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("__class"))
    chosen = None
    for one in (0, 1):
        part = wanted.where(F.col("__class") == one).orderBy(order, "doc_id").limit(rows)
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select("doc_id", "text").where(F.octet_length("text").between(1, max_bytes))
    found = texts.join(F.broadcast(chosen), "doc_id").orderBy(order, "doc_id", "text").limit(2 * rows)
    return [(r["doc_id"], r["text"], r["__class"]) for r in found.collect()]


def split_half(rows: list) -> tuple[list, list]:
    """Alternate rows, separately in each class: one half builds the model, the other calibrates it."""
    first, second = [], []
    for one in (0, 1):
        same = [r for r in rows if r[2] == one]
        first += same[::2]
        second += same[1::2]
    return first, second
