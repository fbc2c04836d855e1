"""A stated set of vectors compared with all vectors, tile by tile: the frame of the searches in ``neighbours`` and ``negatives``.

The asked vectors are dealt to groups of bounded size, all vectors to slabs. A task takes one group, keeps it in memory and lets
one slab stream past, so its memory depends on the group alone; every asked vector has a bounded list of best rows
(a heap) per slab, and only those lists leave the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Asked vectors a task keeps, and rows below which a slab is not worth a task of its own.
RESIDENT, LEAST = 65_536, 8_192
#: Asked vectors times streamed rows whose scores are in memory at a time.
PANE_ASKED, PANE_ROWS = 2_048, 1_024
#: Pairs compared exactly at a time.
PAIRS = 1 << 17


class Search(Protocol):
    """What a task does with one group of asked vectors of one length."""

    def add(self, rows: pa.RecordBatch) -> None: ...

    def result(self) -> pa.Table: ...


def usable(vector: str | Column) -> Column:
    """Whether a vector exists, is not empty and has finite components only."""
    v = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False))


def tiled(asked: DataFrame, rows: DataFrame, begin: Callable[[pa.Table], Search], schema: str, resident: int = RESIDENT, least: int = LEAST) -> DataFrame:
    """The results of ``begin`` for every tile of ``asked`` and ``rows``.

    Both have ``row`` (a unique number) and ``dim`` (the length of the vector); only equal lengths meet. Every other column
    reaches the search. Groups hold about ``resident`` asked vectors; the rows are cut into so many slabs that there are
    tiles for all cores, none of less than about ``least`` rows.
    """
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    groups = max(1, -(-asked.count() // resident))
    slabs = max(1, min(-(-rows.count() // least), -(-tasks // groups)))
    place = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    ours = asked.select("*", every(slabs).alias("slab")).withColumn("tile", place(groups) * slabs + F.col("slab"))
    theirs = rows.select("*", every(groups).alias("group")).withColumn("tile", F.col("group") * slabs + place(slabs))
    dealt = ours.drop("slab").withColumn("side", F.lit(0)).unionByName(theirs.drop("group").withColumn("side", F.lit(1)), allowMissingColumns=True)
    dealt = dealt.repartitionById(groups * slabs, F.col("tile")).sortWithinPartitions("tile", "dim", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting, search = None, [], None
        for batch in batches:
            marks = np.stack([batch.column(n).to_numpy() for n in ("tile", "dim", "side")], axis=1)
            cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1), len(marks)]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                if start == end:
                    continue
                tile, dim, side = map(int, marks[start])
                if (tile, dim) != key:
                    if search is not None:
                        yield from search.result().to_batches()
                    key, waiting, search = (tile, dim), [], None
                piece = batch.slice(start, end - start)
                if side == 0:
                    waiting.append(piece)
                    continue
                if search is None and waiting:
                    search, waiting = begin(pa.Table.from_batches(waiting)), []
                if search is not None:
                    search.add(piece)
        if search is not None:
            yield from search.result().to_batches()

    return dealt.mapInArrow(run, schema)


def matrix(column: pa.ChunkedArray | pa.Array, dtype: type = np.float64) -> np.ndarray:
    """Lists of one length as a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(flat), -1)


def panes(rows: int, step: int) -> Iterator[slice]:
    return (slice(at, min(rows, at + step)) for at in range(0, rows, step))


class Heaps:
    """The ``k`` best rows of each of ``n`` lists: the largest score first, ties to the smaller id (null last), then the smaller row."""

    def __init__(self, n: int, k: int, dtype: type) -> None:
        self.k = k
        self.score, self.filled = np.zeros((n, k), dtype), np.zeros((n, k), bool)
        self.id, self.unnamed, self.row = np.zeros((n, k), np.int64), np.zeros((n, k), bool), np.zeros((n, k), np.int64)

    def least(self) -> np.ndarray:
        """The score that a row must reach: that of the last in a full list."""
        return np.where(self.filled[:, -1], self.score[:, -1].astype(np.float64), -np.inf)

    def add(self, of: np.ndarray, score: np.ndarray, ids: np.ndarray, unnamed: np.ndarray, row: np.ndarray) -> None:
        if not len(of):
            return
        touched = np.unique(of)
        old = self.filled[touched]
        lists = np.concatenate([np.repeat(touched, old.sum(axis=1)), of])
        both = lambda mine, new: np.concatenate([mine[touched][old], new])
        score, ids, unnamed, row = both(self.score, score), both(self.id, ids), both(self.unnamed, unnamed), both(self.row, row)
        order = np.lexsort((row, ids, unnamed, -score, lists))
        lists = lists[order]
        place = np.arange(len(lists)) - np.searchsorted(lists, lists)
        kept = place < self.k
        lists, place, order = lists[kept], place[kept], order[kept]
        self.filled[touched] = False
        self.filled[lists, place] = True
        self.score[lists, place], self.id[lists, place] = score[order], ids[order]
        self.unnamed[lists, place], self.row[lists, place] = unnamed[order], row[order]

    def entries(self) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """Of all entries: list, score, id, row."""
        at, place = np.nonzero(self.filled)
        ids = pa.array(self.id[at, place], mask=self.unnamed[at, place], type=pa.int64())
        return at, self.score[at, place], ids, self.row[at, place]


def ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and which of them are null."""
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), column.is_null().to_numpy(zero_copy_only=False)
