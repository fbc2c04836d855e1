"""Nearest neighbours by a block matrix join.

Vectors are rounded to one byte a component. A tile of asked vectors and rows is one product of byte matrices, and what rounding
can have changed is bounded by the norms of the residuals; only pairs whose upper bound reaches the k-th best score so far are
computed again from the original components, and heaps of k rows are merged. The result is exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomtext.llm.common import saved
from loomtext.llm.tiles import LEAST, PAIRS, PANE_ASKED, PANE_ROWS, RESIDENT, Heaps, ids_of, matrix, panes, tiled, usable

FOUND = "asked long, score double, vec_id long, row long"
#: Components whose products float32 adds up exactly: 1024 x 127 x 127 < 2^24.
EXACT = 1_024


def norms(vectors: np.ndarray) -> np.ndarray:
    """Norms of the rows; the largest component is taken out, so tiny ones do not vanish when squared."""
    most = np.abs(vectors).max(axis=1, keepdims=True)
    return most[:, 0] * np.linalg.norm(vectors / np.where(most > 0, most, 1), axis=1)


class Rounded:
    """Vectors as bytes with a scale each, and the norms that bound what rounding loses."""

    def __init__(self, vectors: np.ndarray) -> None:
        most = np.abs(vectors).max(axis=1)
        self.scale = most / 127
        with np.errstate(all="ignore"):
            steps = np.where(self.scale[:, None] > 0, vectors / self.scale[:, None], 0)
        self.bytes = np.clip(np.rint(np.nan_to_num(steps)), -127, 127).astype(np.int8)
        near = self.bytes * self.scale[:, None]
        self.lost, self.near = norms(vectors - near), norms(near)
        self.norm = self.near + self.lost

    def product(self, mine: slice, other: Rounded, theirs: slice) -> np.ndarray:
        """Products of the bytes, exact whole numbers: float32 holds the sums of 1,024 components."""
        a, b = self.bytes[mine], other.bytes[theirs]
        total = 0
        for part in panes(a.shape[1], EXACT):
            total = total + (a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T).astype(np.float64)
        return total

    def bounds(self, mine: slice, other: Rounded, theirs: slice) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the inner products."""
        about = self.product(mine, other, theirs) * (self.scale[mine, None] * other.scale[None, theirs])
        off = self.lost[mine, None] * other.norm[None, theirs] + self.near[mine, None] * other.lost[None, theirs]
        off += 1e-12 * self.norm[mine, None] * other.norm[None, theirs] + 1e-300  # what doubles round
        return about - off, about + off


class Nearest:
    """The ``k`` rows with the largest inner product for each asked vector of one tile."""

    def __init__(self, asked: pa.Table, k: int) -> None:
        self.k, self.row = k, asked.column("row").to_numpy()
        self.vectors = matrix(asked.column("vector"))
        self.rounded, self.columns = Rounded(self.vectors), np.ascontiguousarray(self.vectors.T)
        self.best = Heaps(len(self.row), k, np.float64)

    def add(self, rows: pa.RecordBatch) -> None:
        vectors, row = matrix(rows.column("vector")), rows.column("row").to_numpy()
        rounded, columns, (ids, unnamed) = Rounded(vectors), np.ascontiguousarray(vectors.T), ids_of(rows.column("vec_id"))
        with np.errstate(all="ignore"):
            for theirs in panes(len(row), PANE_ROWS):
                for mine in panes(len(self.row), PANE_ASKED):
                    of, at = self._survivors(mine, rounded, theirs, row)
                    for part in panes(len(of), PAIRS):
                        self._compare(of[part] + mine.start, at[part] + theirs.start, columns, ids, unnamed, row)

    def _survivors(self, mine: slice, rounded: Rounded, theirs: slice, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs whose upper bound reaches the k-th best score, or the k-th lower bound of this pane (one more: the own row is among them)."""
        lower, upper = self.rounded.bounds(mine, rounded, theirs)
        bar = self.best.least()[mine]
        if lower.shape[1] > self.k:
            at = lower.shape[1] - self.k - 1
            sure = np.partition(lower, at, axis=1)[:, at]
            bar = np.where(sure > bar, sure, bar)
        stays = ~(upper < bar[:, None]) & (self.row[mine, None] != row[None, theirs])  # a bound that overflowed rules nothing out
        return np.nonzero(stays)

    def _compare(self, of: np.ndarray, at: np.ndarray, columns: np.ndarray, ids: np.ndarray, unnamed: np.ndarray, row: np.ndarray) -> None:
        score = np.zeros(len(of))
        for mine, theirs in zip(self.columns, columns, strict=True):  # in the order of the components, as anyone would add them
            score += mine[of] * theirs[at]
        bar = self.best.least()[of]
        kept = ~(score < bar)
        self.best.add(of[kept], score[kept], ids[at[kept]], unnamed[at[kept]], row[at[kept]])

    def result(self) -> pa.Table:
        at, score, ids, row = self.best.entries()
        return pa.table([pa.array(self.row[at]), pa.array(score), ids, pa.array(row)], ["asked", "score", "vec_id", "row"])


def nearest(embeddings: DataFrame, asked: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", resident: int = RESIDENT, least: int = LEAST) -> DataFrame:
    """The ``k`` rows nearest to each row that ``asked`` (a condition on the id column) picks: query_id, rank, vec_id, score.

    Nearness is the inner product in doubles, added in the order of the components; ties go to the smaller vec_id, a null id last. Every row but the
    query's own is a candidate; all are returned if there are fewer. Vectors that are null, empty, zero or hold a null or
    non-finite component take no part, and vectors of different length do not meet. Rows alike in every column are rows of their own: each such
    query returns its list, and a list names each of them. A score beyond doubles is infinite or, ranked last, NaN. Other columns are not read, whatever
    their names; an empty table gives an empty result. ``resident`` and ``least`` size the tiles and change no result.
    """
    picked = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(asked, F.lit(False)).alias("asked"))
    good = picked.where(usable("vector") & F.exists("vector", lambda x: x != 0)).withColumn("dim", F.size("vector"))
    rows = saved(good.withColumn("row", F.monotonically_increasing_id()), "vectors")
    queries = rows.where("asked").drop("asked", "vec_id")
    found = tiled(queries, rows.drop("asked"), lambda of: Nearest(of, k), FOUND, resident, least)
    order = [F.isnan("score"), F.desc("score"), F.asc_nulls_last("vec_id"), "row"]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("asked").orderBy(*order))).where(F.col("rank") <= k)
    names = rows.where("asked").select(F.col("row").alias("asked"), F.col("vec_id").alias("query_id"))
    return ranked.join(names, "asked").select("query_id", "rank", "vec_id", "score")
