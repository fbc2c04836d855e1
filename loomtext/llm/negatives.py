"""Hard negatives by segment summaries.

Every vector keeps the mean and the deviation of its segments. Over one segment of n components an inner product is n times
the product of the means, give or take n times the product of the deviations; summed over the segments this bounds a score. Coarse segments
are tried first, finer ones on what they leave, and only what no bound rules out is scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomtext.llm.common import saved
from loomtext.llm.tiles import LEAST, PAIRS, PANE_ASKED, PANE_ROWS, RESIDENT, Heaps, ids_of, matrix, panes, tiled, usable

#: Numbers of segments, coarse to fine.
LEVELS = (4, 16)
#: Share of a pane's pairs above which one matrix product is cheaper than picking the pairs out.
DENSE = 0.125
FOUND = "asked long, score long, vec_id long, row long"
MINED = "asked long, positive long, score long, vec_id long, row long"


def edges(dim: int, segments: int) -> np.ndarray:
    """Borders of ``segments`` (at most ``dim``) nearly equal segments."""
    n = min(segments, dim)
    return np.arange(n + 1) * dim // n


def summaries(vectors: np.ndarray) -> np.ndarray:
    """Per vector, for every level: the means, then the deviations of the segments."""
    parts = []
    for level in LEVELS:
        cut = edges(vectors.shape[1], level)
        length = np.diff(cut)
        mean = np.add.reduceat(vectors, cut[:-1], axis=1) / length
        spread = np.add.reduceat((vectors - np.repeat(mean, length, axis=1)) ** 2, cut[:-1], axis=1) / length
        parts += [mean, np.sqrt(spread)]
    return np.concatenate(parts, axis=1)


def with_summaries(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``dim`` and ``vector`` array<long>) and their ``summary``, made once and kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                some = batch.take(pa.array(np.flatnonzero(dims == dim)))
                made = summaries(matrix(some.column("vector")))
                lists = pa.ListArray.from_arrays(np.arange(len(made) + 1, dtype=np.int32) * made.shape[1], made.ravel())
                yield some.append_column("summary", lists)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, summary array<double>")


class Summarised:
    """Vectors with the summaries of their segments."""

    def __init__(self, table: pa.Table | pa.RecordBatch) -> None:
        self.vectors = matrix(table.column("vector"))
        self.norm = np.linalg.norm(self.vectors, axis=1)
        whole, dim, at = matrix(table.column("summary")), self.vectors.shape[1], 0
        self.levels = []
        for level in LEVELS:
            n = min(level, dim)
            self.levels.append((np.diff(edges(dim, level)), whole[:, at : at + n], whole[:, at + n : at + 2 * n]))
            at += 2 * n

    def bounds(self, level: int, of: np.ndarray | slice, other: Summarised, at: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores: of all pairs for two slices, else of the pairs named one by one."""
        length, mean, spread = self.levels[level]
        _, means, spreads = other.levels[level]
        if isinstance(of, slice):
            middle, off = (mean[of] * length) @ means[at].T, (spread[of] * length) @ spreads[at].T
            off = off + (1e-9 * self.norm[of, None] * other.norm[None, at] + 1e-6)
        else:
            middle = np.einsum("ij,ij->i", mean[of] * length, means[at])
            off = np.einsum("ij,ij->i", spread[of] * length, spreads[at]) + (1e-9 * self.norm[of] * other.norm[at] + 1e-6)
        return middle - off, middle + off

    def score(self, of: np.ndarray, other: Summarised, at: np.ndarray) -> np.ndarray:
        """Exact scores of pairs; doubles hold whole numbers up to 2^53."""
        if float(self.norm.max()) * float(other.norm.max()) < 2.0**52:
            return np.einsum("ij,ij->i", self.vectors[of], other.vectors[at]).astype(np.int64)
        return np.einsum("ij,ij->i", self.vectors[of].astype(np.int64), other.vectors[at].astype(np.int64))

    def product(self, of: slice, other: Summarised, at: slice) -> np.ndarray:
        return (self.vectors[of] @ other.vectors[at].T).astype(np.int64)


class Filtered:
    """One tile: pairs are ruled out level by level, what is left is scored and handed to ``take``."""

    def __init__(self, asked: pa.Table) -> None:
        self.row, self.label = asked.column("row").to_numpy(), asked.column("label").to_numpy()
        self.data = Summarised(asked)

    def bars(self, mine: slice, lower: np.ndarray, may: np.ndarray) -> object:
        """What the bounds are held against, from the best so far and the lower bounds of a pane."""
        raise NotImplementedError

    def stays(self, bars: object, lower: np.ndarray, upper: np.ndarray, at: np.ndarray | None) -> np.ndarray:
        raise NotImplementedError

    def allowed(self, label: np.ndarray, other: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def take(self, of: np.ndarray, score: np.ndarray, rows: pa.RecordBatch, at: np.ndarray) -> None:
        raise NotImplementedError

    def add(self, rows: pa.RecordBatch) -> None:
        other, row, label = Summarised(rows), rows.column("row").to_numpy(), rows.column("label").to_numpy()
        for theirs in panes(len(row), PANE_ROWS):
            for mine in panes(len(self.row), PANE_ASKED):
                may = self.allowed(self.label[mine, None], label[None, theirs]) & (self.row[mine, None] != row[None, theirs])
                lower, upper = self.data.bounds(0, mine, other, theirs)
                bars = self.bars(mine, lower, may)
                may &= self.stays(bars, lower, upper, None)
                for level in range(1, len(LEVELS)):
                    if may.mean() > DENSE:
                        may &= self.stays(bars, *self.data.bounds(level, mine, other, theirs), None)
                        continue
                    of, at = np.nonzero(may)
                    for part in panes(len(of), PAIRS):
                        kept = self.stays(bars, *self.data.bounds(level, of[part] + mine.start, other, at[part] + theirs.start), of[part])
                        may[of[part], at[part]] = kept
                self._score(may, mine, theirs, other, rows)

    def _score(self, may: np.ndarray, mine: slice, theirs: slice, other: Summarised, rows: pa.RecordBatch) -> None:
        of, at = np.nonzero(may)
        small = float(self.data.norm.max()) * float(other.norm.max()) < 2.0**52
        whole = self.data.product(mine, other, theirs) if may.mean() > DENSE and small else None
        for part in panes(len(of), PAIRS):
            a, b = of[part], at[part]
            score = whole[a, b] if whole is not None else self.data.score(a + mine.start, other, b + theirs.start)
            self.take(a + mine.start, score, rows, b + theirs.start)


class Positives(Filtered):
    """The first ``k`` other rows of the same label for each anchor."""

    def __init__(self, asked: pa.Table, k: int) -> None:
        super().__init__(asked)
        self.k, self.best = k, Heaps(len(self.row), k, np.int64)

    def allowed(self, label: np.ndarray, other: np.ndarray) -> np.ndarray:
        return label == other

    def bars(self, mine: slice, lower: np.ndarray, may: np.ndarray) -> np.ndarray:
        bar = self.best.least()[mine]
        if lower.shape[1] >= self.k:
            at = lower.shape[1] - self.k
            bar = np.maximum(bar, np.partition(np.where(may, lower, -np.inf), at, axis=1)[:, at])
        return bar

    def stays(self, bars: np.ndarray, lower: np.ndarray, upper: np.ndarray, at: np.ndarray | None) -> np.ndarray:
        return upper >= (bars[:, None] if at is None else bars[at])

    def take(self, of: np.ndarray, score: np.ndarray, rows: pa.RecordBatch, at: np.ndarray) -> None:
        kept = score >= self.best.least()[of]
        of, score, at = of[kept], score[kept], at[kept]
        ids, unnamed = ids_of(rows.column("vec_id"))
        self.best.add(of, score, ids[at], unnamed[at], rows.column("row").to_numpy()[at])

    def result(self) -> pa.Table:
        at, score, ids, row = self.best.entries()
        return pa.table([pa.array(self.row[at]), pa.array(score), ids, pa.array(row)], ["asked", "score", "vec_id", "row"])


class Negatives(Filtered):
    """The first ``k`` rows of another label with a score from ``share`` percent of a positive's to all of it, for each anchor and positive."""

    def __init__(self, asked: pa.Table, k: int, share: int) -> None:
        super().__init__(asked)
        self.share, lists = share, asked.column("positives").to_pylist()
        self.many = max(1, max(map(len, lists), default=1))
        self.high = np.full((len(lists), self.many), -1, np.int64)  # no score is from a share of -1 up to -1
        self.positive = np.zeros((len(lists), self.many), np.int64)
        for i, some in enumerate(lists):
            for j, p in enumerate(some):
                self.high[i, j], self.positive[i, j] = p["score"], p["row"]
        self.best = [Heaps(len(lists), k, np.int64) for _ in range(self.many)]

    def allowed(self, label: np.ndarray, other: np.ndarray) -> np.ndarray:
        return label != other

    def bars(self, mine: slice, lower: np.ndarray, may: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        high = self.high[mine].astype(np.float64)
        reach = [np.maximum(np.where(high[:, j] < 0, np.inf, self.share * high[:, j] / 100), self.best[j].least()[mine]) for j in range(self.many)]
        return [(reach[j] - 1e-6 * np.abs(np.where(np.isfinite(reach[j]), reach[j], 0)), high[:, j]) for j in range(self.many)]

    def stays(self, bars: list[tuple[np.ndarray, np.ndarray]], lower: np.ndarray, upper: np.ndarray, at: np.ndarray | None) -> np.ndarray:
        kept = np.zeros(lower.shape, bool)
        for reach, high in bars:
            r, h = (reach[:, None], high[:, None]) if at is None else (reach[at], high[at])
            kept |= (upper >= r) & (lower <= h)
        return kept

    def take(self, of: np.ndarray, score: np.ndarray, rows: pa.RecordBatch, at: np.ndarray) -> None:
        ids, unnamed = ids_of(rows.column("vec_id"))
        row = rows.column("row").to_numpy()
        for j in range(self.many):
            high = self.high[of, j]
            kept = (score <= high) & (100 * score >= self.share * high) & (score >= self.best[j].least()[of])
            self.best[j].add(of[kept], score[kept], ids[at[kept]], unnamed[at[kept]], row[at[kept]])

    def result(self) -> pa.Table:
        parts = []
        for j, best in enumerate(self.best):
            at, score, ids, row = best.entries()
            names = ["asked", "positive", "score", "vec_id", "row"]
            parts.append(pa.table([pa.array(self.row[at]), pa.array(self.positive[at, j]), pa.array(score), ids, pa.array(row)], names))
        return pa.concat_tables(parts)


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), "row"]
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def mine(embeddings: DataFrame, anchors: Column, label: Column | str = "label", positives: int = 5, negatives: int = 5, share: int = 80, steps: int = 256, vec_id: str = "vec_id", vector: str = "embedding", resident: int = RESIDENT, least: int = LEAST) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(``steps`` * x); a score is the whole-number inner product. An anchor's positives are its first ``positives`` other rows of the same
    ``label``, higher scores first, ties to the smaller vec_id (null last); for each, the first ``negatives`` rows of another label whose score is
    from ``share`` percent of the positive's up to all of it. A negative score of the positive leaves no such row. Rows with a null label, a null or empty vector or a null
    or non-finite component take no part; vectors of different length do not meet; zero vectors score 0. Rows alike in every column are rows of their own: each anchor
    among them gives its list, each positive its rows. ``anchors`` and ``label`` are expressions on the input's columns; a null condition is no anchor. Scores are exact up to 2^53 (vectors of norm up to 9e7 after
    scaling). Other columns are not read; an empty table gives an empty result. ``resident`` and ``least`` size the tiles and change no result.
    """
    scaled = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * steps))
    named = embeddings.select(
        F.col(vec_id).cast("long").alias("vec_id"), (F.col(label) if isinstance(label, str) else label).cast("int").alias("label"),
        usable(F.col(vector).cast("array<double>")).alias("usable"), F.coalesce(anchors, F.lit(False)).alias("anchor"), scaled.alias("vector"),
    )
    good = named.where("usable AND label IS NOT NULL").drop("usable").withColumn("dim", F.size("vector"))
    rows = saved(with_summaries(good.withColumn("row", F.monotonically_increasing_id())), "vectors")
    asked = rows.where("anchor").drop("anchor", "vec_id")
    every = rows.drop("anchor")
    first = saved(_ranked(tiled(asked, every, lambda of: Positives(of, positives), FOUND, resident, least), ["asked"], positives), "positives")
    lists = first.groupBy(F.col("asked").alias("row")).agg(F.sort_array(F.collect_list(F.struct("rank", "row", "score"))).alias("positives"))
    found = tiled(asked.join(lists, "row"), every, lambda of: Negatives(of, negatives, share), MINED, resident, least)
    mined = _ranked(found, ["asked", "positive"], negatives)
    chosen = first.select("asked", F.col("row").alias("positive"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = rows.where("anchor").select(F.col("row").alias("asked"), F.col("vec_id").alias("anchor_id"))
    return mined.join(chosen, ["asked", "positive"]).join(names, "asked").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
