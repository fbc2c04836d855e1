"""Unigram subword vocabulary (Kudo 2018, arXiv:1804.10959) as Spark jobs.

The corpus is reduced to distinct words with counts. Seeds come from the sorted suffixes of the words. A round sends the scores (at most ``MAX_PIECES`` pieces of
at most ``MAX_PIECE`` characters) to the tasks, each group of words adds up what its words expect, and SQL does the rest: the maximisation, the pruning and the
choice of the best. The words are dealt to their groups once and never move again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.functions.text import tokens_of
from loomtext.operators import lattice
from loomtext.operators.encode import _lengths, _offsets, _with_eos
from loomtext.operators.lattice import MAX_PIECE
from loomtext.operators.vocab import (
    EOS_ID, MAX_PIECES, SPECIAL_PIECES, UNK_ID, covering_chars, least_kept_count, number_pieces, token_counts,
)
from loomtext.session import frozen

# Stands for the characters outside the alphabet while training; no text has it.
OUTSIDE = "\x00"
# Characters of a word whose beginnings are counted together.
STRETCH = 256
# Expected counts are summed as whole numbers of this part, so that no order of addition changes them.
SCALE = 1_000_000
# Distinct words of a group.
GROUP_WORDS = 50_000
# Words whose ids a worker remembers, and the characters they have together.
REMEMBERED, REMEMBERED_CHARS = 300_000, 16 * 300_000
# Tokens whose different words are looked up in one call.
AT_ONCE = 1 << 19


def training_words(docs: DataFrame, mode: str = "nfkc_cf") -> DataFrame:
    """Distinct words with counts, whole."""
    return token_counts(docs, mode).withColumnRenamed("tok", "word")


def letters_of(words: DataFrame) -> DataFrame:
    return words.select(F.explode_outer(F.split("word", "")).alias("ch"), "n").where("ch != ''").groupBy("ch").agg(F.sum("n").alias("n"))


def suffixes(words: DataFrame) -> DataFrame:
    """``(suffix, n)``: what begins at every character of the words, up to one character more than the longest piece, with counts.

    A long word is cut into stretches that overlap by as much: every suffix starts in exactly one. A character outside the alphabet ends a suffix.
    """
    stretch = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.length("word") - 1), F.lit(STRETCH)),
        lambda i: F.substring(F.col("word"), i + 1, F.lit(STRETCH + MAX_PIECE)),
    )
    parts = words.select(F.explode(stretch).alias("part"), "n").groupBy("part").agg(F.sum("n").alias("n"))
    begins = F.sequence(F.lit(1), F.least(F.lit(STRETCH), F.length("part")))
    each = F.transform(begins, lambda i: F.substring_index(F.substring(F.col("part"), i, F.lit(MAX_PIECE + 1)), OUTSIDE, 1))
    return parts.select(F.explode(each).alias("suffix"), "n").where("suffix != ''").groupBy("suffix").agg(F.sum("n").alias("n"))


def _branches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The substrings that begin the suffixes of one range of the sorted suffixes, with counts, and the least and greatest character that follows ("" at an end).

    Depth by depth: suffixes that agree in their first k characters are neighbours. Given out are the substrings that do not always go on the
    same way, and those of the first and the last suffix, which may go on in other ranges.
    """
    names = ["piece", "times", "low", "high"]
    table = [b for b in batches if b.num_rows]
    if not table:
        return
    rows = pa.Table.from_batches(table).sort_by("suffix")
    texts = rows.column("suffix").to_numpy().astype(f"<U{MAX_PIECE + 1}")
    weights = rows.column("n").to_numpy().astype(np.int64)
    codes = texts.view("<u4").reshape(len(texts), MAX_PIECE + 1)
    same = np.ones(len(texts), bool)  # as the row before, as far as the depth goes
    same[0] = False
    for depth in range(1, MAX_PIECE + 1):
        same[1:] &= codes[1:, depth - 1] == codes[:-1, depth - 1]
        if depth == 1:
            continue
        starts = np.flatnonzero(~same)
        ends = np.append(starts[1:], len(texts)) - 1
        low, high = codes[starts, depth], codes[ends, depth]
        times = np.add.reduceat(weights, starts)
        kept = (((low == 0) | (low != high)) & (times > 1)) | (starts == 0) | (ends == len(texts) - 1)
        kept &= codes[starts, depth - 1] != 0
        shown = lambda c: ["" if x == 0 else chr(x) for x in c[kept]]
        columns = [pa.array(texts[starts[kept]].astype(f"<U{depth}").tolist(), pa.string()), pa.array(times[kept]), pa.array(shown(low), pa.string()), pa.array(shown(high), pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names)


def repeated_substrings(words: DataFrame) -> DataFrame:
    """``(piece, times)``: the substrings of 2 to ``MAX_PIECE`` characters that occur twice or more and that no one character follows everywhere.

    They are the branches of the suffix tree of the words. The suffixes are sorted by ranges; a branch that lies in several ranges is put together from its
    parts, of which a range has at most two a depth. Shorter substrings that always go on the same way are the same occurrences as the longer ones, and weigh less.
    """
    counted = suffixes(words)
    found = counted.repartitionByRange("suffix").mapInArrow(_branches, "piece string, times bigint, low string, high string")
    whole = found.groupBy("piece").agg(F.sum("times").alias("times"), F.min("low").alias("low"), F.max("high").alias("high"))
    return whole.where("times > 1 AND (low = '' OR low != high)").select("piece", "times")


def seed_pieces(words: DataFrame, alphabet: DataFrame, size: int) -> DataFrame:
    """``(piece, weight, is_char)``: every character of the alphabet, and the ``size`` repeated substrings with the greatest count times length."""
    longer = frozen(repeated_substrings(words).withColumn("n", F.col("times") * F.length("piece")))
    # Too light ones go before the sort, so that no task is sent the best of all tasks.
    heavy = longer.where(F.col("n") >= least_kept_count(longer, size)).orderBy(F.desc("n"), "piece").limit(size)
    chars = alphabet.select(F.col("ch").alias("piece"), F.col("n"))
    return heavy.select("piece", F.col("n").alias("weight"), F.lit(False).alias("is_char")).unionByName(
        chars.select("piece", F.col("n").alias("weight"), F.lit(True).alias("is_char"))
    )


def digamma(x: Column) -> Column:
    """Asymptotic series of the digamma function (Abramowitz and Stegun 6.3.18) at x + 7, and back by its recurrence (6.3.5)."""
    y = x + F.lit(7.0)
    inverse = F.lit(1.0) / (y * y)
    series = F.log(y) - F.lit(0.5) / y - inverse * (F.lit(1 / 12) - inverse * (F.lit(1 / 120) - inverse * F.lit(1 / 252)))
    steps = sum((F.lit(1.0) / (x + F.lit(float(k))) for k in range(1, 7)), F.lit(1.0) / x)
    return series - steps


def dealt(words: DataFrame, least: int | None = None) -> DataFrame:
    """The words in as many partitions as there are groups, kept so: which words share a group depends on the words alone."""
    least = least or int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(least, math.ceil(words.count() / GROUP_WORDS))
    part = F.pmod(F.xxhash64("word"), F.lit(groups)).cast("int")
    return frozen(words.repartitionById(groups, part).sortWithinPartitions("word"))


def _shared(scores: DataFrame) -> Broadcast:
    """Pieces and scores for every task; their number and length are bounded."""
    rows = scores.select("piece", "score").orderBy("piece").limit(MAX_PIECES + 1).toPandas()
    if len(rows) > MAX_PIECES:
        raise ValueError(f"more than {MAX_PIECES} pieces")
    return scores.sparkSession.sparkContext.broadcast({"pieces": rows["piece"].tolist(), "scores": rows["score"].to_numpy()})


def _table(shared: Broadcast) -> lattice.Pieces:
    """The pieces as lattices need them. A worker makes them once and keeps them as long as it has the broadcast, however many tasks it runs."""
    held = shared.value
    if "table" not in held:
        held["table"] = lattice.Pieces(held["pieces"], held["scores"])
    return held["table"]


def _whole(batches: Iterator[pa.RecordBatch]) -> pd.DataFrame:
    return pd.concat([b.to_pandas() for b in batches] or [pd.DataFrame({"word": [], "n": []})], ignore_index=True)


def summed(words: DataFrame, scores: Broadcast, soft: bool = True) -> DataFrame:
    """``(piece, c)``: use of each piece over all ``dealt`` words, expected (soft) or on the best cut, times ``SCALE``. The row
    with a null piece is the log likelihood (soft only)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, listed, table = _whole(batches), scores.value["pieces"], _table(scores)
        texts, weights = some["word"].tolist(), some["n"].to_numpy(dtype=float)
        if soft:
            likelihood, counts = lattice.expected_counts(table, texts, weights)
        else:
            flat, sizes, _ = lattice.best_paths(table, texts)
            likelihood, counts = 0.0, np.bincount(flat, weights=np.repeat(weights, sizes), minlength=len(listed))[: len(listed)]
        used = np.flatnonzero(counts > 0)
        amounts = np.rint(np.append(counts[used], likelihood) * SCALE).astype("int64")
        yield pa.RecordBatch.from_arrays([pa.array([*(listed[i] for i in used), None], pa.string()), pa.array(amounts)], ["piece", "c"])

    found = words.mapInArrow(run, "piece string, c bigint")
    return found.groupBy("piece").agg(F.sum(F.col("c").cast("decimal(28,0)")).alias("c"))


def em_round(words: DataFrame, scores: DataFrame, least: float = 0.5) -> DataFrame:
    """One round: pieces that are expected at least ``least`` times, and all characters, with new scores."""
    shared = _shared(scores)
    counts = summed(words, shared).where("piece IS NOT NULL")
    kept = frozen(
        scores.select("piece", "is_char")
        .join(counts, "piece", "left")
        .withColumn("c", F.coalesce("c", F.lit(0)))
        .where((F.col("c") >= int(least * SCALE)) | F.col("is_char"))
        .withColumn("c", F.greatest("c", F.lit(int(least * SCALE)).cast("decimal(38,0)")))
    )
    shared.destroy()
    total = kept.agg((F.sum("c").cast("double") / SCALE).alias("t")).select(digamma(F.col("t"))).scalar()
    score = F.round(digamma(F.col("c").cast("double") / SCALE) - total, 9)
    return frozen(kept.select("piece", score.alias("score"), "is_char"))


def log_likelihood(words: DataFrame, scores: DataFrame) -> float:
    return float(summed(words, _shared(scores)).where("piece IS NULL").first()["c"]) / SCALE


def prune(words: DataFrame, scores: DataFrame, keep: int) -> DataFrame:
    """Drop the pieces whose loss costs least likelihood; characters always stay."""
    shared = _shared(scores)

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, table = _whole(batches), _table(shared)
        texts = some["word"].tolist()
        own = table.scores[[table.number[t] for t in texts]] if texts else np.zeros(0)
        other = lattice.best_paths(table, texts, whole=False)[2]
        loss = np.round(some["n"].to_numpy(dtype=float) * (own - other), 6)
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(loss, pa.float64())], ["piece", "loss"])

    used = summed(words, shared, soft=False).where((F.length("piece") > 1) & (F.col("c") > 0))
    chars = scores.where("is_char").count()
    asked = used.select(F.col("piece").alias("word"), (F.col("c").cast("double") / SCALE).alias("n"))
    losses = asked.mapInArrow(cost, "piece string, loss double")
    stay = losses.orderBy(F.desc("loss"), "piece").limit(max(0, keep - chars)).select("piece")
    kept = frozen(scores.where("is_char").unionByName(scores.where("NOT is_char").join(stay, "piece", "left_semi")))
    shared.destroy()
    return kept


def unigram_vocab(
    docs: DataFrame,
    size: int = 32000,
    coverage: float = 0.9995,
    mode: str = "nfkc_cf",
    seed_factor: int = 10,
    shrink: float = 0.75,
    rounds: int = 2,
) -> DataFrame:
    """Train a vocabulary of at most ``size`` pieces on ``docs(text)``."""
    if size * seed_factor > MAX_PIECES:
        raise ValueError(f"size * seed_factor is beyond {MAX_PIECES} pieces")
    spark = docs.sparkSession
    words = frozen(training_words(docs, mode))
    letters = frozen(letters_of(words))
    alphabet = frozen(covering_chars(letters, coverage))
    wanted = size - len(SPECIAL_PIECES)
    if alphabet.count() > wanted:
        raise ValueError(f"the characters needed for coverage {coverage} alone exceed {wanted} pieces")
    # Characters outside the alphabet: not more than Unicode has.
    rare = "".join(sorted(r["ch"] for r in letters.join(alphabet, "ch", "left_anti").collect()))
    if rare:
        shown = F.translate("word", rare, OUTSIDE * len(rare))
        words = frozen(words.select(shown.alias("word"), "n").groupBy("word").agg(F.sum("n").alias("n")))
    words = dealt(words)
    seeds = frozen(seed_pieces(words, alphabet, size * seed_factor))
    total = seeds.agg(F.log(F.sum("weight").cast("double"))).scalar()
    scores = frozen(seeds.select("piece", F.round(F.log(F.col("weight").cast("double")) - total, 9).alias("score"), "is_char"))
    while True:
        for _ in range(rounds):
            scores = em_round(words, scores)
        count = scores.count()
        if count <= wanted * 1.1:
            break
        scores = prune(words, scores, max(int(wanted * 1.1), int(count * shrink)))
    chosen = scores.orderBy(F.desc("is_char"), F.desc("score"), "piece").limit(wanted).select("piece", "score")
    return number_pieces(frozen(chosen))


class Remembered:
    """Words and the ids of their best cuts, all ids in one row. What would go beyond the bounds makes it forget what it had."""

    def __init__(self, table: lattice.Pieces, ids: np.ndarray):
        self.table, self.ids = table, ids
        self.forget()

    def forget(self) -> None:
        self.words, self.chars = pa.array([], pa.string()), 0
        self.flat, self.sizes, self.starts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The number of each of the different ``words``; good until the next call."""
        found = pc.index_in(words, value_set=self.words)
        fresh, chars = words.filter(found.is_null()), pc.utf8_length(words)
        if len(self.words) + len(fresh) > REMEMBERED or self.chars + (pc.sum(chars.filter(found.is_null())).as_py() or 0) > REMEMBERED_CHARS:
            self.forget()
            found, fresh = pa.nulls(len(words), pa.int32()), words
        number, new = found.fill_null(-1).to_numpy().astype(np.int64), found.is_null().to_numpy(zero_copy_only=False)
        number[new] = len(self.words) + np.arange(len(fresh))
        if len(fresh):
            self._learn(fresh)
        return number

    def _learn(self, fresh: pa.Array) -> None:
        flat, sizes, _ = lattice.best_paths(self.table, fresh.to_pylist())
        coded, word = self.ids[flat], np.repeat(np.arange(len(fresh)), sizes)
        once = np.ones(len(coded), bool)
        once[1:] = (coded[1:] != UNK_ID) | (coded[:-1] != UNK_ID) | (word[1:] != word[:-1])
        self.words, self.chars = pa.concat_arrays([self.words, fresh]), self.chars + pc.sum(pc.utf8_length(fresh)).as_py()
        self.flat = np.concatenate([self.flat, coded[once]])
        self.sizes = np.concatenate([self.sizes, np.bincount(word[once], minlength=len(fresh))])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def coded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``words``, and how many each has."""
        different = words.dictionary_encode()
        number = self.numbers(different.dictionary)[different.indices.to_numpy()]
        sizes = self.sizes[number]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.starts[number] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)], sizes


def unigram_ids(words: Column, vocab: DataFrame, append_eos: bool = True) -> Column:
    """Array of words without whitespace to piece ids by best cut; a run of unknown characters becomes one id 1.

    The words of a text travel as its lines. The different words of ``AT_ONCE`` are looked up in one call; a worker cuts a word once and remembers it.
    """
    rows = vocab.where(~F.col("is_special")).select("piece", "score", "id").limit(MAX_PIECES + 1).collect()
    if len(rows) > MAX_PIECES:
        raise ValueError(f"vocabulary has more than {MAX_PIECES} pieces")
    rows.sort(key=lambda r: r["id"])
    listed = {"pieces": [r["piece"] for r in rows], "scores": [r["score"] for r in rows], "ids": [r["id"] for r in rows]}
    shared = vocab.sparkSession.sparkContext.broadcast(listed)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = shared.value
        if "known" not in held:
            held["known"] = Remembered(_table(shared), np.array([*held["ids"], UNK_ID], dtype=np.int32))
        known = held["known"]
        for texts in batches:
            lists = pc.split_pattern(texts, "\n")  # no words become one empty word, which has no ids
            flat = lists.flatten()
            parts = [known.coded(flat.slice(at, AT_ONCE)) for at in range(0, len(flat), AT_ONCE)]
            ids = np.concatenate([np.zeros(0, np.int32), *(p[0] for p in parts)])
            ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.concatenate([np.zeros(0, np.int64), *(p[1] for p in parts)]))])
            lengths = np.diff(ends[_offsets(_lengths(lists))])
            ids, borders = _with_eos(ids, lengths) if append_eos else (ids, _offsets(lengths))
            yield pa.ListArray.from_arrays(pa.array(borders), pa.array(ids, pa.int32()), mask=lists.is_null())

    return encode(F.array_join(words, "\n"))


def encode_unigram(docs: DataFrame, vocab: DataFrame, append_eos: bool = True, mode: str = "nfkc_cf") -> DataFrame:
    """Replace ``text`` by ``input_ids`` of a unigram vocabulary."""
    return docs.withColumn("input_ids", unigram_ids(tokens_of(F.col("text"), mode), vocab, append_eos)).drop("text")


def cut_words(docs: DataFrame, vocab: DataFrame, mode: str = "nfkc_cf") -> DataFrame:
    """``(item, value)``: every different word of ``docs(text)`` and its ids, each cut once; what ``encode.encode_joined`` takes."""
    words = training_words(docs, mode).select(F.col("word").alias("item"))
    return words.withColumn("value", unigram_ids(F.array("item"), vocab, append_eos=False))
