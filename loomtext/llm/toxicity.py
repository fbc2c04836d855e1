"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words and their beginnings (inflected words share them), chosen by how strongly they go with the label among the examples.
Their document frequencies are counted over the whole corpus. The examples lie in blocks; the index knows the largest weight of each term
in each block, so a query opens blocks in the order of their bounds and stops where no further block can reach the k-th best.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.llm import labelled, logistic

#: Bounds of the fitted sample: examples per class, bytes of the longest, and terms.
EXAMPLES, MAX_BYTES, TERMS = 2500, 1 << 16, 4096
#: Lengths of the beginnings that are terms, in characters.
STEMS = (4, 5)
#: Neighbours that vote, and examples of a block.
NEIGHBOURS, BLOCK = 15, 64
#: Chance that any term is kept without going with the label; terms kept at least.
ALPHA, LEAST_TERMS = 1e-3, 24
#: Words whose terms a task remembers.
REMEMBERED = 500_000

_words = re.compile(r"\w+").findall


def words_of(text: str | None) -> list[str]:
    return _words(text.lower()) if text else []


def _terms(word: str) -> list[str]:
    """The word and its beginnings; a hyphen after a beginning keeps the two kinds apart."""
    return [word, *(word[:n] + "-" for n in STEMS if len(word) >= n)]


class Vocabulary(dict):
    """Word to the numbers of its terms, for words seen lately."""

    def __init__(self, terms: list[str]):
        super().__init__()
        self.number = {t: i for i, t in enumerate(terms)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        found = tuple(self.number[t] for t in _terms(word) if t in self.number)
        self[word] = found
        return found

    def counts(self, text: str | None) -> Counter:
        return Counter(t for found in map(self.__getitem__, words_of(text)) for t in found)


def choose_terms(texts: list[str], classes: np.ndarray, most: int = TERMS) -> list[str]:
    """Terms that go with the label by the chi-squared statistic, beyond what chance gives the best of so many."""
    seen = [Counter(), Counter()]
    for text, c in zip(texts, classes, strict=True):
        seen[c].update({t for w in set(words_of(text)) for t in _terms(w)})
    names = sorted(set(seen[0]) | set(seen[1]))
    a, b = (np.array([seen[c][t] for t in names], dtype=float) for c in (1, 0))
    n1, n0 = float(classes.sum()), float(len(classes) - classes.sum())
    c, d, n = n1 - a, n0 - b, n1 + n0
    with np.errstate(divide="ignore", invalid="ignore"):
        # Terms that are not mostly of class 1 are no evidence for it, however strongly they lean.
        chi = np.where((a + b > 1) & (c + d > 0) & (a > 3 * b), n * (a * d - b * c) ** 2 / ((a + b) * (c + d) * n1 * n0), 0.0)
    strong = int((chi > 2 * np.log(max(len(names), 1) / ALPHA)).sum())
    order = np.lexsort((np.arange(len(names)), -chi))[: min(most, max(strong, LEAST_TERMS))]
    return [names[i] for i in order if chi[i] > 0]


@dataclass
class Index:
    """Examples as unit vectors, in blocks, with the largest weight of each term in each block."""

    terms: list[str]
    idf: np.ndarray
    ids: np.ndarray
    classes: np.ndarray
    #: Per term the example numbers (ascending) and weights.
    postings: list[tuple[np.ndarray, np.ndarray]]
    bounds: np.ndarray
    weights: tuple[float, ...] = ()
    offset: float = 0.0
    block: int = BLOCK
    opened: int = field(default=0, compare=False)

    @classmethod
    def build(cls, terms: list[str], idf: np.ndarray, examples: list[tuple[int, str, int]], block: int = BLOCK) -> Index:
        vocabulary = Vocabulary(terms)
        vectors = [(i, c, unit(vocabulary.counts(t), idf)) for i, t, c in examples]
        # Examples with the same leading term share blocks, which keeps the bounds tight.
        vectors.sort(key=lambda v: (v[2][0][np.argmax(v[2][1])] if len(v[2][0]) else len(terms), v[0]))
        blocks = max(1, -(-len(vectors) // block))
        bounds = np.zeros((len(terms), blocks))
        lists: list[list[tuple[int, float]]] = [[] for _ in terms]
        for at, (_, _, (where, values)) in enumerate(vectors):
            for t, v in zip(where, values, strict=True):
                lists[t].append((at, v))
                bounds[t, at // block] = max(bounds[t, at // block], v)
        postings = [(np.array([a for a, _ in p], dtype=np.int64), np.array([v for _, v in p])) for p in lists]
        return cls(terms, idf, np.array([v[0] for v in vectors]), np.array([v[1] for v in vectors]), postings, bounds, block=block)

    def nearest(self, counts: Counter, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the ``k`` nearest examples with a term in common, the earlier of equals first; exact."""
        where, values = unit(counts, self.idf)
        if not len(where):
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        bound = values @ self.bounds[where]
        best_at, best = np.zeros(0, dtype=np.int64), np.zeros(0)
        for b in np.argsort(-bound, kind="stable"):
            # A little slack, as a bound and a cosine may be rounded differently.
            if bound[b] <= 0 or len(best) >= k and bound[b] + 1e-9 < best[-1]:
                break
            self.opened += 1
            cosines = np.zeros(self.block)
            for t, v in zip(where, values, strict=True):
                at, weight = self.postings[t]
                lo, hi = np.searchsorted(at, (b * self.block, (b + 1) * self.block))
                cosines[at[lo:hi] - b * self.block] += v * weight[lo:hi]
            hit = np.nonzero(cosines > 0)[0]
            best_at, best = np.append(best_at, hit + b * self.block), np.append(best, cosines[hit])
            order = np.lexsort((best_at, -best))[:k]
            best_at, best = best_at[order], best[order]
        return best_at, best

    def votes(self, at: np.ndarray, cosine: np.ndarray) -> tuple[float, float, float]:
        """Of the nearest examples: share of the votes for class 1, weighted by the square of the cosine; the nearest of class 1; that there is one."""
        if not len(at):
            return 0.0, 0.0, 0.0
        ones, weight = self.classes[at] == 1, cosine**2
        return float(weight[ones].sum() / weight.sum()), float(cosine[ones].max(initial=0.0)), 1.0

    def probability(self, votes: np.ndarray) -> np.ndarray:
        return logistic.sigmoid(votes @ np.array(self.weights) + self.offset) if self.weights else logistic.sigmoid(np.full(len(votes), self.offset))


def unit(counts: Counter, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms and weights of a text as a vector of length 1."""
    where = np.array(sorted(counts), dtype=np.int64)
    values = np.array([1 + np.log(counts[t]) for t in where]) * idf[where] if len(where) else np.zeros(0)
    return where, values / np.sqrt((values**2).sum()) if len(where) else values


def document_frequencies(docs: DataFrame, terms: list[str]) -> np.ndarray:
    """In how many of all documents each term occurs; one row per term and task is shuffled."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary, found, rows = Vocabulary(terms), Counter(), 0
        for batch in batches:
            for text in batch["text"]:
                rows += 1
                found.update({t for w in set(words_of(text)) for t in vocabulary[w]})
        yield pd.DataFrame({"term": [-1, *found], "n": [rows, *found.values()]}, dtype="int64")

    totals = docs.select("text").mapInPandas(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    by_term = {r["term"]: r["n"] for r in totals.collect()}
    return np.array([by_term.get(t, 0) for t in range(-1, len(terms))], dtype=float)


def fit(docs: DataFrame, labels: DataFrame, label: str, usable: Column, examples: int = EXAMPLES, max_bytes: int = MAX_BYTES) -> Index:
    """Index half of the sampled examples (at most ``examples`` per class, equal texts once) and calibrate on the other half.

    Without labels of both classes there are no neighbours, and the score is the smoothed share of class 1.
    """
    rows = labelled.sample(docs, labels, label, usable, examples, max_bytes)
    rows = list({text: (i, text, c) for i, text, c in rows}.values())
    index, hold = labelled.split_half(rows)
    ones = sum(c for _, _, c in rows)
    prior = float(np.log((ones + 1) / (len(rows) - ones + 1)))
    if any(sum(r[2] == c for r in part) == 0 for c in (0, 1) for part in (index, hold)):
        return Index([], np.zeros(0), np.zeros(0), np.zeros(0), [], np.zeros((0, 1)), offset=prior)
    terms = choose_terms([t for _, t, _ in index], np.array([c for _, _, c in index]))
    total, *frequency = document_frequencies(docs, terms)
    built = Index.build(terms, np.log((total + 1) / (np.array(frequency) + 1)) + 1, index)
    vocabulary = Vocabulary(terms)
    votes = np.array([built.votes(*built.nearest(vocabulary.counts(t))) for _, t, _ in hold])
    weights, built.offset = logistic.fit(votes, np.array([c for _, _, c in hold], dtype=float), ridge=1e-3)
    built.weights = tuple(weights)
    return built


def score_documents(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0, flag: float = 0.5) -> DataFrame:
    """``docs`` with ``held_out``, ``score``, ``predicted`` (1 if the score is at least ``flag``) and ``evidence``.

    ``evidence`` lists the ids and cosines of the nearest examples. Learns ``labels.toxic`` of ids whose crc32 modulo ``parts`` is not ``held``. A text
    without any of the terms, null and empty ones too, has no neighbours and the score that such examples have. Repeated rows are
    scored alike; input columns of the result's names are replaced.
    """
    model = fit(docs, labels, "toxic", labelled.id_remainder(F.col("doc_id"), parts) != held)
    # At most EXAMPLES examples over TERMS terms; the fields, as the class itself is not installed on executors.
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf("score double, evidence array<struct<doc_id: bigint, cosine: double>>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = Index(**shared.value)
        vocabulary = Vocabulary(index.terms)
        for texts in batches:
            near = [index.nearest(vocabulary.counts(t)) for t in texts]
            votes = np.array([index.votes(*n) for n in near]).reshape(-1, 3)
            evidence = [
                [{"doc_id": int(index.ids[a]), "cosine": float(v)} for a, v in zip(at[:3], cosine[:3], strict=True)] for at, cosine in near
            ]
            yield pd.DataFrame({"score": index.probability(votes), "evidence": evidence})

    found = docs.withColumn("__found", of(F.col("text")))
    return (
        found.withColumn("held_out", labelled.id_remainder(F.col("doc_id"), parts) == held)
        .withColumn("score", F.col("__found.score"))
        .withColumn("predicted", (F.col("score") >= flag).cast("int"))
        .withColumn("evidence", F.col("__found.evidence"))
        .drop("__found")
    )
