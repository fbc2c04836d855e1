"""Language of every word by a linear-chain conditional random field.

A word's scores come from its affixes, its letter n-grams and per-language lexicons; learned transitions say how readily the language changes
from a word to the next. Forward-backward gives each word its probabilities, also in text that switches between languages; a document's
language is the one with the most words by expectation.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomtext.llm import labelled

#: Bounds of the fitted sample: texts per language and bytes of the longest. Every language with labelled rows is learned; from 64 of them on
#: all share ``SAMPLE`` texts, of which each has ``LEAST`` at least.
TEXTS, MAX_BYTES, SAMPLE, LEAST = 400, 1 << 16, 25_600, 20
#: Rows of the weight table that features are hashed into; words of a language's lexicon.
BUCKETS, LEXICON = 1 << 15, 300
#: Training sequences, their words, the words of a stretch in one language, and gradient steps.
SEQUENCES, LENGTH, STRETCH, STEPS = 1600, 64, (3, 40), 90
#: Words of a chunk of the blocked forward-backward pass (more for many languages, see ``forward_backward``), and scores held at a time.
CHUNK, CELLS = 128, 1 << 22
#: Words whose scores a task remembers.
REMEMBERED = 400_000
UNDETERMINED = "und"

_edges = re.compile(r"^[\W\d_]+|[\W\d_]+$")
#: Scripts written without spaces: Thai and Lao, Burmese, Khmer, kana, Han.
_unspaced = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_runs = re.compile(f"[{_unspaced}]{{1,4}}|[^{_unspaced}]+")
_any_unspaced = re.compile(f"[{_unspaced}]")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs between white space, with the signs around them; what a script without spaces writes, by four characters."""
    if not text:
        return []
    words = text.lower().split()
    if text.isascii() or not _any_unspaced.search(text):
        return words
    return [part for word in words for part in _runs.findall(word)]


def core(word: str) -> str:
    """The word from its first letter to its last; empty without a letter."""
    if word.isalpha():
        return word
    inner = _edges.sub("", word)
    return inner if any(map(str.isalpha, inner)) else ""  # superscripts and fractions are no letters


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray
    lexicon: dict[str, list[int]]
    transitions: np.ndarray


def features(words: list[str], lexicon: dict[str, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the weight table for affixes, n-grams, lexicons and the words themselves, and the number of the word each belongs to."""
    framed = [b"<" + w.encode("utf-8", "surrogatepass") + b">" for w in words]
    size = np.array([len(f) for f in framed], dtype=np.int64)
    begin = np.cumsum(size) - size
    data = np.frombuffer(b"".join(framed) + b"   ", dtype=np.uint8).astype(np.uint32)
    number = np.repeat(np.arange(len(words)), size)
    inside = np.arange(len(number)) - np.repeat(begin, size) < np.repeat(size, size) - 2
    three = data[:-3] | data[1:-2] << 8 | data[2:-1] << 16
    rows, owners = [_row(three[inside], 3)], [number[inside]]
    everyone = np.arange(len(words))
    ahead = np.zeros(len(words), dtype=np.uint32)
    behind = ahead.copy()
    for k in range(1, 5):
        long_enough = size - 2 >= k
        at = everyone[long_enough]
        ahead[at] = ahead[at] << 8 | data[begin[at] + k]
        behind[at] = behind[at] << 8 | data[begin[at] + size[at] - 1 - k]
        rows += [_row(ahead[at], 10 + k), _row(behind[at], 20 + k)]
        owners += [at, at]
    rows.append(_row(np.array([zlib.crc32(f) for f in framed], dtype=np.uint32), 30))
    owners.append(everyone)
    listed = [(i, k) for i, w in enumerate(words) if w in lexicon for k in lexicon[w]]
    rows.append(_row(np.array([k for _, k in listed], dtype=np.uint32), 40))
    owners.append(np.array([i for i, _ in listed], dtype=np.int64))
    return np.concatenate(rows), np.concatenate(owners)


def _row(value: np.ndarray, kind: int) -> np.ndarray:
    """Row of the weight table for a feature's value."""
    mixed = (value ^ np.uint32(kind * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
    mixed = (mixed ^ mixed >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return (mixed >> np.uint32(16)) % np.uint32(BUCKETS)


def summed(weights: np.ndarray, rows: np.ndarray, owners: np.ndarray, words: int) -> np.ndarray:
    """Scores of the words: the sums of their features' weights."""
    return np.stack([np.bincount(owners, weights=w[rows], minlength=words) for w in weights.T], axis=1)


class Emissions(dict):
    """Word to the number of its row of scores, -1 without a letter; forgets all when it grows too long."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.fresh: list[str] = []
        self.rows = np.zeros((0, len(model.languages)), dtype=np.float32)

    def __missing__(self, word: str) -> int:
        inner = core(word)
        if inner == word:
            number = len(self.rows) + len(self.fresh)
            self.fresh.append(word)
        else:
            number = self[inner] if inner else -1
        self[word] = number
        return number

    def numbers(self, words: Sequence[str]) -> np.ndarray:
        """Rows of ``scores`` for the words."""
        if len(self) > REMEMBERED:
            self.clear()
            self.rows = self.rows[:0]
        found = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        if self.fresh:
            learnt = summed(self.model.weights, *features(self.fresh, self.model.lexicon), len(self.fresh))
            self.rows = np.concatenate([self.rows, learnt.astype(np.float32)])
            self.fresh = []
        return found


def _scaled(values: np.ndarray) -> np.ndarray:
    return values / np.maximum(values.sum(axis=-1, keepdims=True), 1e-30)


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Probabilities of the languages of all words of several documents laid end to end, slice by slice.

    Exact, yet in steps over all chunks of all documents at once: the transfer matrices of the chunks of long documents are built first; they carry the forward and
    backward vectors from chunk to chunk; then every chunk is run through from its own ends. A chunk is the longer the more languages there are, so that
    the matrices take a bounded number of bytes for each word.
    """
    k = scores.shape[1]
    chunk = CHUNK * max(1, k * k // 256)
    move = np.exp(transitions - transitions.max()).astype(np.float32)
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    per_doc = -(-lengths // chunk)
    doc_of = np.repeat(np.arange(len(lengths)), per_doc)
    nth = np.arange(len(doc_of)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    first = starts[doc_of] + nth * chunk
    size = np.minimum(chunk, lengths[doc_of] - nth * chunk)

    def ranges(count: int, words: np.ndarray) -> Iterator[tuple[int, int]]:
        """Neighbouring chunks whose scores fit into ``CELLS``."""
        lo = longest = 0
        for hi in range(count):
            longest = max(longest, int(words[hi]))
            if hi > lo and (hi + 1 - lo) * max(longest, k) * k > CELLS:
                yield lo, hi
                lo, longest = hi, int(words[hi])
        if count:
            yield lo, count

    def gathered(some: np.ndarray) -> np.ndarray:
        at = np.minimum(first[some, None] + np.arange(size[some].max()), len(scores) - 1)
        part = scores[at]
        return np.exp(part - part.max(axis=2, keepdims=True))

    long = np.flatnonzero(per_doc[doc_of] > 1)
    through = np.empty((len(long), k, k), dtype=np.float32)
    for lo, hi in ranges(len(long), size[long]):
        some = long[lo:hi]
        psi, valid = gathered(some), size[some]
        matrix = np.broadcast_to(np.eye(k, dtype=np.float32), (hi - lo, k, k)).copy()
        for t in range(valid.max(initial=0)):
            step = (matrix.reshape(-1, k) @ move).reshape(-1, k, k) * psi[:, t, None, :]
            step /= np.maximum(step.sum(axis=(1, 2), keepdims=True), 1e-30)
            matrix = np.where((t < valid)[:, None, None], step, matrix)
        through[lo:hi] = matrix

    left = np.ones((len(doc_of), k), dtype=np.float32) / k
    right = left.copy()
    place = np.zeros(len(doc_of), dtype=np.int64)
    place[long] = np.arange(len(long))
    order = long[np.argsort(nth[long], kind="stable")]
    turns = np.searchsorted(nth[order], np.arange(per_doc.max(initial=0) + 1))
    for j in range(1, per_doc.max(initial=0)):
        at = order[turns[j] : turns[j + 1]]
        left[at] = _scaled(np.einsum("nk,nkl->nl", left[at - 1], through[place[at - 1]]))
    for j in range(per_doc.max(initial=0) - 1, 0, -1):
        at = order[turns[j] : turns[j + 1]]
        right[at - 1] = _scaled(np.einsum("nkl,nl->nk", through[place[at]], right[at]))

    for lo, hi in ranges(len(doc_of), size):
        psi, valid = gathered(np.arange(lo, hi)), size[lo:hi]
        alpha = np.empty_like(psi)
        state = left[lo:hi]
        for t in range(psi.shape[1]):
            state = _scaled((state @ move) * psi[:, t])
            alpha[:, t] = state
        beta = right[lo:hi]
        for t in range(psi.shape[1] - 1, -1, -1):
            inside = (t < valid)[:, None]
            alpha[:, t] = _scaled(alpha[:, t] * beta)
            beta = np.where(inside, _scaled((beta * psi[:, t]) @ move.T), beta)
        keep = np.arange(psi.shape[1]) < valid[:, None]
        yield slice(int(first[lo]), int(first[hi - 1] + size[hi - 1])), alpha[keep]


def train(texts: list[tuple[str, str]], seed: int = 7) -> Model:
    """Fit on (text, language): sequences that switch between stretches of texts, so that the changes can be learned too.

    Maximises the likelihood of the word labels by full-batch Adam steps.
    """
    languages = sorted({lang for _, lang in texts})
    k = len(languages)
    spoken = [[[c for c in map(core, words_of(t)) if c] for t, lang in texts if lang == one] for one in languages]
    spoken = [[w for w in docs if w] for docs in spoken]
    common = [Counter(w for doc in docs for w in set(doc)) for docs in spoken]
    lexicon: dict[str, list[int]] = {}
    for i, counts in enumerate(common):
        for word in sorted(counts, key=lambda w: (-counts[w], w))[:LEXICON]:
            lexicon.setdefault(word, []).append(i)
    rng = random.Random(seed)
    usable = [i for i in range(k) if spoken[i]]
    model = Model(languages, np.zeros((BUCKETS, k)), lexicon, np.zeros((k, k)))
    if not usable:
        return model
    sequences, labels = [], []
    for _ in range(SEQUENCES):
        words: list[str] = []
        tags: list[int] = []
        while len(words) < LENGTH:
            one = rng.choice(usable)
            doc = rng.choice(spoken[one])
            many = rng.randint(*STRETCH)
            at = rng.randrange(max(1, len(doc) - many + 1))
            words += doc[at : at + many]
            tags += [one] * len(doc[at : at + many])
        sequences.append(words[:LENGTH])
        labels.append(tags[:LENGTH])
    kinds = {w: i for i, w in enumerate(dict.fromkeys(w for s in sequences for w in s))}
    rows, owners = features(list(kinds), lexicon)
    used, rows = np.unique(rows, return_inverse=True)
    x = np.array([[kinds[w] for w in s] for s in sequences])
    y = np.array(labels)
    truth = np.zeros((*y.shape, k))
    np.put_along_axis(truth, y[:, :, None], 1.0, axis=2)
    moves = np.zeros((k, k))
    np.add.at(moves, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1.0)
    weights, trans = np.zeros((len(used), k)), np.zeros((k, k))
    slots = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(trans), np.zeros_like(trans)]
    for step in range(1, STEPS + 1):
        emit = summed(weights, rows, owners, len(kinds))[x]
        psi = np.exp(emit - emit.max(axis=2, keepdims=True))
        move = np.exp(trans - trans.max())
        alpha, beta = np.empty_like(psi), np.ones_like(psi)
        state = np.ones((len(x), k)) / k
        for t in range(LENGTH):
            state = _scaled((state @ move) * psi[:, t])
            alpha[:, t] = state
        expected = np.zeros((k, k))
        for t in range(LENGTH - 1, 0, -1):
            out = beta[:, t] * psi[:, t]
            ahead = alpha[:, t - 1]
            both = np.maximum(((ahead @ move) * out).sum(axis=1, keepdims=True), 1e-300)
            expected += move * ((ahead / both).T @ out)
            beta[:, t - 1] = _scaled(out @ move.T)
        gamma = _scaled(alpha * beta)
        missed = (truth - gamma).reshape(-1, k)
        slope = np.zeros_like(weights)
        for c in range(k):
            per_kind = np.bincount(x.ravel(), weights=missed[:, c], minlength=len(kinds))
            slope[:, c] = np.bincount(rows, weights=per_kind[owners], minlength=len(used))
        steps = (slope - 0.5 * weights, moves - expected - 0.5 * trans)
        for i, (value, grad) in enumerate(zip((weights, trans), steps, strict=True)):
            first, second = slots[2 * i], slots[2 * i + 1]
            first += 0.1 * (grad - first)
            second += 0.01 * (grad * grad - second)
            value += 0.08 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    model.weights[used] = weights
    model.transitions = trans
    return model


def sample(docs: DataFrame, usable: Column, texts: int = TEXTS, max_bytes: int = MAX_BYTES) -> list[tuple[str, str]]:
    """At most ``texts`` whole texts of each language (fewer if there are over 64, see ``SAMPLE``) in the order of a hash of their ids, as (text, language).

    The ids are chosen from (doc_id, lang) alone, after a hash has thinned out what is frequent; their number is bounded, so the scan for the texts
    joins with a short list.
    """
    known = docs.select("doc_id", "lang").where(usable & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    sizes = known.groupBy("lang").count()
    languages = sizes.count()
    texts = min(texts, max(LEAST, SAMPLE // max(1, languages)))
    small = F.broadcast if languages <= 10_000 else lambda df: df  # of more languages Spark decides
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) * F.col("count") < F.lit(8 * texts * (1 << 20))
    thin = known.join(small(sizes), "lang").where(chance | (F.col("count") < 8 * texts)).select("doc_id", "lang").distinct()
    order = F.md5(F.col("doc_id").cast("string"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(order, "doc_id"))
    chosen = thin.withColumn("__rank", rank).where(F.col("__rank") <= texts).select("doc_id", "lang")
    whole = docs.select("doc_id", "lang", "text").where(F.octet_length("text").between(1, max_bytes))
    rows = whole.join(small(chosen), ["doc_id", "lang"])
    # Several rows of one id and language do not make the sample larger.
    one = rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).orderBy(order, "doc_id", "lang")
    return [(r["text"], r["lang"]) for r in one.collect()]


def _expected(texts: list[str | None], emissions: Emissions) -> np.ndarray:
    """Expected number of words of every language for each text."""
    model = emissions.model
    split = [words_of(t) for t in texts]
    numbers = emissions.numbers([w for s in split for w in s])
    owner = np.repeat(np.arange(len(texts)), [len(s) for s in split])[numbers >= 0]
    lengths = np.bincount(owner, minlength=len(texts))
    totals = np.zeros((len(texts), len(model.languages)))
    if not len(owner):
        return totals
    scores = emissions.rows[numbers[numbers >= 0]]
    for part, gamma in forward_backward(scores, lengths[lengths > 0], model.transitions):
        whose = owner[part]
        for c in range(len(model.languages)):
            totals[:, c] += np.bincount(whose, weights=gamma[:, c], minlength=len(texts))
    return totals


def _parts(texts: pd.Series, most: int) -> Iterator[list[str | None]]:
    """Slices of a batch of at most ``most`` characters, or one text."""
    held, size = [], 0
    for t in texts:
        if held and size + len(t or "") > most:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t or "")
    if held:
        yield held


def fit(docs: DataFrame, usable: Column) -> Model:
    return train(sample(docs, usable))


def language(text: Column, model: Model) -> Column:
    """Struct of ``lang`` and ``score``: the language with the most words by expectation, and its share of the words.

    ``und`` with score 0 for null and empty texts and those without a letter, and if nothing was learned.
    """
    fields = vars(model)

    @F.pandas_udf("lang string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        emissions = Emissions(Model(**fields))
        names = np.array([*emissions.model.languages, UNDETERMINED], dtype=object)
        most = (16 << 20) // max(4, len(names))
        for texts in batches:
            if len(names) == 1:
                yield pd.DataFrame({"lang": [UNDETERMINED] * len(texts), "score": 0.0})
                continue
            totals = np.concatenate([np.zeros((0, len(names) - 1)), *(_expected(part, emissions) for part in _parts(texts, most))])
            words = totals.sum(axis=1)
            best = np.where(words > 0, totals.argmax(axis=1), len(names) - 1)
            score = np.divide(totals.max(axis=1), words, out=np.zeros(len(totals)), where=words > 0)
            yield pd.DataFrame({"lang": names[best], "score": np.clip(score, 0.0, 1.0)})

    return of(text)


def label_words(text: Column, model: Model) -> Column:
    """Array of (word, lang, probability): every word of a text, in order, with its most probable language."""
    fields = vars(model)

    @F.pandas_udf("array<struct<word: string, lang: string, probability: double>>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        emissions = Emissions(Model(**fields))
        names = emissions.model.languages
        for texts in batches:
            labelled_texts = []
            for text in texts:
                words = [c for c in map(core, words_of(text)) if c] if names else []
                found: list[dict] = []
                if words:
                    numbers = emissions.numbers(words)
                    scores = emissions.rows[numbers]
                    for part, gamma in forward_backward(scores, np.array([len(words)]), emissions.model.transitions):
                        best = gamma.argmax(axis=1)
                        found += [
                            {"word": w, "lang": names[b], "probability": float(p)}
                            for w, b, p in zip(words[part], best, gamma.max(axis=1), strict=True)
                        ]
                labelled_texts.append(found)
            yield pd.Series(labelled_texts)

    return of(text)


def identify(docs: DataFrame, parts: int = 4, held: int = 2) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``.

    Learns text and non-null ``lang`` of ids whose crc32 modulo ``parts`` is not ``held``; the prediction looks at the text alone. Repeated rows are predicted alike.
    Input columns of the result's names are replaced.
    """
    model = fit(docs, labelled.id_remainder(F.col("doc_id"), parts) != held)
    found = docs.withColumn("__found", language(F.col("text"), model))
    return (
        found.withColumn("held_out", labelled.id_remainder(F.col("doc_id"), parts) == held)
        .withColumn("lang_pred", F.col("__found.lang"))
        .withColumn("score", F.col("__found.score"))
        .drop("__found")
    )
