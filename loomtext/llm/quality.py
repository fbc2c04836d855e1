"""Quality by compression: how much better does the dictionary of good text compress a text than that of bad text?"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.llm import labelled, logistic

#: Bound of the fitted sample: examples per class, and the bytes of the longest one.
EXAMPLES, MAX_BYTES = 3000, 1 << 16
DICTIONARY_BYTES = 112_640
LEVEL = 3
#: Samples for the dictionary trainer.
PIECE = 4096


@dataclass(frozen=True)
class Model:
    """Two dictionaries, and the calibration of what they make of a text. Without both classes, only ``offset`` counts."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    offset: float


def _dictionary(texts: list[bytes], size: int) -> bytes:
    pieces = [t[i : i + PIECE] for t in texts for i in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their own bytes do
        return b"".join(texts)[-size:]


def _compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(dictionary)
    held.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=held, write_content_size=False, write_dict_id=False)


def features(texts: list[bytes], good: bytes, bad: bytes, level: int = LEVEL) -> np.ndarray:
    """Per text the normalised difference of the compressed sizes, the sizes, the length, and their products."""
    with_good, with_bad = _compressor(good, level), _compressor(bad, level)
    sizes = np.array([(len(with_good.compress(t)), len(with_bad.compress(t)), len(t) + 1) for t in texts], dtype=float).reshape(-1, 3)
    g, b, n = sizes.T
    base = np.stack([(g - b) / n, np.log(n), np.log((g + 1) / n), np.log((b + 1) / n)], axis=1)
    i, j = np.triu_indices(base.shape[1])
    return np.hstack([base, base[:, i] * base[:, j]])


def fit(docs: DataFrame, labels: DataFrame, label: str, usable: Column, examples: int = EXAMPLES, max_bytes: int = MAX_BYTES) -> Model:
    """Fit on at most ``examples`` labelled texts per class.

    Each half is measured with the dictionaries of the other half to calibrate the score; then both halves make the final dictionaries.

    Without labels of both classes the score is the share of class 1, smoothed (0.5 without any).
    """
    rows = labelled.sample(docs, labels, label, usable, examples, max_bytes)
    halves = [[(t.encode(), c) for _, t, c in half] for half in labelled.split_half(rows)]
    if any(sum(r[1] == c for r in half) == 0 for c in (0, 1) for half in halves):
        ones = sum(c for _, _, c in rows)
        return Model(b"", b"", (), float(np.log((ones + 1) / (len(rows) - ones + 1))))

    def dictionaries(some: list[tuple[bytes, int]]) -> list[bytes]:
        return [_dictionary([t for t, c in some if c == one], DICTIONARY_BYTES) for one in (1, 0)]

    seen = [features([t for t, _ in halves[1 - i]], *dictionaries(halves[i])) for i in (0, 1)]
    classes = np.array([c for half in reversed(halves) for _, c in half], dtype=float)
    weights, offset = logistic.fit(np.vstack(seen), classes)
    return Model(*dictionaries(halves[0] + halves[1]), tuple(weights), offset)


def score(text: Column, model: Model) -> Column:
    """Calibrated probability of class 1. Null counts as the empty text; texts of any length are compressed whole."""
    good, bad, weights, offset, level = model.good, model.bad, np.array(model.weights), model.offset, LEVEL

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if len(weights):
                z = np.concatenate(
                    [np.zeros(0)]
                    + [
                        features([t.encode() if t else b"" for t in texts[i : i + 512]], good, bad, level) @ weights
                        for i in range(0, len(texts), 512)
                    ]
                )
            else:
                z = np.zeros(len(texts))
            yield pd.Series(logistic.sigmoid(z + offset))

    return of(text)


def score_documents(docs: DataFrame, labels: DataFrame, parts: int = 4, held: int = 2, keep: float = 0.7) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted`` (1 if the score is at least ``keep``).

    Learns ``labels.quality`` of ids whose crc32 modulo ``parts`` is not ``held``; the score looks at the text alone. Null
    and empty texts are scored like any other, repeated rows alike. Input columns of these names are replaced.
    """
    model = fit(docs, labels, "quality", labelled.id_remainder(F.col("doc_id"), parts) != held)
    scored = docs.withColumn("score", score(F.col("text"), model))
    return scored.withColumn("held_out", labelled.id_remainder(F.col("doc_id"), parts) == held).withColumn(
        "predicted", (F.col("score") >= keep).cast("int")
    )
