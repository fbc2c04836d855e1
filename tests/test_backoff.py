"""The back-off model against the same sums in plain Python."""

import math
import random
from collections import Counter, defaultdict

import pytest

from loomtext.operators import backoff, ngrams


def by_hand(train, test, vocab_size, n):
    top = Counter(tuple(row[i : i + n]) for row in train for i in range(len(row) - n + 1))
    tables = {n: top}
    for k in range(n - 1, 0, -1):
        tables[k] = Counter(gram[1:] for gram in tables[k + 1])
    off = {}
    for k, table in tables.items():
        n1, n2, n3, n4 = (sum(c == i for c in table.values()) for i in range(1, 5))
        y = n1 / (n1 + 2 * n2) if n1 + n2 else None
        ds = [i - (i + 1) * y * b / a if a and y is not None else 0 for i, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1)]
        off[k] = [d if d > 0 else 0.75 for d in ds]
    discount = lambda k, c: off[k][min(c, 3) - 1]
    total, saved = defaultdict(int), defaultdict(float)
    for k, table in tables.items():
        for gram, c in table.items():
            total[k, gram[:-1]] += c
            saved[k, gram[:-1]] += discount(k, c)

    def p(gram, k):
        if k == 0:
            return 1 / vocab_size
        part, lower = gram[n - k :], p(gram, k - 1)
        if not total[k, part[:-1]]:
            return lower
        c = tables[k][part]
        return ((c - discount(k, c) if c else 0) + saved[k, part[:-1]] * lower) / total[k, part[:-1]]

    asked = [tuple(row[i : i + n]) for row in test for i in range(len(row) - n + 1)]
    return len(asked), sum(-math.log(p(g, n)) for g in asked) / len(asked), p


def rows_of(seed, count, length=40):
    """Texts in which a word mostly follows from the two before it."""
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        row = [rng.randrange(12), rng.randrange(12)]
        while len(row) < length:
            row.append((row[-1] * 3 + row[-2]) % 12 if rng.random() < 0.8 else rng.randrange(12))
        rows.append(row)
    return rows


@pytest.mark.parametrize("n", [1, 2, 3])
def test_loss_is_that_of_the_formulas(spark, n):
    train, test = rows_of(1, 30), [*rows_of(2, 5), [97, 98, 99, 5, 6]]
    df = spark.createDataFrame([("train", r) for r in [*train, [3], []]] + [("test", r) for r in test], "split string, input_ids array<int>").repartition(3)
    found = backoff.backoff_loss(df, 100, n).first()
    count, entropy, p = by_hand([*train, [3]], test, 100, n)
    assert found["ngrams"] == count
    assert math.isclose(found["cross_entropy"], entropy, rel_tol=1e-9) and math.isclose(found["perplexity"], math.exp(entropy), rel_tol=1e-9)
    if n == 3:
        assert math.isclose(sum(p((3, 4, w), 3) for w in range(100)), 1, rel_tol=1e-9)  # the shares of a context sum to one


def test_more_context_lowers_the_loss(spark):
    df = spark.createDataFrame([("train", r) for r in rows_of(3, 60)] + [("test", r) for r in rows_of(4, 10)], "split string, input_ids array<int>")
    pair = ngrams.heldout_cross_entropy(df, 12).first()["cross_entropy"]
    assert backoff.backoff_loss(df, 12, 3).first()["cross_entropy"] < pair - 0.3


def test_nothing_asked_or_learned(spark):
    rows = spark.createDataFrame([("train", [1, 2, 3])], "split string, input_ids array<int>")
    assert tuple(backoff.backoff_loss(rows, 10, 3).first()) == (0, None, None)
    alone = spark.createDataFrame([("test", [1, 2, 3])], "split string, input_ids array<int>")
    found = backoff.backoff_loss(alone, 10, 3).first()
    assert found["ngrams"] == 1 and math.isclose(found["cross_entropy"], math.log(10))


def test_ngrams_are_counted_once(spark, monkeypatch):
    """However many orders read the counts, the texts are cut into n-grams by one job, which writes them."""
    rows = [("train", r) for r in rows_of(5, 8)] + [("test", r) for r in rows_of(6, 2)]
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame(rows, "split string, input_ids array<int>").repartition(2).mapInArrow(watch, "split string, input_ids array<int>")
    backoff.backoff_loss(df, 20, 3).first()
    assert seen.value == len(rows)
