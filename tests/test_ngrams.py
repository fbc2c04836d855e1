import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from loomtext.operators import ngrams


def rows(seed=1, n=40):
    rng = random.Random(seed)
    return [[rng.choice([1, 1, 1, 2, 3, 4, 5]) for _ in range(rng.choice([0, 1, 2, 9, 30]))] for _ in range(n)]


def frame(spark, data):
    return spark.createDataFrame(
        [(i, ids, "test" if i % 4 == 0 else "train") for i, ids in enumerate(data)], "i int, input_ids array<int>, split string"
    ).repartition(4)


def pairs(data):
    return Counter(p for ids in data for p in zip(ids, ids[1:]))


def test_pair_counts(spark):
    got = {(r["prev"], r["next"]): r["n"] for r in ngrams.pair_counts(frame(spark, [*rows(), None])).collect()}
    assert got == dict(pairs(rows()))


@pytest.mark.parametrize("temperature,top_k,top_p", [(1.0, 50, 0.95), (0.8, 3, 0.95), (2.0, 2, 1.0), (0.8, 50, 0.3)])
def test_candidates(spark, temperature, top_k, top_p):
    by_context = defaultdict(list)
    for (a, b), n in pairs(rows()).items():
        by_context[a].append((-n, b))
    want = {}
    for a, choices in by_context.items():
        kept = [(b, (-n) ** (1 / temperature)) for n, b in sorted(choices)[:top_k]]
        total, mass = sum(w for _, w in kept), 0.0
        for b, w in kept:
            if mass < top_p * total:
                want[a, b] = w / total
            mass += w
    got = ngrams.sampling_candidates(ngrams.pair_counts(frame(spark, rows())), temperature, top_k, top_p).collect()
    assert {(r["prev"], r["next"]): round(r["share"], 9) for r in got} == {k: round(v, 9) for k, v in want.items()}


def test_cross_entropy(spark):
    data = rows()
    train = pairs(ids for i, ids in enumerate(data) if i % 4)
    test = pairs(ids for i, ids in enumerate(data) if i % 4 == 0)
    context = Counter()
    for (a, _), n in train.items():
        context[a] += n
    nll = sum(n * -math.log((train[p] + 0.5) / (context[p[0]] + 0.5 * 6)) for p, n in test.items()) / sum(test.values())
    got = ngrams.heldout_cross_entropy(frame(spark, data), 6, 0.5).first()
    assert got["pairs"] == sum(test.values())
    assert math.isclose(got["cross_entropy"], nll) and math.isclose(got["perplexity"], math.exp(nll))


def test_repetition(spark):
    data = [[], [1], [1, 2], [1, 2, 1, 2], [7, 7, 7, 7, 7], None]
    got = {r["i"]: r["s"] for r in frame(spark, data).select("i", ngrams.repeated_pair_share(F.col("input_ids")).alias("s")).collect()}
    assert got == {0: None, 1: None, 2: 0.0, 3: pytest.approx(1 / 3), 4: 0.75, 5: None}
