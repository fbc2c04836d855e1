"""Both searches over vectors against brute force, on tables with everything that may be odd."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomtext.llm import negatives, neighbours
from loomtext.llm.tiles import Heaps

SCHEMA = "vec_id bigint, embedding array<float>, label int"
#: Columns whose names the operators use themselves.
CLASHES = "row, dim, tile, side, slab, group, asked, vector, score, rank, anchor, positives, usable, summary".split(", ")


def odd_vectors(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    single = lambda x: float(np.float32(x))
    vector = lambda n=12: [single(rng.gauss(0, 1)) for _ in range(n)]
    rows = [(i, vector(), i % 3) for i in range(120)]
    hot = vector()
    rows += [(200 + i, hot, i % 4) for i in range(60)]  # a third are one vector, so scores tie
    rows += [(400, vector(), 1)] * 3 + [(100, rows[5][1], 2)] * 2  # rows alike in every column, queries among them
    rows += [(500 + i, vector(5), i % 2) for i in range(20)]  # another length
    rows += [(600, None, 1), (620, [], 1), (640, [0.0] * 12, 1), (660, [None] + hot[1:], 1), (680, [math.nan] + hot[1:], 0), (700, [math.inf] + hot[1:], 0)]
    rows += [(None, vector(), 1), (None, hot, 2), (720, hot, None), (740, [single(1e30)] * 12, 1), (-20, vector(), 0), (800, vector(3), 1)]
    return rows


def usable(v) -> bool:
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def nearest_by_hand(rows, every, k):
    good = [(i, r) for i, r in enumerate(rows) if usable(r[1]) and any(r[1])]
    out = []
    for i, q in good:
        if q[0] is None or q[0] % every:
            continue
        found = []
        for j, c in good:
            if i != j and len(c[1]) == len(q[1]):
                score = 0.0
                for x, y in zip(q[1], c[1], strict=True):
                    score += x * y
                found.append((-score, c[0] is None, c[0] or 0, j, c[0]))
        out += [(q[0], n + 1, f[4], -f[0]) for n, f in enumerate(sorted(found)[:k])]
    return Counter(out)


@pytest.mark.parametrize(("resident", "least"), [(65_536, 8_192), (4, 16)])
def test_nearest_is_exact(spark, resident, least):
    rows = odd_vectors()
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    table = table.select("*", *[F.lit("user's own").alias(c) for c in CLASHES])
    got = neighbours.nearest(table, F.col("vec_id") % 20 == 0, k=7, resident=resident, least=least)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(map(tuple, got.collect())) == nearest_by_hand(rows, 20, 7)


def test_nearest_returns_all_if_fewer_and_nothing_of_nothing(spark):
    rows = [(0, [1.0, 0.0], 1), (20, [0.5, 0.5], 1), (1, [-1.0, 2.0], 1)]
    got = neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, k=20)
    assert sorted(map(tuple, got.collect())) == [(0, 1, 20, 0.5), (0, 2, 1, -1.0), (20, 1, 0, 0.5), (20, 2, 1, 0.5)]
    assert neighbours.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.lit(None).cast("boolean")).count() == 0


def test_rounding_bounds_hold_every_product():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(40, 1500)) * np.exp(rng.normal(size=(40, 1)) * 5)
    b = np.concatenate([rng.normal(size=(50, 1500)), np.zeros((1, 1500)), np.full((1, 1500), 5e-324)])
    lower, upper = neighbours.Rounded(a).bounds(slice(0, 40), neighbours.Rounded(b), slice(0, 52))
    exact = a @ b.T
    assert (lower <= exact).all() and (exact <= upper).all()
    assert np.median(upper - lower) < 0.1 * np.median(np.linalg.norm(a, axis=1)) * np.sqrt(1500)


def mined_by_hand(rows, labels, every, positives, negatives_, share):
    good = [(i, r[0], labels[i], [math.floor(256 * x) for x in r[1]]) for i, r in enumerate(rows) if usable(r[1]) and labels[i] is not None]
    order = lambda f: (-f[0], f[1] is None, f[1] or 0, f[2])
    out = []
    for i, name, label, v in good:
        if name is None or name % every:
            continue
        scored = [(sum(x * y for x, y in zip(v, w, strict=True)), n, j, lab) for j, n, lab, w in good if j != i and len(w) == len(v)]
        for p in sorted((s for s in scored if s[3] == label), key=order)[:positives]:
            fit = [s for s in scored if s[3] != label and share * p[0] <= 100 * s[0] <= 100 * p[0]]
            out += [(name, p[1], r + 1, n[1], p[0], n[0]) for r, n in enumerate(sorted(fit, key=order)[:negatives_])]
    return Counter(out)


@pytest.mark.parametrize(("resident", "least"), [(65_536, 8_192), (4, 16)])
def test_negatives_are_exact(spark, resident, least):
    rows = [r for r in odd_vectors() if r[0] != 740]  # its scores pass 2^53
    labels = [None if r[2] is None else (r[2] + 1) % 10 if r[0] is not None and r[0] % 7 == 0 else r[2] for r in rows]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    table = table.select("*", *[F.lit("user's own").alias(c) for c in CLASHES])
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.mine(table, F.col("vec_id") % 20 == 0, moved, resident=resident, least=least)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(map(tuple, got.collect())) == mined_by_hand(rows, labels, 20, 5, 5, 80)


def test_negatives_of_nothing_and_of_one_label(spark):
    assert negatives.mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0).count() == 0
    alone = spark.createDataFrame([(i, [1.0, float(i)], 1) for i in range(10)], SCHEMA)
    assert negatives.mine(alone, F.col("vec_id") % 5 == 0).count() == 0


def test_segment_bounds_hold_every_score_and_get_closer():
    rng = np.random.default_rng(7)
    for dim in (1, 3, 16, 37):
        smooth = np.floor(np.cumsum(rng.normal(size=(60, dim)), axis=1) * 40)
        lists = pa.array(smooth.tolist())
        data = negatives.Summarised(pa.table({"vector": lists, "summary": pa.array(negatives.summaries(smooth).tolist())}))
        exact, every, width = smooth @ smooth.T, slice(0, 60), []
        for level in range(len(negatives.LEVELS)):
            lower, upper = data.bounds(level, every, data, every)
            assert (lower <= exact).all() and (exact <= upper).all()
            of, at = np.nonzero(exact < np.inf)
            assert np.allclose(data.bounds(level, of, data, at)[1], upper.ravel())
            width.append((upper - lower).mean())
        assert width[1] <= width[0] + 1e-6


def test_heaps_keep_the_best_whatever_the_order():
    rng = random.Random(2)
    entries = [(rng.randrange(4), rng.randrange(6), rng.randrange(5), rng.random() < 0.2, n) for n in range(300)]
    heaps = Heaps(4, 6, np.int64)
    for at in range(0, 300, 37):
        part = entries[at : at + 37]
        heaps.add(*(np.array(c) for c in ([e[0] for e in part], [e[1] for e in part], [e[2] for e in part], [e[3] for e in part], [e[4] for e in part])))
    of, score, _, row = heaps.entries()
    for i in range(4):
        want = sorted((e for e in entries if e[0] == i), key=lambda e: (-e[1], e[3], e[2], e[4]))[:6]
        assert [(int(s), int(r)) for s, r in zip(score[of == i], row[of == i], strict=True)] == [(e[1], e[4]) for e in want]
