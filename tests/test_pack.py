import hashlib
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from loomtext.operators import checks, order, pack


def frame(spark, docs, parts=3):
    rows = [(i, ids, len(ids)) for i, ids in enumerate(docs)]
    return spark.createDataFrame(rows, "pos long, input_ids array<int>, n int").repartition(parts)


def brute(docs, size, rows, keep_short=False):
    """Batch by batch: put all tokens in a list and cut it."""
    out = {}
    for batch in range(0, len(docs), rows):
        tokens = [t for d in docs[batch:batch + rows] for t in d]
        usable = len(tokens) if keep_short and len(tokens) < size else len(tokens) // size * size
        for at in range(0, usable, size):
            out[batch // rows, at // size] = tokens[at:at + size]
    return out


def packed(df, size, rows, keep_short=False):
    return {(r["batch"], r["block"]): r["input_ids"] for r in pack.pack_blocks(df, size, rows, keep_short).collect()}


def numbered(lengths):
    counter = iter(range(10**6))
    return [[next(counter) for _ in range(n)] for n in lengths]


@pytest.mark.parametrize("lengths", [
    [7], [8], [9], [0], [3, 0, 5], [30], [30, 1, 1, 30], [1] * 40, [8, 8, 8], [0, 0, 0, 17, 0, 6], [100, 0, 3],
])
@pytest.mark.parametrize("keep_short", [False, True])
def test_edges(spark, lengths, keep_short):
    docs = numbered(lengths)
    for rows in (1, 3, 100):
        assert packed(frame(spark, docs), 8, rows, keep_short) == brute(docs, 8, rows, keep_short)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 25), max_size=40), st.integers(1, 12), st.integers(1, 9), st.booleans())
def test_any_lengths(spark, lengths, size, rows, keep_short):
    docs = numbered(lengths)
    assert packed(frame(spark, docs), size, rows, keep_short) == brute(docs, size, rows, keep_short)


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_partitions_do_not_matter_and_tokens_add_up(spark, parts):
    rng = random.Random(3)
    docs = numbered([rng.choice([0, 1, 5, 40, 300]) for _ in range(120)])
    df = frame(spark, docs, parts)
    assert packed(df, 16, 25) == brute(docs, 16, 25)
    loss = pack.packing_loss(df, 16, 25).collect()
    totals = pack.block_totals(pack.pack_blocks(df, 16, 25)).first()
    assert totals["tokens"] == 16 * totals["blocks"] == 16 * sum(r["blocks"] for r in loss)
    assert sum(r["dropped"] for r in loss) + totals["tokens"] == sum(map(len, docs))
    assert all(r["dropped"] < 16 for r in loss)


def test_labels_and_shape(spark):
    blocks = pack.pack_blocks(frame(spark, numbered([50, 20])), 8, 2)
    assert tuple(checks.block_shape(blocks, 8).first()) == (8, 8, 8, 0, 0)
    short = pack.pack_blocks(frame(spark, numbered([5])), 8, 2, keep_short=True)
    assert tuple(checks.block_shape(short, 8).first()) == (1, 5, 5, 1, 0)


def test_one_shuffle_for_offsets_and_blocks(spark):
    plan = pack.pack_blocks(frame(spark, numbered([5])).select("pos", "input_ids"), 8, 2)._jdf.queryExecution().executedPlan()
    lines = [line for line in plan.toString().split("\n") if "Exchange hashpartitioning" in line]
    assert len(lines) == 1 and "batch" in lines[0]


def test_number_blocks(spark):
    blocks = pack.pack_blocks(frame(spark, numbered([50, 20, 0, 31, 90])), 8, 1).drop("labels")
    rows = pack.number_blocks(blocks, buckets=2).orderBy("block_id").collect()
    assert [r["block_id"] for r in rows] == list(range(len(rows)))
    assert [(r["batch"], r["block"]) for r in rows] == sorted((r["batch"], r["block"]) for r in rows)


def test_empty(spark):
    empty = frame(spark, numbered([0]))
    blocks = pack.pack_blocks(empty, 8, 2)
    assert blocks.count() == 0
    assert tuple(pack.block_totals(blocks).first()) == (0, 0)
    assert pack.number_blocks(blocks).count() == 0


def test_token_range(spark):
    blocks = pack.pack_blocks(frame(spark, numbered([80])), 8, 1)
    assert tuple(checks.token_range(blocks, 80).first()) == (10, 79, 0)
    checks.require_token_range(blocks, 80)
    assert tuple(checks.token_range(blocks, 79).first()) == (10, 79, 1)
    first = [tuple(r) for r in checks.token_range_offenders(blocks, 1).collect()]
    assert first == [(0, i, 8 * i + 7) for i in range(5)]
    with pytest.raises(ValueError, match="1 blocks have ids >= 79"):
        checks.require_token_range(blocks, 79)


def test_run_size(spark):
    totals = spark.createDataFrame([(568218, 0)], "blocks long, tokens long")
    # The published run has 568,218 blocks and batches of 96.
    assert tuple(checks.run_size(totals, 48, 2, 1).first()) == (568218, 96, 98304, 5918, 11836, 500)
    small = spark.createDataFrame([(10, 0)], "blocks long, tokens long")
    assert tuple(checks.run_size(small, 2, 1, 1, 8).first()) == (10, 2, 16, 5, 10, 1)


@pytest.mark.parametrize("groups", [1, 3, 65536])
@pytest.mark.parametrize("keep_short", [False, True])
def test_packing_in_shuffled_order(spark, monkeypatch, groups, keep_short):
    rng = random.Random(4)
    docs = numbered([rng.choice([0, 1, 5, 40, 130]) for _ in range(150)])
    rows = [(f"a:{i}", ids if i % 11 else None) for i, ids in enumerate(docs)]
    df = spark.createDataFrame(rows, "row_id string, input_ids array<int>").repartition(5)
    real = order.shuffle_groups
    monkeypatch.setattr(pack, "shuffle_groups", lambda d, n, s, r: real(d, n, s, r, groups))
    in_order = [ids or [] for _, ids in sorted(rows, key=lambda r: (hashlib.md5(f"42:{r[0]}".encode()).hexdigest(), r[0]))]
    for size, batch in ((16, 25), (64, 7), (1000, 2)):
        found = pack.pack_shuffled(df, size, batch, keep_short).collect()
        assert {(r["batch"], r["block"]): r["input_ids"] for r in found} == brute(in_order, size, batch, keep_short)


def test_groups_hold_whole_batches(spark):
    df = spark.range(1000).select(F.concat(F.lit("a:"), "id").alias("row_id")).repartition(7)
    rows = order.shuffle_groups(df, 30, groups=10).collect()
    assert {r["_step"] for r in rows} == {120}
    by_key = sorted(rows, key=lambda r: r["_key"])
    assert [r["_group"] for r in by_key] == [i // 120 for i in range(1000)]


def test_shuffled_packing_moves_the_ids_once(spark):
    df = spark.createDataFrame([(f"a:{i}", [1, 2]) for i in range(9)], "row_id string, input_ids array<int>")
    blocks = pack.pack_shuffled(df, 4, 2)
    blocks.collect()
    plan = blocks._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning(_group" in line]
    assert len(moved) == 1 and "hashpartitioning(batch" not in plan
