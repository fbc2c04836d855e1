"""Guards measured by the job that writes."""

import pytest
from pyspark.sql import functions as F

from loomtext.operators import guards
from loomtext.sources.corpus import materialize


def jobs_of(spark, name, action):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        action()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(name))


def blocks(spark, ids):
    rows = [(0, i, v) for i, v in enumerate(ids)]
    return spark.createDataFrame(rows, "batch long, block long, input_ids array<int>").repartition(3)


def test_a_guard_costs_no_job(spark, tmp_path):
    df, found = blocks(spark, [[1, 2], [3, 9], [4, 5]]), {}
    plain = jobs_of(spark, "plain", lambda: df.write.parquet(str(tmp_path / "plain")))
    watched = jobs_of(spark, "watched", lambda: found.update(guards.watched(df, guards.block_watch(10, 2), lambda d: d.write.parquet(str(tmp_path / "watched")))))
    assert watched == plain
    assert (found["blocks"], found["tokens"], found["max_id"], found["bad_blocks"], found["wrong_size"]) == (3, 6, 9, 0, 0)
    assert spark.read.parquet(str(tmp_path / "watched")).count() == 3


def test_blocks_are_refused(spark, tmp_path):
    write = lambda name: lambda d: d.write.parquet(str(tmp_path / name))
    with pytest.raises(ValueError, match=r"2 blocks have ids outside of 0..9; first \(batch, block\): \(0, 1\)"):
        guards.watched(blocks(spark, [[1], [10], [-1]]), guards.block_watch(10), write("a"))
    with pytest.raises(ValueError, match="1 blocks are not of 2"):
        guards.watched(blocks(spark, [[1, 2], [3]]), guards.block_watch(10, 2), write("b"))


def test_corpus_and_vocabulary_are_refused(spark, tmp_path):
    write = lambda name: lambda d: d.write.parquet(str(tmp_path / name))
    texts = spark.createDataFrame([("é\nb",), ("c",), (None,)], "text string")
    assert guards.watched(texts, guards.corpus_watch(7), write("c")) == {"texts": 2, "lines": 3, "bytes": 7}
    with pytest.raises(RuntimeError, match="7 bytes, fewer than 8"):
        guards.watched(texts, guards.corpus_watch(8), write("d"))
    pieces = spark.range(5).select(F.col("id").cast("int"), F.col("id").cast("string").alias("piece"))
    assert guards.watched(pieces, guards.vocab_watch(5, 5), write("e"))["pieces"] == 5
    for rows, watch, message in [
        (pieces, guards.vocab_watch(6), "fewer than 6"), (pieces.where("id != 2"), guards.vocab_watch(1), "not 0..V-1"), (pieces, guards.vocab_watch(1, 6), "model 6, tokenizer 5"),
    ]:
        with pytest.raises((RuntimeError, ValueError), match=message):
            guards.watched(rows, watch, write(message[:9].replace(" ", "-").replace(".", "-")))


def test_a_refused_stage_is_never_read_back(spark, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        with pytest.raises(ValueError, match="outside"):
            materialize(spark, root, "blocks", {}, lambda: blocks(spark, [[99]]), watch=guards.block_watch(10))
    assert materialize(spark, root, "blocks", {}, lambda: blocks(spark, [[9]]), watch=guards.block_watch(10)).count() == 1
    assert materialize(spark, root, "blocks", {}, lambda: blocks(spark, [[99]]), watch=guards.block_watch(10)).first()["input_ids"] == [9]
