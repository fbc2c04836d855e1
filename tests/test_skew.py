"""One key, document or run holding a large part of the data: results stay right and groups stay small."""

from collections import Counter

from pyspark.sql import functions as F

from loomtext.operators import encode, ngrams, order, pack, trainlog, vocab
from loomtext.operators.series import last_known
from loomtext.sources.corpus import qa_from_turns


def test_one_document_and_one_word_dominate(spark):
    texts = ["hot " * 40_000] + [f"hot w{i} x" for i in range(300)]
    docs = spark.createDataFrame([(f"a:{i}", t) for i, t in enumerate(texts)], "row_id string, text string").repartition(4)
    counts = {r["tok"]: r["n"] for r in vocab.token_counts(docs).collect()}
    assert counts["▁hot"] == 40_300
    found = vocab.frequency_vocab(vocab.token_counts(docs), 50)
    coded = encode.encode_words(docs, found)
    pairs = {(r["prev"], r["next"]): r["n"] for r in ngrams.pair_counts(coded).collect()}
    want = Counter()
    for r in coded.collect():
        want.update(zip(r["input_ids"], r["input_ids"][1:]))
    assert pairs == dict(want)
    blocks = pack.pack_shuffled(coded, 128, 20)
    sizes = [len(r["input_ids"]) for r in blocks.collect()]
    total = coded.agg(F.sum(F.size("input_ids"))).first()[0]
    assert set(sizes) == {128} and 0 <= total - sum(sizes) < 128 * 16


def test_one_conversation_holds_all_turns(spark):
    turns = spark.range(6000).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), "id").alias("text"),
    )
    found = qa_from_turns(turns)
    assert found.count() == 3000
    assert found.where(F.substring("RESPONSE", 2, 9).cast("long") != F.col("turn") + 1).count() == 0


def test_one_run_is_cut_into_spans(spark):
    n = 5000
    log = spark.range(n).select(
        F.floor(F.rand(1)).alias("run"), F.col("id").alias("step"),
        F.when(F.col("id") % 1000 == 10, F.col("id").cast("double")).alias("loss"),
        F.when(F.col("id") % 10 == 9, F.lit(1.0)).alias("eval_loss"),
    ).repartition(5)
    found = trainlog.latest_train_loss(log, ["run"], span=50).collect()
    assert len(found) == n // 10
    for r in found:
        want = (r["step"] - 10) // 1000 * 1000 + 10
        assert r["train_loss"] == (float(want) if want >= 0 else None)
    plan = last_known(log, F.col("loss"), ["step"], "x", ["run"], span=50)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [last(_value" in line]
    assert windows and all("_span" in line for line in windows)


def test_positions_of_clustered_ids(spark):
    """Ids in two far-apart clumps: the buckets still hold about the same number of rows."""
    ids = spark.range(4000).select(F.when(F.col("id") < 3990, F.col("id")).otherwise(F.col("id") * 10**12).alias("k"))
    found = order.source_positions(ids, "k", bucket_rows=1)
    rows = sorted((r["k"], r["pos"]) for r in found.collect())
    assert [p for _, p in rows] == list(range(4000))
