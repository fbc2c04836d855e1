import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from loomtext.plans import prepare
from loomtext.plans.settings import VARIANTS, Preparation
from loomtext.session import ensure_checkpoint_dir, frozen, scratch_path
from loomtext.sources import corpus, logs


def test_read_json_with_schema(spark, tmp_path):
    rows = [{"conv_id": 1, "turn": 0, "INSTRUCTION": "q", "RESPONSE": "a", "META": 1}, {"conv_id": 2, "turn": 0, "RESPONSE": "b"}]
    (tmp_path / "qa.json").write_text("\n".join(map(json.dumps, rows)))
    df = corpus.unify_qa(corpus.read_source(spark, str(tmp_path / "qa.json"), corpus.QA_SCHEMA, "json"))
    assert sorted(map(tuple, df.collect())) == [("q:1:0", "qa", "q\na"), ("q:2:0", "qa", "\nb")]
    with pytest.raises(ValueError, match="needs a schema"):
        corpus.read_source(spark, str(tmp_path), fmt="json")


def test_unify_and_union(spark):
    old = spark.createDataFrame([(1, "x", 9)], "doc_id long, completion string, extra int")
    new = spark.createDataFrame([(1, "y")], "doc_id long, text string")
    both = corpus.union_sources(corpus.unify_articles(old), corpus.unify_articles(new))
    assert sorted(map(tuple, both.collect())) == [("a:1", "articles", "x"), ("a:1", "articles", "y")]
    empty = spark.createDataFrame([(1, 0, None, None)], corpus.QA_SCHEMA)
    assert corpus.unify_qa(empty).count() == 0


def test_article_scan_is_pruned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = corpus.unify_articles(docs)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_qa_from_turns(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2"), (1, 4, "user", "q3"),
             (1, 5, "assistant", "a3"), (2, 0, "user", "q"), (2, 2, "assistant", "late")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = sorted((r["conv_id"], r["turn"], r["INSTRUCTION"], r["RESPONSE"]) for r in corpus.qa_from_turns(df).collect())
    assert got == [(1, 1, "q1", "a1"), (1, 4, "q3", "a3")]


def test_lines(spark, tmp_path):
    df = spark.createDataFrame([("a\nb",), ("c",)], "text string").repartition(2)
    corpus.write_lines(df, str(tmp_path / "out"))
    assert sorted(r["sentence"] for r in corpus.read_lines(spark, str(tmp_path / "out")).collect()) == ["a", "b", "c"]


def test_materialize_runs_once_per_parameter_set(spark, tmp_path):
    calls = []

    def build(n):
        def run():
            calls.append(n)
            return spark.range(n)
        return run

    root = str(tmp_path)
    assert corpus.materialize(spark, root, "s", {"n": 3}, build(3)).count() == 3
    assert corpus.materialize(spark, root, "s", {"n": 3}, build(9)).count() == 3
    assert corpus.materialize(spark, root, "s", {"n": 4}, build(4)).count() == 4
    assert calls == [3, 4]
    for note in tmp_path.glob("*.done"):
        note.rename(note.with_suffix(".gone"))
    assert corpus.materialize(spark, root, "s", {"n": 3}, build(5)).count() == 5


def test_generations_append(spark, tmp_path):
    path = str(tmp_path / "g")
    for step in (500, 1000, 500):  # a batch that comes again replaces itself
        corpus.append_generations(spark.createDataFrame([(step, 1.5, "p", f"text {step}")], "step long, loss double, prompt string, generated string"), path, f"b{step}")
    assert sorted((r["step"], r["generated"]) for r in spark.read.parquet(path).collect()) == [(500, "text 500"), (1000, "text 1000")]


def test_generations_of_many_steps_are_one_folder_a_batch(spark, tmp_path):
    steps = spark.range(300).repartition(2).select(F.col("id").alias("step"), F.lit("p").alias("prompt"))
    for batch, first in (("a", 0), ("b", 100), ("a", 150)):  # the first batch comes again with fewer steps
        corpus.append_generations(steps.where(F.col("step") >= first), str(tmp_path), batch)
    assert sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_dir()) == ["batch=a", "batch=b"]
    saved = sorted((r["batch"], r["step"]) for r in spark.read.parquet(str(tmp_path)).collect())
    assert saved == [("a", s) for s in range(150, 300)] + [("b", s) for s in range(100, 300)]
    for file in tmp_path.rglob("*.parquet"):
        inside = [r["step"] for r in spark.read.parquet(str(file)).collect()]
        assert len(inside) > 10 and inside == sorted(inside)


def test_artifacts(spark, tmp_path):
    for name, size in [("checkpoint-500/model.bin", 2_500_000), ("checkpoint-11000/model.bin", 10), ("final_model/config.json", 1)]:
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_bytes(b"x" * size)
    df = logs.list_artifacts(spark, str(tmp_path))
    assert sorted((r["step"] or 0, r["length"], r["megabytes"]) for r in df.collect()) == [(0, 1, 0.0), (500, 2_500_000, 2.5), (11000, 10, 0.0)]
    assert "content" not in df._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]


def test_checkpoint_folder(spark):
    folder = ensure_checkpoint_dir(spark)
    assert scratch_path(spark, "x") != scratch_path(spark, "x") and scratch_path(spark, "x").startswith(folder)
    df = frozen(spark.range(5).withColumn("r", F.rand()))
    assert df.collect() == df.collect()


def sources(spark, n=60):
    articles = spark.createDataFrame([(i, f"word{i % 7} and more words " * (i % 9)) for i in range(n)], "doc_id long, completion string")
    qa = spark.createDataFrame([(i, 0, f"why {i}", "because " * i) for i in range(n)], corpus.QA_SCHEMA)
    return articles, qa


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_preparation_does_not_depend_on_partitions(spark, parts):
    articles, qa = sources(spark)
    cfg = Preparation(vocab_kind="frequency", vocab_size=20, block_size=16, batch_rows=10, length_low=5, vocab_sample=50)
    want = prepare.corpus_to_blocks(articles, qa, cfg).collect()
    got = prepare.corpus_to_blocks(articles.repartition(parts), qa.repartition(parts), cfg).collect()
    assert sorted(got) == sorted(want) and len(want) > 50


def test_block_splits(spark):
    articles, qa = sources(spark)
    base = dict(vocab_kind="frequency", vocab_size=20, block_size=16, batch_rows=10, length_low=5, holdout_rows=7)
    blocks = frozen(prepare.corpus_to_blocks(articles, qa, Preparation(**base)))
    n = blocks.count()
    sizes = {}
    for holdout in ("none", "share", "random", "head"):
        train, held = prepare.split_blocks(blocks, Preparation(**base, holdout=holdout))
        sizes[holdout] = (train.count(), held.count() if held is not None else None)
    test = -(-n * 2 // 100)
    assert sizes == {"none": (n, None), "share": (n - test, test), "random": (n, 7), "head": (n, 7)}
    with pytest.raises(ValueError):
        prepare.split_blocks(blocks, Preparation(holdout="x"))


def test_variants():
    assert set(VARIANTS) == {"single_source", "two_source", "dual_gpu", "consumer_gpu", "published"}
    assert {v.batch_rows for v in VARIANTS.values()} == {1000, 2000, 5000}


def test_executors_do_not_need_the_package(tmp_path):
    """A driver in another folder: its Python workers cannot import the package by themselves."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from loomtext.session import local_session
spark = local_session(cpus=2)
for name in ("corpus_to_blocks", "normalize_text", "decode_words"):
    print(name, len(entry.queries()[name](spark, "/root/testdata/sf0.001").collect()) > 0)
"""
    found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert found.stdout.count("True") == 3, found.stderr[-2000:]


def test_preparation_with_subwords(spark):
    articles, qa = sources(spark)
    cfg = Preparation(vocab_kind="unigram", normalization="nfkc_cf", vocab_size=60, block_size=16, batch_rows=10,
                      length_low=5, sentence_cap=100, sentence_bytes=200, coverage=1.0)
    corpus_rows = prepare.corpus_of(articles, qa, cfg)
    found = prepare.vocabulary_of(corpus_rows, cfg)
    assert found.count() <= 60
    blocks = prepare.corpus_to_blocks(articles, qa, cfg).collect()
    assert len(blocks) > 20 and all(len(b["input_ids"]) == 16 and max(b["input_ids"]) < 60 for b in blocks)
    with pytest.raises(ValueError):
        prepare.vocabulary_of(corpus_rows, Preparation(vocab_kind="x"))


def test_id_passes_over_qa_move_no_text(spark):
    turns = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", None)], "conv_id long, turn long, role string, text string")
    ids = corpus.unify_qa(corpus.qa_from_turns(turns)).select("row_id")
    assert [r["row_id"] for r in ids.collect()] == ["q:1:0"]
    plan = ids._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[plan.index("Join"):].splitlines()
    assert not any("INSTRUCTION" in line or "RESPONSE" in line for line in joined)


def test_materialize_notices_changed_inputs(spark, tmp_path):
    source = str(tmp_path / "in")
    build = lambda: spark.read.parquet(source)
    root = scratch_path(spark, "m")
    spark.range(3).write.parquet(source)
    assert corpus.materialize(spark, root, "s", {}, build, [source]).count() == 3
    spark.range(2).write.mode("append").parquet(source)
    assert corpus.materialize(spark, root, "s", {}, build, [source]).count() == 5
