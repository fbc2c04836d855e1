import json
import os
import random

from pyspark.sql import functions as F

from loomtext.operators import trainlog
from loomtext.streaming import metrics

ROWS = [
    [(1, 5, None, 9.0, None), (1, 10, 8.5, None, 1e-6), (2, 10, 3.0, None, 1e-6)],
    [(1, 10, None, 8.4, None), (1, 11, 8.0, None, 2e-6)],
    [(2, 30, None, 2.0, None)],
    [(1, 100, 7.5, None, 3e-6), (1, 100, None, 7.0, None), (2, 200, 1.0, None, 3e-6)],
]
NAMES = ["run", "step", "loss", "eval_loss", "lr"]


def write_files(folder):
    """One file per micro-batch, in the order of their modification times."""
    for i, rows in enumerate(ROWS):
        path = folder / f"{i}.json"
        path.write_text("\n".join(json.dumps({k: v for k, v in zip(NAMES, r) if v is not None}) for r in rows))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def test_report_lines_equal_the_batch_result(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write_files(source)
    stream = metrics.read_log_stream(spark, str(source), files=1)
    metrics.stream_report_lines(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    batch = trainlog.report_lines(spark.read.schema(metrics.LOG_SCHEMA).json(str(source)))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["line"] for r in got.collect()) == sorted(r["line"] for r in batch.collect())
    assert got.count() == 7


def test_evaluations_equal_the_batch_result(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write_files(source)
    out, state = (str(tmp_path / n) for n in ("out", "state"))

    def run():
        stream = metrics.read_log_stream(spark, str(source), files=1)
        metrics.stream_evaluations(stream, out, state, ["p", "q"]).awaitTermination()

    run()
    log = spark.read.schema(metrics.LOG_SCHEMA).json(str(source))
    log = log.withColumn("kind", F.when(F.col("loss").isNotNull(), 0).otherwise(1))
    batch = trainlog.prompt_grid(trainlog.latest_train_loss(log, ["run"], ["step", "kind"]), ["p", "q"])
    columns = ["run", "step", "eval_loss", "train_loss", "prompt"]

    def rows(df):
        return sorted(map(tuple, df.select(*columns).collect()), key=str)

    found = metrics.read_evaluations(spark, out)
    assert rows(found) == rows(batch)
    assert {(r["run"], r["step"]): r["train_loss"] for r in found.collect()} == {(1, 5): None, (1, 10): 8.5, (2, 30): 3.0, (1, 100): 7.5}
    # A later file continues from the carried tail.
    (source / "9.json").write_text(json.dumps({"run": 2, "step": 300, "eval_loss": 0.5}))
    run()
    found = metrics.read_evaluations(spark, out)
    assert [r["train_loss"] for r in found.where("step = 300").collect()] == [1.0, 1.0]


def test_late_records_correct_earlier_evaluations(spark, tmp_path):
    records = [{"run": 1, "step": 10, "loss": 8.5}, {"run": 1, "step": 100, "loss": 7.0}, {"run": 1, "step": 50, "eval_loss": 8.0}]
    records += [{"run": 2, "step": 7, "loss": 3.0}, {"run": 1, "step": 40, "loss": 8.1}, {"run": 2, "step": 6, "eval_loss": 1.0}]
    for order in ([0, 1, 2, 3, 4, 5], [2, 5, 1, 4, 0, 3]):
        base = tmp_path / "".join(map(str, order))
        (base / "in").mkdir(parents=True)
        for i, k in enumerate(order):
            path = base / "in" / f"{i}.json"
            path.write_text(json.dumps(records[k]))
            os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
        stream = metrics.read_log_stream(spark, str(base / "in"), files=1)
        places = [str(base / n) for n in ("out", "state")]
        metrics.stream_evaluations(stream, *places, ["p"], span=20).awaitTermination()
        found = {(r["run"], r["step"]): r["train_loss"] for r in metrics.read_evaluations(spark, places[0]).collect()}
        assert found == {(1, 50): 8.1, (2, 6): None}


def test_shuffled_files_equal_the_batch_result(spark, tmp_path):
    rng = random.Random(5)
    records = []
    for step in rng.sample(range(600), 420):
        kind = "loss" if rng.random() < 0.4 else "eval_loss"
        records.append({"run": rng.choice([1, 1, 1, 2]), "step": step, kind: round(rng.random(), 4)})
    records += [{"run": 1, "step": 5, "eval_loss": 0.5}, {"run": 1, "step": 5, "eval_loss": 0.25}, {"run": 3, "step": None, "loss": 1.0}]
    rng.shuffle(records)
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for i in range(6):
        path = source / f"{i}.json"
        path.write_text("\n".join(map(json.dumps, records[i::6])))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    stream = metrics.read_log_stream(spark, str(source), files=1)
    metrics.stream_evaluations(stream, out, str(tmp_path / "state"), ["p"], span=50).awaitTermination()
    known = [r for r in records if r["step"] is not None]
    want = []
    for r in known:
        if "eval_loss" in r:
            before = [(t["step"], t["loss"]) for t in known if t["run"] == r["run"] and "loss" in t and t["step"] <= r["step"]]
            want.append((r["run"], r["step"], r["eval_loss"], max(before)[1] if before else None, 0, "p"))
    found = metrics.read_evaluations(spark, out)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_a_batch_writes_only_what_it_changes(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    files = [[{"run": 1, "step": 10 * i, "loss": 9.0 - i}, {"run": 1, "step": 10 * i + 5, "eval_loss": 9.5 - i}] for i in range(6)]
    files.append([{"run": 1, "step": 21, "loss": 1.5}])  # late: changes the evaluation of step 25 alone
    for i, rows in enumerate(files):
        path = source / f"{i}.json"
        path.write_text("\n".join(map(json.dumps, rows)))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    stream = metrics.read_log_stream(spark, str(source), files=1)
    query = metrics.stream_evaluations(stream, out, str(tmp_path / "state"), ["p"], span=100)
    query.awaitTermination()
    written = spark.read.parquet(out).where("kind = 'evaluation'").groupBy("batch").agg(F.collect_list("step").alias("steps")).collect()
    assert {r["batch"]: r["steps"] for r in written} == {**{i: [10 * i + 5] for i in range(6)}, 6: [25]}
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [2] * 6 + [1]
    losses = {r["step"]: r["train_loss"] for r in metrics.read_evaluations(spark, out).collect()}
    assert losses == {5: 9.0, 15: 8.0, 25: 1.5, 35: 6.0, 45: 5.0, 55: 4.0}
