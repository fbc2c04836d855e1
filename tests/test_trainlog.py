import random

import pytest
from pyspark.sql import functions as F

from loomtext.operators import trainlog
from loomtext.operators.series import last_known
from loomtext.sources import logs

METRIC_LOG = """============================================================
    Step |     Loss |  Eval Loss |           LR
--------------------------------------------------
       1 |   9.0000 |      -     |        -
      10 |   8.5000 |      -     |     1.35e-06
      10 |     -    |     8.4000 |        -
      20 |   8.1000 |      -     |     2.85e-06---
library_name: x
"""

# The header and rule of the results table and the layout of the log lines are formats; the numbers are our own.
RESULTS = """### Training results

| Training Loss | Epoch  | Step  | Validation Loss |
|:-------------:|:------:|:-----:|:---------------:|
| 7.5        | 0.0845 | 500   | 7.25          |
| 6.5        | 0.1689 | 1000  | 6.75          |

| a | b |
"""

LIVE_LOG = """# samples
======================================================================
   [early] → belongs to no header
📝 Step 10 | Loss: 8.5000
======================================================================
   [prompt one] → prompt one continues
   [prompt two] → prompt two → [x] continues
======================================================================

📝 Step 20 | Loss: N/A
   [prompt one] → more
"""

EXTRACT = """## timeline
### Step 500 | Loss: 6.625 (early)
```
[p] → p a
[q] →\x20
```
### Step 1000 | Loss: 5.875 (later)
[p] → p b
"""


def test_metric_log(spark, tmp_path):
    (tmp_path / "log.txt").write_text(METRIC_LOG, encoding="utf-8")
    rows = sorted(map(tuple, logs.read_metric_log(spark, str(tmp_path / "log.txt")).collect()), key=str)
    assert rows == [(1, 9.0, None, None), (10, 8.5, None, 1.35e-06), (10, None, 8.4, None), (20, 8.1, None, 2.85e-06)]
    again = logs.format_metric_rows(logs.read_metric_log(spark, str(tmp_path / "log.txt"))).select("line")
    assert sorted(map(tuple, logs.parse_metric_lines(again).collect()), key=str) == rows


def test_results_table(spark, tmp_path):
    (tmp_path / "card.md").write_text(RESULTS, encoding="utf-8")
    rows = sorted(map(tuple, logs.read_results_table(spark, str(tmp_path / "card.md")).collect()))
    assert rows == [(500, 0.0845, 7.5, 7.25), (1000, 0.1689, 6.5, 6.75)]


@pytest.mark.parametrize("span", [1, 2, 100_000])
def test_generation_logs(spark, tmp_path, span):
    (tmp_path / "a.log").write_text(LIVE_LOG, encoding="utf-8")
    (tmp_path / "b.md").write_text(EXTRACT, encoding="utf-8")
    found = logs.parse_generation_lines(logs.placed_lines(spark, str(tmp_path)), span, ("block", "at"))
    rows = [(r["file"][-4:], r["step"], r["loss"], r["prompt"], r["generated"]) for r in found.orderBy("file", "block", "at").collect()]
    assert rows == [
        (".log", 10, 8.5, "prompt one", "prompt one continues"),
        ("a.log"[-4:], 10, 8.5, "prompt two", "prompt two → [x] continues"),
        (".log", 20, None, "prompt one", "more"),
        ("b.md", 500, 6.625, "p", "p a"),
        ("b.md", 500, 6.625, "q", ""),
        ("b.md", 1000, 5.875, "p", "p b"),
    ]


def log_frame(spark, rows):
    return spark.createDataFrame(rows, "run long, step long, loss double, eval_loss double, lr double")


@pytest.mark.parametrize("span", [1, 7, 1000])
@pytest.mark.parametrize("inclusive", [True, False])
def test_last_known_against_a_loop(spark, span, inclusive):
    rng = random.Random(5)
    rows = [(run, s, rng.choice([None, None, float(s)])) for run in (1, 2, 3) for s in range(0, 60, run)]
    df = spark.createDataFrame(rows, "run long, step long, v double").repartition(5)
    want, last = {}, {}
    for run, s, v in sorted(rows):
        before = last.get(run)
        if v is not None:
            last[run] = v
        want[run, s] = last.get(run) if inclusive else before
    got = last_known(df, F.col("v"), ["step"], "known", ["run"], inclusive, span).collect()
    assert {(r["run"], r["step"]): r["known"] for r in got} == want


def test_as_of_train_loss(spark):
    log = log_frame(spark, [(1, 5, None, 9.0, None), (1, 10, 8.5, None, None), (1, 10, None, 8.4, None),
                            (1, 11, 8.0, None, None), (1, 30, None, 7.0, None), (2, 30, None, 1.0, None)])
    kinds = log.withColumn("kind", F.when(F.col("loss").isNotNull(), 0).otherwise(1))
    got = trainlog.latest_train_loss(kinds, ["run"], ["step", "kind"], span=4).collect()
    assert {(r["run"], r["step"]): r["train_loss"] for r in got} == {(1, 5): None, (1, 10): 8.5, (1, 30): 8.0, (2, 30): None}


def test_aligned_losses(spark):
    log = log_frame(spark, [(1, 500, 7.5, None, None), (1, 500, None, 7.25, None), (1, 510, 7.39, None, None)])
    row = trainlog.align_losses(log, ["run"]).collect()
    assert len(row) == 1 and row[0]["epoch"] == 0.0845 and round(row[0]["gap"], 4) == -0.25


def test_best_step_takes_the_first_of_equals(spark):
    log = log_frame(spark, [(1, 30, None, 4.0, None), (1, 20, None, 4.0, None), (1, 10, None, 5.0, None),
                            (1, 5, 1.0, None, None), (2, 1, 3.0, None, None)])
    assert [tuple(r) for r in trainlog.best_step(log, ["run"]).collect()] == [(1, 20, 4.0)]


def test_loss_changes(spark):
    log = log_frame(spark, [(1, 1, 9.0, None, None), (1, 2, None, 1.0, None), (1, 30, 8.0, None, None), (2, 3, 7.0, None, None)])
    got = {(r["run"], r["step"]): (r["previous"], r["delta"]) for r in trainlog.loss_changes(log, ["run"], span=5).collect()}
    assert got == {(1, 1): (None, None), (1, 30): (9.0, -1.0), (2, 3): (None, None)}


def test_thresholds_and_stages(spark):
    log = log_frame(spark, [(1, s, 10.0 - s / 1000, None, None) for s in range(0, 7000, 500)])
    got = {r["threshold"]: r["first_step"] for r in trainlog.first_steps_below(log, [9.0, 5.0, 1.0]).collect()}
    assert got == {9.0: 1500, 5.0: 5500, 1.0: None}
    steps = spark.createDataFrame([(s,) for s in (0, 499, 500, 1499, 1500, 3000, 5999, 6000, 10**6, -1)], "s long")
    names = [r[0] for r in steps.orderBy("s").select(trainlog.stage_of(F.col("s"))).collect()]
    assert names == [None, "random noise", "random noise", "first grammar", "first grammar", "topic focus", "coherent",
                     "coherent", "knowledge", "knowledge"]


def test_report_lines(spark):
    log = log_frame(spark, [(1, 10, 8.5, None, 1.35e-6), (1, 11, 8.0, None, 1e-6), (1, 100, None, 7.0, None), (1, 200, None, None, 1.0)])
    got = [r["line"] for r in trainlog.report_lines(log).orderBy("step").collect()]
    assert got == ["Step 10: loss=8.5000, lr=1.35e-06", "Step 100: loss=7.0000, lr=0.00e+00"]


def test_detailed_lines(spark):
    log = log_frame(spark, [(1, 10, 8.5, 7.5, 1.35e-6), (1, 11, 8.0, None, 1e-6), (1, 13, None, 7.0, None), (1, 200, None, None, 1.0)])
    got = sorted(r["line"] for r in trainlog.detailed_lines(log).collect())
    assert got == ["Step 10: eval_loss=7.5000", "Step 10: train_loss=8.5000, lr=1.35e-06", "Step 13: eval_loss=7.0000"]


def test_prompt_grid(spark):
    rows = trainlog.prompt_grid(spark.createDataFrame([(1,), (2,)], "step long"), ["x", "y"]).collect()
    assert sorted((r["step"], r["prompt_id"], r["prompt"]) for r in rows) == [(1, 0, "x"), (1, 1, "y"), (2, 0, "x"), (2, 1, "y")]
    assert trainlog.prompt_grid(spark.createDataFrame([(1,)], "step long")).count() == 5


def artifact_rows(spark):
    paths = [(1, f"run/checkpoint-{s}") for s in (500, 1000, 9500, 11000)]
    paths += [(2, "run/checkpoint-7"), (2, "run/final_model"), (3, "run/notes.txt")]
    df = spark.createDataFrame(paths, "run long, path string")
    return df.withColumn("step", trainlog.checkpoint_step(F.col("path")))


def test_checkpoints_sort_as_numbers(spark):
    files = artifact_rows(spark)
    kept = trainlog.newest_checkpoints(files, 3, ["run"])
    assert sorted((r["run"], r["step"]) for r in kept.collect()) == [(1, 1000), (1, 9500), (1, 11000), (2, 7)]
    latest = {r["run"]: r["path"] for r in trainlog.latest_artifact(files, ["run"]).collect()}
    assert latest[1] == "run/checkpoint-11000" and latest[2] == "run/final_model"
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_pivot(spark):
    rows = [("p", 500, "a"), ("p", 1000, "b"), ("q", 500, "c"), ("q", 7, "ignored")]
    df = spark.createDataFrame(rows, "prompt string, step long, generated string")
    wide = trainlog.samples_by_step(df, [500, 1000])
    assert sorted(map(tuple, wide.collect()), key=str) == [("p", "a", "b", 0), ("q", "c", None, 1)]
    assert trainlog.steps_of(df) == [7, 500, 1000]
