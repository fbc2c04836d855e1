"""Queries on training logs, generation logs and run artifacts; ``events`` plays the log of many runs."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.functions.numeric import clamp_length, clamp_temperature, learning_rate, loss_or_missing, metric_line
from loomtext.operators import trainlog
from loomtext.operators.filters import is_milestone, is_reported_step
from loomtext.operators.bands import band_join
from loomtext.operators.series import last_known
from loomtext.plans.registry import query
from loomtext.plans.sql_parts import LOG
from loomtext.plans.tables import metric_log, table
from loomtext.session import scratch_path
from loomtext.sources import logs
from loomtext.sources.corpus import append_generations
from loomtext.streaming.metrics import read_evaluations, read_log_stream, stream_evaluations, stream_report_lines

RATE = """CASE WHEN step < 2000 THEN 3e-4::DOUBLE * (step / 2000)
  ELSE 3e-4::DOUBLE * greatest(0, 0.5::DOUBLE * (1 + cos(pi() * (step - 2000) / 9838))) END"""
# One bucket of 1,000 steps per window, so that the carry from bucket to bucket is in use.
SPAN = 1000


@query("""SELECT event_id AS step, printf('Step %d: loss=%.4f, lr=%.2e', event_id, value, value * 1e-7::DOUBLE) AS line
FROM events WHERE event_type = 'click'""")
def format_metric_line(spark, sf_dir):
    rows = table(spark, sf_dir, "events").where(F.col("event_type") == "click")
    line = metric_line(F.col("event_id"), F.col("value"), F.col("value") * F.lit(1e-7))
    return rows.select(F.col("event_id").alias("step"), line.alias("line"))


@query(f"WITH {LOG} SELECT run, step, loss FROM log WHERE loss IS NOT NULL AND (step <= 10 OR step % 100 = 0)")
def thin_metric_log(spark, sf_dir):
    log = metric_log(spark, sf_dir).where(F.col("loss").isNotNull() & is_reported_step(F.col("step")))
    return log.select("run", "step", "loss")


@query(f"WITH {LOG} SELECT run, step, loss, eval_loss FROM log WHERE step = 1 OR step % 500 = 0")
def milestone_rows(spark, sf_dir):
    return metric_log(spark, sf_dir).where(is_milestone(F.col("step"))).select("run", "step", "loss", "eval_loss")


@query("""SELECT event_id AS step, printf('Step %d: train_loss=%.4f, lr=%.2e', event_id, value, value * 1e-7::DOUBLE) AS line
FROM events WHERE event_type = 'click' AND (event_id <= 10 OR event_id % 100 = 0)
UNION ALL SELECT event_id, printf('Step %d: eval_loss=%.4f', event_id, value) FROM events WHERE event_type = 'view'""")
def detailed_metric_lines(spark, sf_dir):
    log = metric_log(spark, sf_dir).withColumn("lr", F.col("loss") * F.lit(1e-7))
    return trainlog.detailed_lines(log).select("step", "line")


PROMPT_VALUES = ", ".join(f"({i}, '{p}')" for i, p in enumerate(trainlog.PROMPTS))


@query(f"""SELECT event_id AS step, prompt_id, prompt FROM events, (VALUES {PROMPT_VALUES}) AS p(prompt_id, prompt)
WHERE event_type = 'view'""")
def prompt_step_grid(spark, sf_dir):
    steps = metric_log(spark, sf_dir).where(F.col("eval_loss").isNotNull()).select("step")
    return trainlog.prompt_grid(steps).withColumn("prompt_id", F.col("prompt_id").cast("bigint"))


ALIGNED = """m AS (SELECT user_id % 8 AS run, event_id // 10 AS step, avg(value) FILTER (event_type = 'click') AS loss,
  avg(value) FILTER (event_type = 'view') AS eval_loss FROM events GROUP BY 1, 2)"""


def aligned(spark, sf_dir):
    """Eight runs with averages of ten steps."""
    log = metric_log(spark, sf_dir).withColumns({"step": F.expr("step div 10"), "run": F.col("run") % 8})
    return trainlog.align_losses(log, ["run"])


@query(f"""WITH {ALIGNED}
SELECT run, step, round(step / 5919::DOUBLE, 4) AS epoch, round(loss, 6) AS loss, round(eval_loss, 6) AS eval_loss,
  round(eval_loss - loss, 6) AS gap FROM m WHERE loss IS NOT NULL AND eval_loss IS NOT NULL""")
def train_eval_join(spark, sf_dir):
    found = aligned(spark, sf_dir)
    return found.select("run", "step", "epoch", *[F.round(c, 6).alias(c) for c in ("loss", "eval_loss", "gap")])


@query(f"""WITH {LOG}, a AS (SELECT *, last_value(loss IGNORE NULLS) OVER (ORDER BY step) AS train_loss FROM log)
SELECT step, eval_loss, train_loss, coalesce(printf('%.4f', train_loss), 'N/A') AS shown
FROM a WHERE eval_loss IS NOT NULL""")
def asof_last_loss(spark, sf_dir):
    """All events as one run: no window sees more than one bucket of steps."""
    found = trainlog.latest_train_loss(metric_log(spark, sf_dir), span=SPAN)
    return found.select("step", "eval_loss", "train_loss", loss_or_missing(F.col("train_loss")).alias("shown"))


@query(f"""WITH {LOG}, a AS (SELECT *, last_value(loss IGNORE NULLS) OVER (PARTITION BY run ORDER BY step) AS train_loss FROM log)
SELECT run, step, eval_loss, train_loss FROM a WHERE eval_loss IS NOT NULL""")
def asof_last_loss_by_run(spark, sf_dir):
    found = trainlog.latest_train_loss(metric_log(spark, sf_dir), ["run"], span=SPAN)
    return found.select("run", "step", "eval_loss", "train_loss")


STAGE_CASE = " ".join(f"WHEN step >= {s} THEN '{n}'" for n, s in sorted(trainlog.STAGES, key=lambda x: -x[1]))


@query(f"""WITH {LOG} SELECT CASE {STAGE_CASE} END AS stage, count(*) AS rows, min(step) AS first_step,
  max(step) AS last_step, min(loss) AS lowest_loss, max(loss) AS highest_loss FROM log GROUP BY 1""")
def stage_band_join(spark, sf_dir):
    log = metric_log(spark, sf_dir).withColumn("stage", trainlog.stage_of(F.col("step")))
    return log.groupBy("stage").agg(
        F.count("*").alias("rows"), F.min("step").alias("first_step"), F.max("step").alias("last_step"),
        F.min("loss").alias("lowest_loss"), F.max("loss").alias("highest_loss"),
    )


LOSS_BAND_VALUES = ", ".join(
    f"('{n}', {'NULL' if lo is None else lo}::DOUBLE, {'NULL' if hi is None else hi}::DOUBLE)" for n, lo, hi in trainlog.LOSS_BANDS
)


@query(f"""WITH {LOG}, bands(band, low, high) AS (VALUES {LOSS_BAND_VALUES}), scaled AS (SELECT run, step, loss / 16::DOUBLE AS loss FROM log)
SELECT run, step, loss, band FROM scaled JOIN bands ON (low IS NULL OR loss >= low) AND (high IS NULL OR loss < high)""")
def loss_band_join(spark, sf_dir):
    """Train records and every published loss band they lie in; bands overlap. The values are scaled down to the range of the bands."""
    log = metric_log(spark, sf_dir).select("run", "step", (F.col("loss") / F.lit(16.0)).alias("loss"))
    bands = spark.createDataFrame(trainlog.LOSS_BANDS, "band string, low double, high double")
    return band_join(log, "loss", bands).select("run", "step", "loss", "band")


@query(f"""WITH {LOG} SELECT run, step, eval_loss FROM log WHERE eval_loss IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY run ORDER BY eval_loss, step) = 1""")
def best_step(spark, sf_dir):
    return trainlog.best_step(metric_log(spark, sf_dir), ["run"])


THRESHOLDS = [50.0, 20.0, 10.0, 5.0, 4.0, 1.0, 0.0]
THRESHOLD_VALUES = ", ".join(f"({t}::DOUBLE)" for t in THRESHOLDS)


@query(f"""WITH {LOG} SELECT run, t AS threshold, min(step) FILTER (loss < t) AS first_step
FROM log, (VALUES {THRESHOLD_VALUES}) AS v(t) GROUP BY run, t""")
def first_step_below(spark, sf_dir):
    return trainlog.first_steps_below(metric_log(spark, sf_dir), THRESHOLDS, ["run"])


@query(f"""WITH {LOG}, t AS (SELECT run, step, loss, lag(loss) OVER (PARTITION BY run ORDER BY step) AS previous
  FROM log WHERE loss IS NOT NULL) SELECT *, round(loss - previous, 6) AS delta FROM t""")
def loss_delta(spark, sf_dir):
    found = trainlog.loss_changes(metric_log(spark, sf_dir), ["run"], span=SPAN)
    return found.select("run", "step", "loss", "previous", F.round("delta", 6).alias("delta"))


@query(f"""WITH {LOG} SELECT step, round({RATE}, 12) AS lr,
  round({RATE.replace('step', '(step - 1)')}, 12) AS lr_before FROM log WHERE step >= 1""")
def lr_schedule(spark, sf_dir):
    """Rate at a step, and at the step before it, which is what a published log row shows."""
    steps = metric_log(spark, sf_dir).where(F.col("step") >= 1)
    return steps.select(
        "step", F.round("lr", 12).alias("lr"), F.round(learning_rate(F.col("step") - 1), 12).alias("lr_before")
    )


@query("""SELECT event_id, least(event_id, 300) AS max_length, greatest(value / 100, 0.1::DOUBLE) AS temperature FROM events""")
def clamp_params(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", clamp_length(F.col("event_id")).alias("max_length"),
        clamp_temperature(F.col("value") / 100).alias("temperature"),
    )


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown FROM events")
def format_timestamps(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("shown"))


@query("SELECT event_id, to_json({'run': user_id, 'step': event_id, 'kind': event_type}) AS config FROM events")
def config_json(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    config = F.struct(F.col("user_id").alias("run"), F.col("event_id").alias("step"), F.col("event_type").alias("kind"))
    return rows.select("event_id", F.to_json(config).alias("config"))


def artifacts(spark, sf_dir):
    """Events as files of runs: signups are final models, the rest checkpoints."""
    events = table(spark, sf_dir, "events")
    name = F.when(F.col("event_type") == "signup", "final_model").otherwise(
        F.concat(F.lit("checkpoint-"), F.col("event_id").cast("string"))
    )
    path = F.concat_ws("/", F.concat(F.lit("run-"), F.col("user_id").cast("string")), F.col("event_type"), name)
    listed = events.select(F.col("user_id").alias("run"), path.alias("path"))
    return listed.withColumn("step", trainlog.checkpoint_step(F.col("path")))


ARTIFACTS = """files AS (SELECT user_id AS run, CASE WHEN event_type <> 'signup' THEN event_id END AS step,
  'run-' || user_id || '/' || event_type || '/' ||
  CASE WHEN event_type = 'signup' THEN 'final_model' ELSE 'checkpoint-' || event_id END AS path FROM events)"""


@query(f"""WITH {ARTIFACTS} SELECT run, step, path, row_number() OVER (PARTITION BY run ORDER BY step DESC) AS rank
FROM files WHERE step IS NOT NULL QUALIFY row_number() OVER (PARTITION BY run ORDER BY step DESC) <= 3""")
def retain_newest_k(spark, sf_dir):
    kept = trainlog.newest_checkpoints(artifacts(spark, sf_dir), 3, ["run"])
    return kept.select("run", "step", "path", F.col("rank").cast("bigint").alias("rank"))


@query(f"""WITH {ARTIFACTS} SELECT run, coalesce(max(path) FILTER (step IS NULL), max_by(path, step)) AS path,
  max_by(path, step) AS last_checkpoint FROM files GROUP BY run""")
def latest_artifact(spark, sf_dir):
    files = artifacts(spark, sf_dir)
    latest = trainlog.latest_artifact(files, ["run"])
    checkpoints = trainlog.latest_artifact(files.where(F.col("step").isNotNull()), ["run"])
    return latest.join(checkpoints.withColumnRenamed("path", "last_checkpoint"), "run", "left")


@query("""WITH l AS (SELECT event_id, event_type,
  last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (ORDER BY event_id) AS header FROM events)
SELECT event_id, event_type, header FROM l WHERE event_type <> 'signup'""")
def fill_forward_header(spark, sf_dir):
    """Signups are headers; every other event belongs to the latest header before it."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    header = F.when(F.col("event_type") == "signup", F.col("event_id"))
    known = last_known(events, header, ["event_id"], "header", span=SPAN)
    return known.where(F.col("event_type") != "signup")


@query("""SELECT conv_id AS prompt, max(text) FILTER (turn = 0) AS step_0,
  max(text) FILTER (turn = 1) AS step_1, max(text) FILTER (turn = 2) AS step_2,
  max(text) FILTER (turn = 3) AS step_3, max(text) FILTER (turn = 4) AS step_4,
  max(text) FILTER (turn = 5) AS step_5, max(text) FILTER (turn = 6) AS step_6,
  max(text) FILTER (turn = 7) AS step_7, 0 AS elsewhere FROM conversations GROUP BY conv_id""")
def pivot_by_step(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    samples = turns.select(
        F.col("conv_id").alias("prompt"), F.col("turn").alias("step"), F.col("text").alias("generated")
    )
    steps = trainlog.steps_of(samples)
    return trainlog.samples_by_step(samples, steps).withColumnsRenamed({str(i): f"step_{i}" for i in steps})


@query(f"""WITH {LOG} SELECT step, loss, eval_loss, printf('%.2e', {RATE})::DOUBLE AS lr
FROM log WHERE loss IS NOT NULL OR eval_loss IS NOT NULL""")
def metric_log_roundtrip(spark, sf_dir):
    """Write the log in its text layout, read the text back."""
    log = metric_log(spark, sf_dir).where(F.col("loss").isNotNull() | F.col("eval_loss").isNotNull())
    path = scratch_path(spark, "metric-log")
    logs.format_metric_rows(log).select("line").write.text(path)
    return logs.read_metric_log(spark, path).select("step", "loss", "eval_loss", "lr")


@query(f"""WITH {ALIGNED}
SELECT step, round(step / 5919::DOUBLE, 4) AS epoch, round(loss, 6) AS loss, round(eval_loss, 6) AS eval_loss
FROM m WHERE loss IS NOT NULL AND eval_loss IS NOT NULL""")
def results_table_roundtrip(spark, sf_dir):
    """Write the aligned losses as a Markdown table, read the table back."""
    cells = [F.round("loss", 6), F.col("epoch"), F.col("step"), F.round("eval_loss", 6)]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[c.cast("string") for c in cells]), F.lit(" |"))
    path = scratch_path(spark, "results-table")
    aligned(spark, sf_dir).select(line).write.text(path)
    return logs.read_results_table(spark, path).select("step", "epoch", "loss", "eval_loss")


@query("""WITH t AS (SELECT conv_id, turn, role, regexp_replace(text, '[\\n\\r]', ' ', 'g') AS head FROM conversations),
h AS (SELECT conv_id, turn, head, last_value(CASE WHEN role = 'user' THEN conv_id * 100 + turn END IGNORE NULLS)
        OVER (ORDER BY conv_id, turn) AS step, role FROM t)
SELECT step, round(step / 8::DOUBLE, 4) AS loss, 'conv ' || conv_id AS prompt, head AS generated FROM h
WHERE role <> 'user' AND step IS NOT NULL""")
def generation_log_parse(spark, sf_dir):
    """Conversations as a generation log: user turns become headers, the other turns sample lines."""
    turns = table(spark, sf_dir, "conversations")
    step = F.col("conv_id") * 100 + F.col("turn")
    head = F.regexp_replace("text", "[\\n\\r]", " ")
    line = F.when(
        F.col("role") == "user", F.concat(F.lit("📝 Step "), step.cast("string"), F.lit(" | Loss: "), (step / 8).cast("string"))
    ).otherwise(F.concat(F.lit("   [conv "), F.col("conv_id").cast("string"), F.lit("] → "), head))
    lines = turns.select(F.lit("log").alias("file"), step.alias("line_no"), line.alias("line"))
    found = logs.parse_generation_lines(lines, span=SPAN)
    return found.select("step", F.round("loss", 4).alias("loss"), "prompt", "generated")


@query(f"""WITH {LOG} SELECT step, prompt_id, prompt FROM log, (VALUES {PROMPT_VALUES}) AS p(prompt_id, prompt)
WHERE step = 1 OR step % 500 = 0""")
def generation_append(spark, sf_dir):
    """Work rows of the milestone steps appended in two writes to one table, read back whole."""
    path = scratch_path(spark, "generations")
    milestones = metric_log(spark, sf_dir).where(is_milestone(F.col("step")))
    work = trainlog.prompt_grid(milestones.select("step"))
    for _ in range(2):  # the first batch comes twice, as after a failure
        append_generations(work.where(F.col("prompt_id") < 2), path, "first")
    append_generations(work.where(F.col("prompt_id") >= 2), path, "second")
    schema = T.StructType([*work.schema.fields, T.StructField("batch", T.StringType())])
    saved = spark.read.schema(schema).parquet(path)
    return saved.select("step", F.col("prompt_id").cast("bigint").alias("prompt_id"), "prompt")


def event_stream(spark, sf_dir, name_glob="events.parquet", files=1000):
    schema = table(spark, sf_dir, "events").schema if name_glob == "events.parquet" else spark.read.parquet(sf_dir).schema
    events = read_log_stream(spark, sf_dir, schema, "parquet", files, name_glob)
    return events.select(
        F.col("user_id").alias("run"), F.col("event_id").alias("step"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("loss"),
        F.when(F.col("event_type") == "view", F.col("value")).alias("eval_loss"),
        (F.col("value") * F.lit(1e-7)).alias("lr"),
    )


@query(f"""SELECT user_id AS run, event_id AS step,
  printf('Step %d: loss=%.4f, lr=%.2e', event_id, value, value * 1e-7::DOUBLE) AS line FROM events
WHERE event_type IN ('click', 'view') AND (event_id <= 10 OR event_id % 100 = 0)""")
def stream_report(spark, sf_dir):
    out, state = scratch_path(spark, "report"), scratch_path(spark, "report-state")
    stream_report_lines(event_stream(spark, sf_dir), out, state).awaitTermination()
    return spark.read.parquet(out).select("run", "step", "line")


@query(f"""WITH {LOG}, a AS (SELECT *, last_value(loss IGNORE NULLS) OVER (PARTITION BY run ORDER BY step) AS train_loss FROM log)
SELECT run, step, eval_loss, train_loss, prompt_id, prompt FROM a, (VALUES {PROMPT_VALUES}) AS p(prompt_id, prompt)
WHERE eval_loss IS NOT NULL""")
def stream_evaluate(spark, sf_dir):
    """The events arrive in several files, each with steps from all over the runs: most records are late."""
    arriving, out, state = (scratch_path(spark, f"evaluate-{n}") for n in ("in", "out", "state"))
    table(spark, sf_dir, "events").repartition(4, F.xxhash64("event_id")).write.parquet(arriving)
    stream_evaluations(event_stream(spark, arriving, "*.parquet", files=1), out, state, span=20 * SPAN).awaitTermination()
    found = read_evaluations(spark, out)
    return found.withColumn("prompt_id", F.col("prompt_id").cast("bigint"))
