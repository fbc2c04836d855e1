"""Analysis of training and generation logs: ``(run, step, loss, eval_loss, lr)`` and ``(step, prompt, generated)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomtext.functions.numeric import epoch, fixed, metric_line
from loomtext.operators.filters import is_reported_step
from loomtext.operators.series import SPAN, last_known

# The prompts every evaluation is sampled with.
PROMPTS = ["中国的历史", "人工智能是", "今天天气", "在科学研究中", "教育的目的"]

# Stages of a run by step, from the first step (inclusive) to the next stage.
STAGES = [
    ("random noise", 0),
    ("first grammar", 500),
    ("topic focus", 1500),
    ("coherent", 3000),
    ("knowledge", 6000),
]
# The published loss bands of the stages, (stage, from, up to); they overlap.
LOSS_BANDS = [
    ("random noise", 6.0, None),
    ("first grammar", 5.3, 6.7),
    ("topic focus", 4.8, 5.4),
    ("coherent", 4.4, 4.8),
    ("knowledge", None, 4.4),
]


def report_lines(log: DataFrame, label: str = "loss") -> DataFrame:
    """The formatted lines a run prints: reported steps that have a train or evaluation loss."""
    loss = F.coalesce("loss", "eval_loss")
    return log.where(is_reported_step(F.col("step")) & loss.isNotNull()).withColumn(
        "line", metric_line(F.col("step"), loss, F.col("lr"), label)
    )


def detailed_lines(log: DataFrame) -> DataFrame:
    """The lines of the detailed log: train losses of reported steps with their rate, and every
    evaluation loss. A row with both gives two lines."""
    train = F.when(is_reported_step(F.col("step")), metric_line(F.col("step"), F.col("loss"), F.col("lr"), "train_loss"))
    evaluated = F.concat(F.lit("Step "), F.col("step").cast("string"), F.lit(": eval_loss="), fixed(F.col("eval_loss"), 4))
    lines = F.filter(F.array(train, evaluated), lambda line: line.isNotNull())
    return log.select("*", F.explode(lines).alias("line"))


def prompt_grid(steps: DataFrame, prompts: list[str] | None = None) -> DataFrame:
    """Work list of generations: each step with each prompt of a literal list."""
    listed = F.array(*[F.lit(p) for p in prompts or PROMPTS])
    return steps.select("*", F.posexplode(listed).alias("prompt_id", "prompt"))


def align_losses(log: DataFrame, partition: list[str] | None = None, steps_per_epoch: int = 5919) -> DataFrame:
    """Steps of a run with both losses, averaged per step, and their epoch: one grouping instead of a self-join."""
    both = log.groupBy(*(partition or []), "step").agg(F.avg("loss").alias("loss"), F.avg("eval_loss").alias("eval_loss"))
    both = both.where(F.col("loss").isNotNull() & F.col("eval_loss").isNotNull())
    return both.withColumn("epoch", epoch(F.col("step"), steps_per_epoch)).withColumn(
        "gap", F.col("eval_loss") - F.col("loss")
    )


def latest_train_loss(
    log: DataFrame, partition: list[str] | None = None, order: list[str] | None = None, span: int = SPAN
) -> DataFrame:
    """Evaluation rows with the train loss last logged at or before them (null before the first)."""
    known = last_known(log, F.col("loss"), order or ["step"], "train_loss", partition, span=span)
    return known.where(F.col("eval_loss").isNotNull())


def loss_changes(log: DataFrame, partition: list[str], span: int = SPAN) -> DataFrame:
    """Train rows with the loss of the train row before and the difference."""
    train = log.where(F.col("loss").isNotNull())
    known = last_known(train, F.col("loss"), ["step"], "previous", partition, inclusive=False, span=span)
    return known.withColumn("delta", F.col("loss") - F.col("previous"))


def stage_of(step: Column, stages: list[tuple[str, int]] | None = None) -> Column:
    """Name of the stage a step is in. The borders are literals, so no range join is needed."""
    named = None
    for name, start in sorted(stages or STAGES, key=lambda s: -s[1]):
        named = F.when(step >= start, name) if named is None else named.when(step >= start, name)
    return named


def best_step(log: DataFrame, partition: list[str]) -> DataFrame:
    """Step with the lowest evaluation loss; of equal ones the earliest."""
    rank = F.when(F.col("eval_loss").isNotNull(), F.struct("eval_loss", "step"))
    best = log.groupBy(*partition).agg(F.min(rank).alias("best")).where(F.col("best").isNotNull())
    return best.select(*partition, F.col("best.step").alias("step"), F.col("best.eval_loss").alias("eval_loss"))


def first_steps_below(log: DataFrame, thresholds: list[float], partition: list[str] | None = None) -> DataFrame:
    """Per run and threshold the first step with a train loss below it, all in one pass over the log."""
    keys = partition or []
    firsts = [F.min(F.when(F.col("loss") < t, F.col("step"))).alias(f"t{i}") for i, t in enumerate(thresholds)]
    rows = [F.struct(F.lit(t).alias("threshold"), F.col(f"t{i}").alias("first_step")) for i, t in enumerate(thresholds)]
    return log.groupBy(*keys).agg(*firsts).select(*keys, F.inline(F.array(*rows)))


def checkpoint_step(path: Column) -> Column:
    """Whole-number suffix of ``checkpoint-<n>``; null for other names."""
    return F.nullif(F.regexp_extract(path, "checkpoint-([0-9]+)", 1), F.lit("")).cast("bigint")


def newest_checkpoints(artifacts: DataFrame, keep: int, partition: list[str]) -> DataFrame:
    """The ``keep`` highest steps per run. Spark applies the limit in every task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*partition).orderBy(F.desc("step")))
    return artifacts.where(F.col("step").isNotNull()).withColumn("rank", rank).where(F.col("rank") <= keep)


def latest_artifact(artifacts: DataFrame, partition: list[str]) -> DataFrame:
    """Final model where a run has one, else its checkpoint with the highest step as a number."""
    step = checkpoint_step(F.col("path"))
    return artifacts.groupBy(*partition).agg(
        F.coalesce(F.max(F.when(F.col("path").endswith("final_model"), F.col("path"))), F.max_by("path", step)).alias(
            "path"
        )
    )


def samples_by_step(samples: DataFrame, steps: list[int]) -> DataFrame:
    """One row per prompt, one column per step, and ``elsewhere``: how many samples are of a step not asked for.

    Of several samples of a prompt and step the greatest text stands, whatever the order of the rows.
    """
    wide = samples.groupBy("prompt").pivot("step", steps).agg(F.max("generated"))
    listed = F.col("step").isin(steps)
    other = samples.groupBy(F.col("prompt").alias("_prompt")).agg(F.count_if(~F.coalesce(listed, F.lit(False))).alias("elsewhere"))
    return wide.join(other, F.col("prompt").eqNullSafe(F.col("_prompt"))).drop("_prompt")


def steps_of(samples: DataFrame, limit: int = 10_000) -> list[int]:
    """The steps that occur, for ``samples_by_step``; refuses more than ``limit``, which is more than a table has columns."""
    steps = [r["step"] for r in samples.where("step IS NOT NULL").select("step").distinct().limit(limit + 1).collect()]
    if len(steps) > limit:
        raise ValueError(f"more than {limit} steps")
    return sorted(steps)
