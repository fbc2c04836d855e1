"""Run logs as streams: what the training loop's callbacks do, on files as they arrive."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.window import Window

from loomtext.operators.series import SPAN, last_known
from loomtext.operators.trainlog import PROMPTS, report_lines

LOG_SCHEMA = T.StructType(
    [
        T.StructField("run", T.LongType()),
        T.StructField("step", T.LongType()),
        T.StructField("loss", T.DoubleType()),
        T.StructField("eval_loss", T.DoubleType()),
        T.StructField("lr", T.DoubleType()),
    ]
)


#: What is kept of a span of a run, in the order of steps, and what a change of it gives out.
KEPT = "train_steps array<bigint>, train_losses array<double>, eval_steps array<bigint>, eval_losses array<double>"
CHANGES = "kind string, run bigint, span bigint, step bigint, eval_loss double, train_loss double, open boolean"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_log_stream(
    spark: SparkSession, path: str, schema: T.StructType = LOG_SCHEMA, fmt: str = "json", files: int = 1000,
    name_glob: str = "*",
) -> DataFrame:
    return (
        spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files)
        .option("pathGlobFilter", name_glob).load(path)
    )


def stream_report_lines(log: DataFrame, out: str, checkpoint: str, label: str = "loss") -> StreamingQuery:
    """On every metric record: thin and format. Stateless, so the batch function is applied as it is."""
    return (
        report_lines(log, label).writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start()
    )


class SpanOfRun(StatefulProcessor):
    """Keyed state of one span of a run: its train losses and evaluations.

    New records change the evaluations from their step up to the next train record; only these are given out, and the last train
    record of the span where it changes. An evaluation before the first train record of its span is ``open``: its loss lies in an earlier span.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", KEPT)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        run, span = key
        kept = self.kept.get() if self.kept.exists() else ([], [], [], [])
        steps, losses, evaluated, values = (list(x) for x in kept)
        train, fresh = dict(zip(steps, losses, strict=True)), []
        for row in rows:
            if row.loss is not None:
                train[row.step] = max(row.loss, train.get(row.step, row.loss))
            if row.eval_loss is not None:
                fresh.append((row.step, row.eval_loss))
        after = sorted(train)
        known = lambda ordered, by, step: by[ordered[i - 1]] if (i := bisect_right(ordered, step)) else None
        before = dict(zip(steps, losses, strict=True))
        again = {step for step in evaluated if known(steps, before, step) != known(after, train, step)}
        again |= {step for step, _ in fresh}
        every = sorted([*zip(evaluated, values, strict=True), *fresh])
        self.kept.update((after, [train[s] for s in after], [s for s, _ in every], [v for _, v in every]))
        for step, value in every:
            if step in again:
                loss = known(after, train, step)
                yield Row(kind="evaluation", run=run, span=span, step=step, eval_loss=value, train_loss=loss, open=loss is None)
        if after and (not steps or (steps[-1], losses[-1]) != (after[-1], train[after[-1]])):
            yield Row(kind="tail", run=run, span=span, step=after[-1], eval_loss=None, train_loss=train[after[-1]], open=False)

    def close(self) -> None:
        pass


def stream_evaluations(log: DataFrame, out: str, checkpoint: str, prompts: list[str] | None = None, span: int = SPAN) -> StreamingQuery:
    """On every evaluation record: attach the last train loss and add one work row per prompt.

    Records may come in any order, however late. They are kept as keyed state by run and span of ``span`` steps, so one run holding all records is spread over tasks, a
    micro-batch touches the spans of its own records alone, and no history is read again. It writes the evaluations it adds or changes, and the last train
    record of each changed span; ``read_evaluations`` puts the newest state together. Every micro-batch writes its own folder in
    overwrite mode, so a repeated batch leaves no second copy. Of train records of one step the greatest loss counts; records without a run or step count as none.
    """
    spark = log.sparkSession
    records = log.where("run IS NOT NULL AND step IS NOT NULL AND (loss IS NOT NULL OR eval_loss IS NOT NULL)").select(
        F.col("run").cast("bigint").alias("run"), F.expr(f"step div {span}").alias("span"), F.col("step").cast("bigint").alias("step"), "loss", "eval_loss"
    )
    changes = records.groupBy("run", "span").transformWithState(SpanOfRun(), CHANGES, "Update", "None")
    listed = F.when(F.col("kind") == "evaluation", F.array(*[F.lit(p) for p in prompts or PROMPTS])).otherwise(F.array(F.lit(None).cast("string")))

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("*", F.posexplode(listed).alias("prompt_id", "prompt"))
        rows.write.mode("overwrite").partitionBy("kind").parquet(f"{out}/batch={batch_id}")

    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)  # the only store that holds state of any shape; a query keeps the settings it starts with
    try:
        return changes.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start()
    finally:
        spark.conf.set(STATE_STORE, before)


def read_evaluations(spark: SparkSession, out: str) -> DataFrame:
    """The work rows as the last micro-batch that changed an evaluation left them, open ones with the last train loss of the earlier spans."""
    schema = f"{CHANGES}, prompt_id int, prompt string, batch bigint"
    rows = spark.read.schema(schema).parquet(out)
    newest = lambda by: F.max("batch").over(Window.partitionBy("run", by))
    found = rows.where("kind = 'evaluation'").withColumn("_newest", newest("step")).where("batch = _newest")
    tails = rows.where("kind = 'tail'").withColumn("_newest", newest("span")).where("batch = _newest")
    asked = found.where("open").select("run", "span", F.lit(None).cast("double").alias("train_loss"))
    spans = asked.union(tails.select("run", "span", "train_loss")).groupBy("run", "span").agg(F.max("train_loss").alias("loss"))
    carried = last_known(spans, F.col("loss"), ["span"], "carried", ["run"], inclusive=False).select("run", "span", "carried")
    whole = found.join(carried, ["run", "span"], "left").withColumn("train_loss", F.when(F.col("open"), F.col("carried")).otherwise(F.col("train_loss")))
    return whole.select("run", "step", "eval_loss", "train_loss", "prompt_id", "prompt")
