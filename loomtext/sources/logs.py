"""Readers of published run logs.

Parsers take a DataFrame of lines, so they work on files and on lines that Spark made itself. Files
are read with their line number where the meaning of a line depends on the lines before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.functions.numeric import fixed, scientific
from loomtext.operators.series import last_known
from loomtext.operators.trainlog import checkpoint_step

# Fixed value: a metric row is step | loss | eval loss | learning rate, with - for a missing number.
METRIC_ROW = r"^\s*(\d+)\s*\|\s*([^|]+?)\s*\|\s*([^|]+?)\s*\|\s*([^|]+?)\s*$"
# Headers of a generation log (two layouts) and its sample lines.
SAMPLE_HEADER = r"^\s*(?:📝|#{1,3})?\s*Step (\d+) \| Loss: (\S+)"
SAMPLE_LINE = r"^\s*\[(.*?)\] → (.*)$"


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, at, line)``: ``block`` is where the part of the file that a task read begins, ``at`` orders its lines.

    Files are read in parts, by as many tasks as there are parts.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.regexp_replace("value", "\r$", "").alias("line"),
    )


def parse_metric_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Metric rows of a log; headers and rules are skipped, a rule glued to a row is cut off first."""
    text = F.regexp_replace(F.col(line), "-{3,}\\s*$", "")
    cells = [F.regexp_extract(text, METRIC_ROW, i) for i in range(1, 5)]
    step, loss, eval_loss, rate = cells
    return lines.where(text.rlike(METRIC_ROW)).select(
        step.cast("bigint").alias("step"),
        loss.try_cast("double").alias("loss"),
        eval_loss.try_cast("double").alias("eval_loss"),
        rate.try_cast("double").alias("lr"),
    )


def read_metric_log(spark: SparkSession, path: str) -> DataFrame:
    """Metric rows carry their own step, so the lines are read split and in parallel."""
    return parse_metric_lines(spark.read.text(path), "value")


def format_metric_rows(log: DataFrame) -> DataFrame:
    """Add ``line``: the row in the layout ``parse_metric_lines`` reads."""
    gap = F.lit("-")
    return log.withColumn(
        "line",
        F.concat_ws(
            " | ",
            F.lpad(F.col("step").cast("string"), 8, " "),
            F.lpad(F.coalesce(fixed(F.col("loss"), 4), gap), 8, " "),
            F.lpad(F.coalesce(fixed(F.col("eval_loss"), 4), gap), 10, " "),
            F.lpad(F.coalesce(scientific(F.col("lr"), 2), gap), 12, " "),
        ),
    )


def parse_results_table(lines: DataFrame, line: str = "value") -> DataFrame:
    """Markdown results table: loss, epoch, step, validation loss; other lines are skipped."""
    cells = F.transform(F.split(F.trim(F.col(line)), "\\|"), lambda c: F.trim(c))
    row = lines.select(cells.alias("c")).where(F.size("c") == 6)
    return row.select(
        F.get("c", F.lit(3)).try_cast("bigint").alias("step"),
        F.get("c", F.lit(2)).try_cast("double").alias("epoch"),
        F.get("c", F.lit(1)).try_cast("double").alias("loss"),
        F.get("c", F.lit(4)).try_cast("double").alias("eval_loss"),
    ).where(F.col("loss").isNotNull() & F.col("step").isNotNull())


def read_results_table(spark: SparkSession, path: str) -> DataFrame:
    return parse_results_table(spark.read.text(path))


def parse_generation_lines(lines: DataFrame, span: int = 100_000, order: tuple[str, ...] = ("line_no",)) -> DataFrame:
    """``lines(file, *order, line)`` to ``(file, *order, step, loss, prompt, generated)``.

    A sample belongs to the latest header above it. A window holds the lines of ``span`` values of the first of the
    columns that order them.
    """
    found = F.regexp_extract(F.col("line"), SAMPLE_HEADER, 1)
    header = F.when(
        found != "",
        F.struct(
            found.cast("bigint").alias("step"),
            F.regexp_extract(F.col("line"), SAMPLE_HEADER, 2).try_cast("double").alias("loss"),
        ),
    )
    known = last_known(lines, header, list(order), "header", ["file"], span=span)
    sample = F.col("line").rlike(SAMPLE_LINE)
    return known.where(sample & F.col("header").isNotNull()).select(
        "file",
        *order,
        F.col("header.step").alias("step"),
        F.col("header.loss").alias("loss"),
        F.regexp_extract("line", SAMPLE_LINE, 1).alias("prompt"),
        F.regexp_extract("line", SAMPLE_LINE, 2).alias("generated"),
    )


def read_generation_log(spark: SparkSession, path: str) -> DataFrame:
    # Places are in bytes: a window holds the lines of one part of a file.
    return parse_generation_lines(placed_lines(spark, path), 1 << 25, ("block", "at"))


def list_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """``(path, step, length, megabytes)`` of the files below ``path``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    return files.select(
        "path",
        checkpoint_step(F.col("path")).alias("step"),
        "length",
        F.round(F.col("length") / 1e6, 1).alias("megabytes"),
    )
