"""Text sources, their unified form, and the tables a prepared corpus is written to."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.functions.text import join_question_answer
from loomtext.operators.guards import Watch, watched

ARTICLE_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("completion", T.StringType())])
QA_SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("INSTRUCTION", T.StringType()),
        T.StructField("RESPONSE", T.StringType()),
    ]
)


def read_source(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Whole split of one source. Parquet and ORC carry a schema; JSON and CSV need one, so nothing is inferred."""
    if schema is None and fmt not in ("parquet", "orc"):
        raise ValueError(f"{fmt} needs a schema")
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def text_column(df: DataFrame) -> str:
    """``text`` where the table has it, else ``completion``; decided while the plan is built."""
    return "text" if "text" in df.columns else "completion"


def unify_articles(articles: DataFrame) -> DataFrame:
    """``(row_id, source_ds, text)``; every other source column is pruned from the scan."""
    return articles.select(
        F.concat(F.lit("a:"), F.col("doc_id").cast("string")).alias("row_id"),
        F.lit("articles").alias("source_ds"),
        F.col(text_column(articles)).alias("text"),
    )


def unify_qa(qa: DataFrame) -> DataFrame:
    """Question and answer in one text; rows where both are null are dropped.

    Where ``qa`` has the flags ``asked`` and ``answered``, these say so, and no text is needed to know which rows there are.
    """
    if {"asked", "answered"} <= set(qa.columns):
        there = F.col("asked") | F.col("answered")
    else:
        there = F.col("INSTRUCTION").isNotNull() | F.col("RESPONSE").isNotNull()
    return qa.where(there).select(
        F.concat_ws(":", F.lit("q"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("row_id"),
        F.lit("qa").alias("source_ds"),
        join_question_answer(F.col("INSTRUCTION"), F.col("RESPONSE")).alias("text"),
    )


def union_sources(*sources: DataFrame) -> DataFrame:
    """Concatenate unified sources; duplicates stay."""
    head, *rest = sources
    for other in rest:
        head = head.unionByName(other)
    return head


def qa_from_turns(turns: DataFrame) -> DataFrame:
    """Each user turn with the assistant turn right after it.

    The equi-join is on (conversation, turn), so one huge conversation is spread over all tasks;
    a window per conversation would put it in one. ``asked`` and ``answered`` say at the scan whether there is a text,
    so that passes over ids alone carry two flags through the join and no text.
    """
    there = F.col("text").isNotNull()
    asked = turns.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("INSTRUCTION"), there.alias("asked")
    )
    answered = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("RESPONSE"), there.alias("answered")
    )
    return asked.join(answered, ["conv_id", "turn"])


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One text per record, newline separated, in as many part files as the data has partitions.

    A text with inner newlines becomes several lines.
    """
    df.select("text").write.mode(mode).text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "sentence")


def append_generations(samples: DataFrame, path: str, batch: str) -> None:
    """Add generated samples under the name of their batch; earlier ones stay readable.

    A batch that is appended again, as after a failed job, replaces itself and leaves no second copy. A batch is one folder, however
    many steps it has; ``step`` is a column, and the rows of a file are in its order, so a reader of some steps can skip the rest.
    """
    named = samples.sortWithinPartitions("step").withColumn("batch", F.lit(batch))
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def files_below(spark: SparkSession, *paths: str) -> DataFrame:
    """``(path, length, at)`` of every file below ``paths``, at in microseconds; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.select("path", "length", F.unix_micros("modificationTime").alias("at"))


def input_state(spark: SparkSession, *paths: str) -> list[int]:
    """Number and bytes of the files below ``paths``, and 256 bits from the names, sizes and modification times of all, in no order."""
    marks = [F.bit_xor(F.xxhash64(F.lit(i), "path", "length", "at")) for i in range(4)]
    return list(files_below(spark, *paths).agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0)), *marks).first())


def materialize(
    spark: SparkSession, root: str, stage: str, params: dict, build: Callable[[], DataFrame], inputs: list[str] | None = None, watch: Watch | None = None,
) -> DataFrame:
    """Compute a stage once per parameter set and state of its input files, and read it back afterwards.

    Both are part of the path, so a changed parameter or input never reuses old rows. They are also
    noted in a second folder once the rows are written; without that note the stage is built again. What ``watch`` refuses is
    written but not noted, so it is never read back.
    """
    state = input_state(spark, *inputs) if inputs else []
    settings = json.dumps({"params": params, "inputs": state}, sort_keys=True, ensure_ascii=False)
    path = f"{root}/{stage}-{hashlib.sha256(settings.encode()).hexdigest()[:16]}"
    try:
        spark.read.text(f"{path}.done")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        write = lambda rows: rows.write.mode("overwrite").parquet(path)
        if watch is None:
            write(build())
        else:
            watched(build(), watch, write)
        spark.createDataFrame([(settings,)], "value string").write.mode("overwrite").text(f"{path}.done")
    return spark.read.parquet(path)
