"""The test tables in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.functions.numeric import learning_rate
from loomtext.sources.corpus import qa_from_turns, read_source, unify_articles, unify_qa, union_sources


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_source(spark, f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("completion"))


def qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa_from_turns(table(spark, sf_dir, "conversations"))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_sources(unify_articles(articles(spark, sf_dir)), unify_qa(qa_pairs(spark, sf_dir)))


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the log of many runs: clicks carry train losses, views evaluation losses."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("user_id").alias("run"),
        F.col("event_id").alias("step"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("loss"),
        F.when(F.col("event_type") == "view", F.col("value")).alias("eval_loss"),
        learning_rate(F.col("event_id")).alias("lr"),
    )
