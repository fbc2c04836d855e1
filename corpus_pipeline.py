"""From raw documents to packed windows: quality, exact copies, near copies, source mix, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the
next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.llm import exact, mixing, packing, quality, simhash
from loomtext.llm.common import saved

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: No SQL says what the compression classifier and the tokenizer do.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores at least 0.7 stay."""
    whole = docs.select("doc_id", "text", F.struct("*").alias("document"))  # keeps columns that are named like those of the score
    scored = quality.score_documents(whole, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("predicted = 1").select("document.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, a similarity of 0.8 or more."""
    return simhash.drop_near_duplicates(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order: each document as often as the mix takes it."""
    return mixing.training_order(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 2,048 tokens; the sequence ids of later ranges of the training order are larger."""
    return packing.pack(mixing.in_training_order(docs.select("doc_id", "text")), public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("good_quality", good_quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixed_sources", mixed_sources),
    ("packed", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
