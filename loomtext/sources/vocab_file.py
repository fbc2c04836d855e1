"""Vocabulary tables on disk and the tab-separated exchange form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomtext.operators.vocab import EOS_ID, MAX_BYTES, MAX_PIECES


def read_vocab_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``piece<TAB>score``; lines with fewer fields are skipped, the id is the place among the kept ones.

    The order of lines is known only within a file read whole, so this is for one file of at most ``MAX_BYTES``; our
    own vocabularies are saved with their ids.
    """
    found = spark.read.format("binaryFile").load(path).select("length").limit(2).collect()
    if len(found) > 1:
        raise ValueError("a vocabulary is one file: the lines of several have no order")
    if found and found[0]["length"] > MAX_BYTES:
        raise ValueError(f"vocabulary file is longer than {MAX_BYTES} bytes")
    files = spark.read.text(path, wholetext=True)
    lines = files.select(F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))
    fields = F.split(F.trim(F.col("line")), "\t")
    kept = lines.where(F.size(fields) >= 2).select("line_no", F.get(fields, F.lit(0)).alias("piece"), F.get(fields, F.lit(1)).alias("raw"))
    numbered = kept.withColumn("id", (F.row_number().over(Window.orderBy("line_no")) - 1).cast("int"))
    return numbered.select(
        "id", "piece", F.col("raw").cast("double").alias("score"), (F.col("id") <= EOS_ID).alias("is_special")
    )


def write_vocab(vocab: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Pieces, scores and reserved rows in one Parquet table; ids are stored, not implied."""
    vocab.write.mode(mode).parquet(path)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_vocab_tsv(vocab: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``piece<TAB>score`` in id order, one file; refuses more than ``MAX_PIECES`` pieces."""
    if vocab.count() > MAX_PIECES:
        raise ValueError(f"vocabulary has more than {MAX_PIECES} pieces")
    ordered = vocab.repartition(1).sortWithinPartitions("id")
    ordered.select(F.concat_ws("\t", "piece", F.col("score").cast("string")).alias("value")).write.mode(mode).text(path)
