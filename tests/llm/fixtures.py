"""Small tables with everything that may be odd."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names the operators use themselves.
CLASHING = "size int, shard int, slot string, score double, predicted string, fingerprint string, target string, taken string, hash string, name string, rounds int"


def odd_rows(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    words = ["alpha", "beta", "Gamma", "delta", "über", "naïve", "x", "42", "!!", "😀"]
    sentence = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, sentence(rng.randint(1, 60)) + "\n" * (i % 3) + sentence(5), "en", f"s{i % 4}", i) for i in range(40)]
    same = sentence(30)
    rows += [(100 + i, same if i % 2 else same.upper(), "en", "hot", 1) for i in range(30)]  # equal but for case
    rows += [(200, "again and again", "de", "s1", 2)] * 5  # rows alike in every column
    rows += [(300, None, None, None, None), (301, "", "fr", None, 0), (302, " \t\n ", None, "s0", 3), (None, "no id", "en", "s2", 5)]
    rows += [(None, None, None, None, None), (303, "A", "en", "s3", 1), (-7, "negative id", "es", "s3", 1), (304, sentence(30_000), "en", "s0", 9)]
    rows += [(300, "same id, other text", "en", "s0", 1)]
    return rows


def odd_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def with_clashes(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("*", *[f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in CLASHING.split(", ")])


def empty_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
