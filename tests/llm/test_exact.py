import hashlib
import string
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loomtext.llm import exact
from tests.llm.fixtures import empty_documents, odd_documents, odd_rows, with_clashes

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def normal(text):
    return (text or "").translate(LOWER)


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[normal(r[1])].append(r[0])
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return [(r[0], best[normal(r[1])], len(groups[normal(r[1])]), hashlib.sha256(normal(r[1]).encode()).hexdigest()) for r in rows], len(groups)


def key(row):
    return tuple((v is None, v) for v in row)


@pytest.mark.parametrize("block", [4096, 256])
def test_against_brute_force(spark, block):
    rows = exact.duplicates(odd_documents(spark), block).collect()
    want, groups = brute(odd_rows())
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows), key=key) == sorted(want, key=key)
    assert sum(r["kept"] for r in rows) == groups
    assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])


@pytest.mark.parametrize("block", [4096, 256])
def test_names_rest_on_contents_not_on_hashes(spark, block):
    # A hash of two values makes almost all blocks collide.
    named = exact.named(odd_documents(spark), block, lambda c: F.pmod(F.xxhash64(c), F.lit(2)).cast("bigint")).collect()
    by_name, by_text = defaultdict(set), defaultdict(set)
    for r in named:
        by_name[r["rounds"], r["name"]].add(r["text_sha256"])
        by_text[r["text_sha256"]].add((r["rounds"], r["name"]))
    assert all(len(v) == 1 for v in [*by_name.values(), *by_text.values()])


def test_texts_that_differ_at_one_end_only(spark):
    long = "x" * 100
    texts = [long, long + "y", "y" + long, long[:-1], long[:-1] + "z", "z" + long[1:], "", "x"]
    rows = exact.duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), 8).collect()
    assert all(r["kept"] and r["group_size"] == 1 for r in rows) and len(rows) == len(texts)


def test_kept_rows_have_all_columns(spark):
    docs = with_clashes(odd_documents(spark))
    kept = exact.drop_duplicates(docs)
    assert kept.columns == docs.columns
    texts = [normal(r["text"]) for r in kept.collect()]
    assert sorted(texts) == sorted({normal(r[1]) for r in odd_rows()})


def test_one_group_of_copies_holds_a_third_of_the_rows(spark):
    hot = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("copy " * 50).alias("text"))
    rest = spark.range(1000, 3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    rows = exact.duplicates(hot.union(rest)).groupBy("group_size").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("k"))
    assert {(r["group_size"], r["n"], r["k"]) for r in rows.collect()} == {(1000, 1000, 1), (1, 2000, 2000)}


def test_empty_table(spark):
    assert exact.duplicates(empty_documents(spark)).collect() == []
    assert exact.drop_duplicates(empty_documents(spark)).collect() == []


def test_main_path_is_native(spark):
    plan = exact.duplicates(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
