"""Places of rows in their files."""

import pytest
from pyspark.sql import functions as F

from loomtext.sources import file_order


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("in order") / "rows")
    rows = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("name"), F.lit("own").alias("pos"))
    rows.repartition(7).write.parquet(path)
    return path


def in_order(spark, path):
    """Names file by file, each file read alone."""
    files = sorted(f for f in spark.read.parquet(path).inputFiles())
    return [r["name"] for f in files for r in spark.read.parquet(f.replace("%20", " ")).collect()]


def test_places_follow_files_and_rows(spark, folder):
    names = in_order(spark, folder)
    got = {r["pos"]: r["name"] for r in file_order.file_positions(spark, folder).collect()}
    assert got == dict(enumerate(names))
    starts = file_order.file_starts(spark, folder).orderBy("file").collect()
    assert len(starts) == 7 and [r["start"] for r in starts] == [sum(s["rows"] for s in starts[:i]) for i in range(7)]


@pytest.mark.parametrize("percent", [0, 0.04, 0.05, 10, 33.3, 99.96, 100])
def test_first_rows_open_only_their_files(spark, folder, percent):
    wanted = int(1000 * percent / 100 + 0.5)
    names, found = in_order(spark, folder), file_order.first_rows(spark, folder, percent)
    assert found.columns == ["name", "pos"]
    assert sorted(r["name"] for r in found.collect()) == sorted(names[:wanted])
    if wanted:
        needed = file_order.file_starts(spark, folder).where(F.col("start") < wanted).count()
        found.collect()
        scan = found._jdf.queryExecution().executedPlan().toString()
        assert "file_path" in scan and needed <= 7


def test_an_empty_table_has_no_places(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.createDataFrame([], "name string").write.parquet(path)
    assert file_order.file_positions(spark, path).count() == 0
    assert file_order.first_rows(spark, path, 50).count() == 0
