import math
import random

from pyspark.sql import functions as F

from loomtext.functions import numeric as n


def values(spark, expr, rows):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "i int, v double")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_formats_round_like_printf(spark):
    rng = random.Random(1)
    rows = [1.5e-7 * s for s in range(3000)] + [rng.uniform(0, 12) for _ in range(2000)] + [0.125, 2.5, 0.0, 123456.5]
    assert values(spark, n.scientific(F.col("v")), rows) == ["%.2e" % v for v in rows]
    assert values(spark, n.fixed(F.col("v")), rows) == ["%.4f" % v for v in rows]
    assert values(spark, n.fixed(F.col("v"), 1), rows) == ["%.1f" % v for v in rows]


def test_metric_line(spark):
    df = spark.createDataFrame([(10, 8.5, 1.35e-6), (20, 8.1, None), (30, None, 1.0)], "s long, l double, r double")
    got = [r[0] for r in df.select(n.metric_line(F.col("s"), F.col("l"), F.col("r"))).collect()]
    assert got == ["Step 10: loss=8.5000, lr=1.35e-06", "Step 20: loss=8.1000, lr=0.00e+00", None]


def test_missing_loss(spark):
    assert values(spark, n.loss_or_missing(F.col("v")), [None, 0.0, 7.40321]) == ["N/A", "0.0000", "7.4032"]


def test_published_learning_rates(spark):
    # Rates of the published log; a row at step s shows the rate of step s - 1.
    published = {10: "1.35e-06", 60: "8.85e-06", 100: "1.49e-05", 180: "2.68e-05", 460: "6.88e-05", 500: "7.48e-05",
                 530: "7.93e-05", 11770: "3.64e-08", 11790: "1.84e-08", 11820: "2.76e-09", 11830: "6.19e-10"}
    got = values(spark, n.scientific(n.learning_rate(F.col("v") - 1)), [float(s) for s in published])
    assert got == list(published.values())


def test_rate_ends(spark):
    got = values(spark, n.learning_rate(F.col("v"), 1.0, 100, 200), [0.0, 50.0, 100.0, 150.0, 200.0])
    assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(got, [0, 0.5, 1, 0.5, 0]))
    assert values(spark, n.learning_rate(F.col("v"), 1.0, 0, 10), [0.0]) == [1.0]


def test_published_epochs(spark):
    # Epochs of the published results table.
    assert values(spark, n.epoch(F.col("v")), [500.0, 6000.0, 11500.0]) == [0.0845, 1.0137, 1.9429]


def test_clamps_and_megabytes(spark):
    assert values(spark, n.clamp_temperature(F.col("v")), [0.0, 0.1, 1.5]) == [0.1, 0.1, 1.5]
    assert values(spark, n.clamp_length(F.col("v").cast("int")), [299.0, 300.0, 301.0]) == [299, 300, 300]
    assert values(spark, n.megabytes(F.col("v")), [2.5e6]) == [2.5]
    assert values(spark, n.megabytes(F.col("v"), True), [1048576.0]) == [1.0]
