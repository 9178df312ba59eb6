"""Sums and means: small, large, missing and infinite inputs, any order of rows."""
import random

from pyspark.sql import Window, functions as F

from tideline.functions.sums import mean, mean_over, total, total_over


def _both(spark, values):
    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "x double")
    return df.agg(total("x").alias("t"), mean("x").alias("m")).first()


def test_small_values_are_not_lost(spark):
    got = _both(spark, [1e-7] * 4)
    assert got.t == 4e-7 and got.m == 1e-7


def test_large_values_do_not_overflow(spark):
    got = _both(spark, [1e13, 3e13])
    assert got.t == 4e13 and got.m == 2e13
    assert _both(spark, [1e18, 1e18, -1e18]).t == 1e18


def test_missing_and_infinite_values(spark):
    got = _both(spark, [1.5, None, float("nan"), 2.5])
    assert got.t == 4.0 and got.m == 2.0
    none = _both(spark, [None, float("nan")])
    assert none.t is None and none.m is None
    assert _both(spark, [1.0, float("inf")]).t == float("inf")


def test_a_sum_at_a_strict_limit_does_not_depend_on_order(spark):
    values = [0.1] * 10 + [0.3, 0.7, 0.2, 0.8] * 5
    for seed in range(4):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(1 + seed)
        assert df.agg(total("x").alias("t")).first().t == 11.0


def test_a_mean_halfway_between_two_results_does_not_depend_on_order(spark):
    values = [0.244444444, 0.246666667, 0.245555555, 0.245555556] * 3
    for seed in range(4):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(1 + seed)
        assert df.agg(mean("x").alias("m")).first().m == 0.245555556


def test_window_forms_equal_plain_sums(spark):
    rows = [(i, [0.1, None, 2.25, 1e-8, float("nan")][i % 5]) for i in range(40)]
    w = Window.orderBy("i").rowsBetween(-3, 0)
    got = (spark.createDataFrame(rows, "i int, x double")
           .select("i", total_over("x", w).alias("t"), mean_over("x", w).alias("m")).orderBy("i").collect())
    for r in got:
        kept = [v for _, v in rows[max(0, r.i - 3): r.i + 1] if v is not None and v == v]
        assert r.t == round(sum(kept), 9) and r.m == round(sum(kept) / len(kept), 9)
