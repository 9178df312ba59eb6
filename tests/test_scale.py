"""Blocked computations give what one big window would give."""
import datetime as dt
import random
import re

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from tideline.operators import features as X, metrics as M, scale as K


@pytest.fixture(scope="module")
def gappy(spark):
    """Three zones with gaps; one zone holds most rows."""
    rnd = random.Random(7)
    rows = []
    for zone, n in (("hot", 900), ("b", 60), ("c", 5)):
        t = 0
        for _ in range(n):
            t += rnd.choice([1, 1, 1, 2, 9, 400])
            rows.append((zone, dt.datetime(2000, 1, 1) + dt.timedelta(hours=6 * t), float(rnd.randint(0, 50)) / 10,
                         rnd.randint(0, 1)))
    return spark.createDataFrame(rows, "zone string, time_6h timestamp_ntz, x double, flag int").cache()


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_row_index_is_the_row_number(gappy):
    got = K.row_index(gappy, ["zone"], ["time_6h"], K.time_block("time_6h", 30), "i")
    plain = gappy.withColumn("i", (F.row_number().over(Window.partitionBy("zone").orderBy("time_6h")) - 1).cast("bigint"))
    assert rows(got) == rows(plain)


def test_running_sum_max_before_and_total(gappy):
    got = K.running(gappy, ["zone"], ["time_6h"], K.time_block("time_6h", 45),
                    {"s": (F.col("flag"), "sum"), "m": (F.col("x"), "max")}, totals=["s"], before=["s"])
    w = Window.partitionBy("zone").orderBy("time_6h").rowsBetween(Window.unboundedPreceding, 0)
    plain = (gappy.withColumn("s", F.sum("flag").over(w)).withColumn("m", F.max("x").over(w))
             .withColumn("s_before", F.col("s") - F.col("flag"))
             .withColumn("s_total", F.sum("flag").over(Window.partitionBy("zone"))))
    assert rows(got.select(*plain.columns)) == rows(plain)


@pytest.mark.parametrize("size,days", [(12, 3), (16, 30), (50, 400)])
def test_halo_windows_equal_plain_windows(gappy, size, days):
    def build(w):
        return [F.lag("x", 8).over(w).alias("lag8"), F.max("x").over(w.rowsBetween(-3, 0)).alias("m4"),
                F.sum(F.floor(F.col("x") * 10 + 0.5)).over(w.rowsBetween(-11, 0)).alias("s12")]

    got = K.halo_windows(gappy, ["zone"], "time_6h", 11, build, K.time_block("time_6h", days), size)
    plain = gappy.select("*", *build(Window.partitionBy("zone").orderBy("time_6h")))
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)


def test_halo_needs_a_block_longer_than_the_frame(gappy):
    with pytest.raises(ValueError):
        K.halo_windows(gappy, ["zone"], "time_6h", 11, lambda w: [], rows=11)


def test_staged_blocks_follow_the_order(spark):
    df = spark.range(5000).select((F.col("id") * 37 % 5000 / 7).alias("v"), F.lit("k").alias("k"))
    stored, block = K.staged_blocks(df, ["k", "v"], 20)
    numbers = [r["b"] for r in stored.withColumn("b", block).orderBy("v").collect()]
    assert numbers == sorted(numbers) and len(set(numbers)) >= 15


def operators_of(df):
    text = df._jdf.queryExecution().sparkPlan().toString()
    return re.findall(r"^[ :+-]*(?:\* ?)?([A-Z]\w+)", text, re.M)


def test_small_and_large_frames_have_the_same_plan(spark):
    plans = []
    for n in (10, 20000):
        df = spark.range(n).select((F.col("id") * 7919 % n / 3).alias("risk_score"), (F.col("id") % 2).cast("int").alias("is_flood"))
        c = M.curve(df)
        assert c.agg(F.max("cn")).first()[0] == n
        plans.append(operators_of(c))
    assert plans[0] == plans[1] and "Window" in plans[0]


def test_running_over_values_of_empty_and_one_row_frames(spark):
    for n in (0, 1):
        df = spark.range(n).select(F.lit(0.5).alias("risk_score"), F.lit(1).alias("is_flood"))
        assert M.curve(df).count() == n


def test_running_before_max_and_sum(gappy):
    got = K.running(gappy, ["zone"], ["time_6h"], K.time_block("time_6h", 45),
                    {"s": (F.col("flag"), "sum"), "m": (F.col("x"), "max")}, before=["s", "m"])
    w = Window.partitionBy("zone").orderBy("time_6h").rowsBetween(Window.unboundedPreceding, -1)
    plain = gappy.select("zone", "time_6h", F.coalesce(F.sum("flag").over(w), F.lit(0)).alias("s_before"),
                         F.max("x").over(w).alias("m_before"))
    assert sorted(map(str, got.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("parts", [None, 1, 8])
def test_exact_quantiles_match_numpy_over_blocks(spark, parts):
    rnd = random.Random(3)
    data = [("a", round(rnd.random(), 2)) for _ in range(700)] + [("b", 5.0)] + [("c", float(i)) for i in range(4)]
    df = spark.createDataFrame(data, "k string, v double")
    points = {"q1": 0.1, "q2": 0.5, "q3": 0.9}
    got = K.exact_quantiles(df, ["k"], "v", points, parts).collect()
    assert len(got) == 3
    for r in got:
        vals = [v for k, v in data if k == r["k"]]
        assert [r[p] for p in points] == pytest.approx([np.quantile(vals, q) for q in points.values()])


def test_gold_window_features_do_not_depend_on_the_block_size(spark, slots):
    rnd = random.Random(1)
    data = [("High Relief", n * (1 if n < 40 else 3), *[rnd.randint(0, 90) / 10 for _ in X.S.MEASURES], 0.5) for n in range(90)]
    s = slots(data, X.S.MEASURES + ["river_discharge"])
    one = X.gold(s)
    many = X.gold(s, block=K.time_block("time_6h", 2), rows=12)
    assert rows(one) == rows(many)


def test_hot_zone_is_spread_over_blocks(gappy):
    sizes = (K.row_index(gappy, ["zone"], ["time_6h"], K.time_block("time_6h", 30), "i")
             .groupBy("zone", F.floor(F.col("i") / 64).alias("b")).count())
    assert sizes.agg(F.max("count")).first()[0] <= 64
