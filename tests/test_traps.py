"""Semantics that are easy to get wrong, one small case each."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tideline import settings as S
from tideline.functions import columns as C
from tideline.operators import climatology as K, features as X, learning as L, metrics as M, report as P, resample as R
from tideline.operators import splits as T
from tideline.sources.lake import upsert

DAY = dt.datetime(2024, 1, 1)


def one(spark, expr, **vals):
    row = spark.createDataFrame([tuple(vals.values())], ", ".join(f"{k} double" for k in vals))
    return row.select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("q,p,h,want", [
    (1.0, 5.0, 90.0, 0), (1.0001, 1.1, 0.0, 1), (1.0001, 1.0, 85.0, 0), (1.0001, 1.0, 85.1, 1),
    (None, 9.0, 99.0, 0), (2.0, None, None, 0)])
def test_label_is_strict(spark, q, p, h, want):
    assert one(spark, C.flood_label("q", "p", "h"), q=q, p=p, h=h) == want


@pytest.mark.parametrize("score,cut,ge", [
    (0.0, "LOW", "LOW"), (0.30, "LOW", "MEDIUM"), (0.60, "MEDIUM", "HIGH"), (1.0, "HIGH", "HIGH"),
    (-0.01, None, "LOW"), (1.01, None, "HIGH")])
def test_two_level_rules(spark, score, cut, ge):
    assert one(spark, C.risk_level_cut("s"), s=score) == cut
    assert one(spark, C.risk_level_ge("s"), s=score) == ge


def test_quality_score_counts_bounds_and_nulls(spark):
    names = list(S.SENSOR_BOUNDS)
    low, high = [S.SENSOR_BOUNDS[n][0] for n in names], [S.SENSOR_BOUNDS[n][1] for n in names]
    schema = ", ".join(f"{n} double" for n in names)
    df = spark.createDataFrame([tuple(low), tuple(high), tuple(v - 1e-6 for v in low), tuple(v + 1e-6 for v in high),
                                (None,) * 6, (None, *low[1:])], schema)
    assert [r[0] for r in df.select(C.dq_score()).collect()] == [1.0, 1.0, 0.0, 0.0, 0.0, 1.0 - 1 / 6.0]


def test_quality_score_sees_the_reading_not_the_filled_value(spark, slots):
    s = slots([("A", 0, *[None] * 8, 0.0)], S.MEASURES + ["river_discharge"])
    s = s.select("zone", "time_6h", *[F.col(c).cast("double").alias(c) for c in S.MEASURES], "river_discharge")
    r = X.base(s, is_forecast=True).first()
    assert r["dq_score"] == 0.0 and r["precipitation"] == 0.0 and r["is_flood"] == 0


def test_share_constants_are_doubles(spark):
    assert dict(spark.range(1).select(C.cascade_share(F.lit("High Relief")).alias("x")).dtypes)["x"] == "double"
    assert spark.range(1).select(C.cascade_share(F.lit("High Relief"))).first()[0] == 1.0 / 3.0


def test_antecedent_index_weights(spark):
    got = one(spark, C.decay_index("n", {1: "a", 2: "b", 4: "c"}), n=2.3, a=1.8, b=4.8, c=5.3)
    assert got == pytest.approx(10.064633125)


def test_no_discharge_in_gold_and_rows_kept(spark, slots):
    s = slots([(z, n, *[1.0] * 8, 0.5) for z in ("High Relief", "X") for n in range(5)], S.MEASURES + ["river_discharge"])
    g = X.gold(s)
    assert g.count() == 10 and not [c for c in g.columns if "discharge" in c]
    assert g.columns == ["zone", "time_6h", *S.GOLD_FEATURES, "dq_score", "is_flood"]


def test_future_rows_do_not_change_the_past(spark, slots):
    make = lambda last: slots([("High Relief", n, *[float(n if n < 10 else last)] * 8, 0.5) for n in range(15)],
                              S.MEASURES + ["river_discharge"])
    early = lambda s: sorted(map(tuple, X.gold(s).filter(F.col("time_6h") < DAY + dt.timedelta(hours=60)).collect()))
    assert early(make(1.0)) == early(make(77.0))


def test_cascade_for_source_known_unknown_and_missing(spark, slots):
    def row(z, n, rain):
        return (z, n, 0.0, 0.0, rain, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)
    s = slots([row("High Relief", 0, 3.0), row("Moderate Relief", 0, 9.0), row("Elsewhere", 0, 9.0), row("Elsewhere", 1, 9.0)],
              S.MEASURES + ["river_discharge"])
    got = {(r["zone"], r["time_6h"].hour): r["zone_cascade_risk"] for r in X.gold(s).collect()}
    assert got == {("High Relief", 0): 1.0, ("Moderate Relief", 0): 3.0 * (1 / 1.5), ("Elsewhere", 0): 3.0,
                   ("Elsewhere", 6): 0.0}


def test_duplicate_upstream_slot_fans_out(spark, slots):
    x = slots([("High Relief", 0, 1.0), ("High Relief", 0, 2.0), ("Z", 0, 5.0)], ["precip_roll_sum_24h"])
    assert X.with_upstream(x).filter(F.col("zone") == "Z").count() == 2


def test_label_join_uses_the_day_before_or_the_same_day(spark, slots):
    s = slots([("A", n) for n in range(8)], [])
    daily = spark.createDataFrame([("A", DAY.date(), 7.0)], "zone string, date_key date, river_discharge double")
    hit = lambda lag: [r["time_6h"].day for r in R.join_discharge(s, daily, lag).orderBy("time_6h").collect()
                       if r["river_discharge"] is not None]
    assert hit(1) == [2, 2, 2, 2] and hit(0) == [1, 1, 1, 1]


def test_day_of_year_divides_by_365(spark):
    import math
    df = spark.createDataFrame([(dt.datetime(2024, 12, 31, 18),)], "time_6h timestamp_ntz")
    r = df.select(*[c.alias(n) for n, c in C.cyclic().items()]).first()
    assert r["doy_sin"] == pytest.approx(math.sin(2 * math.pi * 366 / 365)) and r["is_winter"] == 1


def test_upsert_modes(spark):
    mk = lambda rows: spark.createDataFrame(rows, "zone string, time_6h int, v int")
    old, new = mk([("A", 1, 10), ("A", 2, 20)]), mk([("A", 2, 99), ("A", 3, 30), ("A", 3, 31)])
    keys = ["zone", "time_6h"]
    got = lambda **kw: sorted(map(tuple, upsert(old, new, keys, **kw).collect()))
    assert got() == [("A", 1, 10), ("A", 2, 20), ("A", 3, 30), ("A", 3, 31)]
    assert len(got(dedupe=True)) == 3
    assert got(mode="latest_wins") == [("A", 1, 10), ("A", 2, 99), ("A", 3, 30), ("A", 3, 31)]


@pytest.mark.parametrize("days,extra", [(15, 0), (30, 61)])
def test_horizon_extension_counts(spark, slots, days, extra):
    vals = [1.0] * 8
    live = slots([("A", n, *vals) for n in range(60)], S.MEASURES).withColumn("river_discharge", F.lit(0.0))
    past = slots([("A", n, *vals, 0.0) for n in range(-800, 0)], S.MEASURES + ["river_discharge"])
    zones = spark.createDataFrame([("A",)], "zone string")
    assert K.extend_horizon(live, past, zones, days).count() == 60 + extra


def test_no_extension_when_the_feed_is_long_enough(spark, slots):
    live = slots([("A", n, *[1.0] * 8) for n in range(130)], S.MEASURES).withColumn("river_discharge", F.lit(0.0))
    zones = spark.createDataFrame([("A",)], "zone string")
    past = slots([("A", -4, *[1.0] * 8, 0.0)], S.MEASURES + ["river_discharge"])
    assert K.extend_horizon(live, past, zones, 30).count() == 130


def test_profile_fallback_is_the_mean_of_profile_rows(spark, slots):
    # two years share day 1, one day has one row: profile rows weigh the same
    rows = [("A", 0, 10.0), ("A", 1464, 20.0), ("A", 4, 0.0)]  # 2024-01-01, 2025-01-01, 2024-01-02
    past = slots([(z, n, *[v] * 8, 0.0) for z, n, v in rows], S.MEASURES + ["river_discharge"])
    prof = K.profile(past)
    bounds = spark.createDataFrame([("A", dt.datetime(2028, 12, 31), dt.datetime(2028, 12, 31))],
                                   "zone string, a timestamp_ntz, z timestamp_ntz")
    r = K.climate_slots(bounds, "a", "z", prof).first()  # day 366 is not in the profile
    assert r["temperature_2m"] == pytest.approx((15.0 + 0.0) / 2)


def test_chronological_cut_is_a_row_number_and_ties_go_to_test(spark, slots):
    x = slots([(z, n, 0) for n in range(5) for z in "abc"], ["is_flood"])
    train, test = T.chronological_split(x, 0.2)  # row 12 is slot 4
    assert (train.count(), test.count()) == (12, 3)
    train, test = T.chronological_split(x, 0.3)  # row 10 is inside slot 3
    assert (train.count(), test.count()) == (9, 6)


def test_folds_match_an_index_based_reference(spark, slots):
    x = slots([(z, n, 0) for n in range(9) for z in "abc"][:25], ["is_flood"])
    got = {(r["time_6h"], r["zone"]): r["fold"] for r in T.expanding_folds(x, 5).collect()}
    order = sorted(got)
    size = len(order) // 6
    want = [sum(i >= len(order) - (5 - k) * size for k in range(5)) for i in range(len(order))]
    assert [got[k] for k in order] == want


def test_threshold_takes_the_lowest_of_equal_scores_and_ignores_the_end_point(spark):
    df = spark.createDataFrame([(0.9, 0), (0.8, 1), (0.7, 0), (0.2, 0)], "risk_score double, is_flood int")
    best = M.best_threshold(M.curve(df)).first()
    assert best["threshold"] == 0.8 and best["recall"] == 1.0
    none = spark.createDataFrame([(0.9, 0), (0.1, 0)], "risk_score double, is_flood int")
    assert M.best_threshold(M.curve(none)).first()["threshold"] == 0.1


def test_precision_floor_falls_back(spark):
    df = spark.createDataFrame([(0.9, 0), (0.5, 1), (0.1, 0)], "risk_score double, is_flood int")
    assert M.best_threshold(M.curve(df), floor=0.99).first()["threshold"] == M.best_threshold(M.curve(df)).first()["threshold"]


def test_range_is_start_inclusive_end_exclusive(spark, slots):
    x = slots([("A", n) for n in range(9)], [])
    assert P.between(x, "2024-01-01", "2024-01-02").count() == 4


def test_replay_keeps_the_newest_and_starts_every_zone_at_the_base(spark, slots):
    x = slots([("A", n) for n in range(130)] + [("B", n) for n in range(50, 60)], [])
    base = F.lit("2030-06-01 12:00:00").cast("timestamp_ntz")
    r = {v["zone"]: v for v in P.rebase(P.newest_slots(x), base).groupBy("zone").agg(
        F.min("time_6h").alias("a"), F.count(F.lit(1)).alias("n")).collect()}
    assert {z: v["n"] for z, v in r.items()} == {"A": 120, "B": 10}
    assert {v["a"] for v in r.values()} == {dt.datetime(2030, 6, 1, 12)}


def test_rolling_mean_waits_for_a_full_window(spark, slots):
    x = slots([("A", n, float(n)) for n in range(9)], ["v"])
    got = [r["m"] for r in X.rolling_mean(x, "v", 7, out="m").orderBy("time_6h").collect()]
    assert got == [None] * 6 + [3.0, 4.0, 5.0]


def test_one_hot_keeps_the_categories_of_the_fit(spark, slots):
    cats = ["High Relief", "Low Relief", "Moderate Relief"]
    only = slots([("Moderate Relief", 0)], [])
    r = L.encode_zone(only, cats).first()
    assert (r["zone_Low Relief"], r["zone_Moderate Relief"]) == (0, 1)
    assert L.align(only, ["nothing"]).first()["nothing"] == 0


def test_model_sees_27_of_37_signals():
    cats = ["High Relief", "Low Relief", "Moderate Relief"]
    assert len(S.GOLD_FEATURES) + 2 == 37
    assert len(L.feature_names(["zone", "time_6h", *S.GOLD_FEATURES, "dq_score", "is_flood"], cats)) == 27
