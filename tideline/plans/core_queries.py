"""Checked queries: resampling, labels, features, windows, cross-zone joins."""
from __future__ import annotations

from pyspark.sql import functions as F

from tideline import settings as S
from tideline.functions import columns as C
from tideline.operators import features as X, resample as R
from tideline.plans import oracle as O
from tideline.plans.registry import Registry
from tideline.sources import adapters as A

core = Registry()
KEYS = "zone, time_6h"


def silver(spark, d):
    return R.silver(A.weather_hourly(spark, d), A.discharge_daily(spark, d))


def h_silver(spark, d):
    return R.silver(A.history_weather(spark, d), A.history_discharge(spark, d))


def framed(spark, d):
    return X.window_features(X.base(h_silver(spark, d)))


def round_cycles(df):
    for c in ("hour_sin", "hour_cos", "doy_sin", "doy_cos"):
        df = df.withColumn(c, F.round(c, 9))
    return df


# ---- resampling and label joins ----------------------------------------------
@core.add("A1_resample_6h", O.sql("SELECT * FROM slots", "slots"))
def _(spark, d):
    return R.resample(A.weather_hourly(spark, d))


@core.add("A1_resample_6h_history", O.sql("SELECT * FROM h_slots", "h_slots"))
def _(spark, d):
    return R.resample(A.history_weather(spark, d))


@core.add("A1_forecast_slots", O.sql("SELECT * FROM f_slots", "f_slots"))
def _(spark, d):
    return R.forecast_slots(A.weather_hourly(spark, d))


@core.add("A2_daily_discharge", O.sql("SELECT * FROM h_daily", "h_daily"))
def _(spark, d):
    return R.daily_discharge(A.history_discharge(spark, d))


@core.add("J1_discharge_day_before", O.sql(
    "SELECT w.zone, w.time_6h, w.precipitation, d.river_discharge FROM slots w LEFT JOIN daily d "
    "ON w.zone = d.zone AND CAST(w.time_6h AS DATE) = d.date_key + 1", "slots", "daily"))
def _(spark, d):
    slots = R.resample(A.weather_hourly(spark, d)).select("zone", "time_6h", "precipitation")
    return R.join_discharge(slots, R.daily_discharge(A.discharge_daily(spark, d)))


@core.add("J2_discharge_same_day", O.sql(
    "SELECT w.zone, w.time_6h, w.precipitation, d.river_discharge FROM h_slots w LEFT JOIN h_daily d "
    "ON w.zone = d.zone AND CAST(w.time_6h AS DATE) = d.date_key", "h_slots", "h_daily"))
def _(spark, d):
    slots = R.resample(A.history_weather(spark, d)).select("zone", "time_6h", "precipitation")
    return R.join_discharge(slots, R.daily_discharge(A.history_discharge(spark, d)), lag_days=0)


@core.add("C1_bronze_to_silver", O.sql("SELECT * FROM silver", "silver"))
def _(spark, d):
    return silver(spark, d)


@core.add("C1_bronze_to_silver_history", O.sql("SELECT * FROM h_silver", "h_silver"))
def _(spark, d):
    return h_silver(spark, d)


@core.add("C2_gold", O.sql("SELECT * FROM gold", "gold"))
def _(spark, d):
    return round_cycles(X.gold(silver(spark, d)))


@core.add("C2_gold_history", O.sql("SELECT * FROM h_gold", "h_gold"))
def _(spark, d):
    return round_cycles(X.gold(h_silver(spark, d)))


# ---- projections ----------------------------------------------------------------
@core.add("P1_null_to_zero", O.sql(
    f"SELECT {KEYS}, " + O.cols(S.MEASURES, "coalesce({0}, 0e0) AS {0}") + " FROM slots", "slots"))
def _(spark, d):
    return R.resample(A.weather_hourly(spark, d)).na.fill(0.0, S.MEASURES)


@core.add("P2_flood_label", O.sql(f"SELECT {KEYS}, {O.label()} AS is_flood FROM h_silver", "h_silver"))
def _(spark, d):
    return h_silver(spark, d).select("zone", "time_6h", C.flood_label().alias("is_flood"))


@core.add("P3_exceedance_days", O.sql(
    "SELECT zone, COUNT(*) AS days, CAST(SUM(CASE WHEN river_discharge > 1 THEN 1 ELSE 0 END) AS BIGINT) "
    "AS days_above FROM h_daily GROUP BY zone", "h_daily"))
def _(spark, d):
    return (R.daily_discharge(A.history_discharge(spark, d)).groupBy("zone")
            .agg(F.count(F.lit(1)).alias("days"),
                 F.sum(C.exceeds(S.DISCHARGE)).cast("bigint").alias("days_above")))


@core.add("P4_dq_score", O.sql(O.dq_of("f_slots"), "f_slots"))
def _(spark, d):
    return R.forecast_slots(A.weather_hourly(spark, d)).select(
        "zone", "time_6h", C.dq_score().alias("dq_score"))


@core.add("P5_label_without_discharge", O.sql("SELECT * FROM h_base", "h_base"))
def _(spark, d):
    return X.base(h_silver(spark, d)).select(
        "zone", "time_6h", *S.MEASURES, "is_flood", "dq_score")


def _derived_query(name, columns):
    @core.add(name, O.sql(f"SELECT {KEYS}, {columns} FROM h_derived", "h_derived"))
    def _(spark, d, columns=columns):
        keep = [c.strip() for c in columns.split(",")]
        return X.derived(framed(spark, d)).select("zone", "time_6h", *keep)


_derived_query("P6_antecedent_index", "api_7d")
_derived_query("P7_soil_index", "soil_saturation_index, soil_moisture_deficit")
_derived_query("P8_trends", "soil_moisture_change_6h, temp_trend_24h")
_derived_query("P9_frozen_flag", "frozen_ground_flag")
_derived_query("P10_water_balance", "et_deficit_6h, et_deficit_24h, humidity_precip_product")


@core.add("P11_cyclic", O.sql(f"SELECT {KEYS}, {O.cycle_list()} FROM h_silver", "h_silver"))
def _(spark, d):
    x = h_silver(spark, d).select("zone", "time_6h")
    return round_cycles(x.select("*", *[c.alias(n) for n, c in C.cyclic().items()]))


@core.add("P12_cascade_risk", O.sql(f"SELECT {KEYS}, zone_cascade_risk FROM h_gold", "h_gold"))
def _(spark, d):
    x = X.with_upstream(framed(spark, d))
    return x.select("zone", "time_6h", X.cascade_risk().alias("zone_cascade_risk"))


# ---- windows ----------------------------------------------------------------------
_LAGS = "precip_lag_6h, precip_lag_12h, precip_lag_24h, precip_lag_48h, temp_lag_24h"
_SUMS = "precip_roll_sum_24h, precip_roll_sum_48h, precip_roll_sum_72h, et0_roll_sum_24h"
_MAXES = "precip_roll_max_24h, humidity_roll_max_24h"


def _window_query(name, columns):
    @core.add(name, O.sql(f"SELECT {KEYS}, {columns} FROM h_framed", "h_framed"))
    def _(spark, d, columns=columns):
        return framed(spark, d).select("zone", "time_6h", *[c.strip() for c in columns.split(",")])


_window_query("W1_lags", _LAGS)
_window_query("W2_rolling_sums", _SUMS)
_window_query("W3_rolling_max", _MAXES)


@core.add("W4_full_window_mean", O.sql(
    "SELECT zone, time_6h, CASE WHEN COUNT(temperature_2m) OVER a = 7 THEN "
    + O.mean("temperature_2m", " OVER a") + " END AS temp_mean_7, "
    "CASE WHEN COUNT(temperature_2m) OVER b = 14 THEN " + O.mean("temperature_2m", " OVER b")
    + " END AS temp_mean_14 FROM slots WINDOW "
    "a AS (PARTITION BY zone ORDER BY time_6h ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), "
    "b AS (PARTITION BY zone ORDER BY time_6h ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)", "slots"))
def _(spark, d):
    x = R.resample(A.weather_hourly(spark, d)).select("zone", "time_6h", "temperature_2m")
    x = X.rolling_mean(x, "temperature_2m", 7, out="temp_mean_7")
    x = X.rolling_mean(x, "temperature_2m", 14, out="temp_mean_14")
    return x.select("zone", "time_6h", "temp_mean_7", "temp_mean_14")


# ---- cross-zone context ---------------------------------------------------------------
@core.add("J3_upstream_context", O.sql(
    "SELECT x.zone, x.time_6h, up.precip_roll_sum_24h AS highland_precip_24h FROM h_framed x "
    "LEFT JOIN h_framed up ON up.zone = 'High Relief' AND up.time_6h = x.time_6h", "h_framed"))
def _(spark, d):
    return X.with_upstream(framed(spark, d)).select("zone", "time_6h", "highland_precip_24h")


_LEGACY = {
    "same_day": O._silver("h_slots", "h_daily", lag=0),
    "lf": ("SELECT *, " + O.frames(
        ", LAG(river_discharge, 1) OVER s AS discharge_lag_6h, LAG(river_discharge, 4) OVER s AS "
        "discharge_lag_24h, MAX(river_discharge) OVER (s ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS "
        "discharge_roll_max_24h")
        + " FROM same_day WINDOW s AS (PARTITION BY zone ORDER BY time_6h)"),
    "ld": f"SELECT * EXCLUDE (soil_before), {O.derive_list()}, "
          "river_discharge - discharge_lag_6h AS discharge_trend_6h FROM lf",
}


@core.add("J3_legacy_features", O.sql(
    "SELECT x.zone, x.time_6h, x.discharge_lag_6h, x.discharge_lag_24h, x.discharge_roll_max_24h, "
    "x.discharge_trend_6h, x.api_7d, x.soil_moisture_change_6h, up.precip_roll_sum_24h AS highland_precip_24h, "
    "up.river_discharge AS highland_discharge_6h, CASE x.zone WHEN 'High Relief' THEN "
    "x.precip_roll_sum_24h * (1e0 / 3e0) WHEN 'Moderate Relief' THEN up.precip_roll_sum_24h * (1e0 / 1.5e0) "
    "ELSE up.precip_roll_sum_24h END AS zone_cascade_risk, CASE WHEN x.river_discharge > 1 AND "
    "(x.precipitation > 1 OR x.relative_humidity_2m > 85) THEN 1 ELSE 0 END AS is_flood FROM ld x "
    "LEFT JOIN ld up ON up.zone = 'High Relief' AND up.time_6h = x.time_6h "
    "WHERE x.precip_lag_48h IS NOT NULL", "h_slots", "h_daily", extra=_LEGACY))
def _(spark, d):
    slots = R.silver(A.history_weather(spark, d), A.history_discharge(spark, d), lag_days=0)
    return X.legacy_features(slots).select(
        "zone", "time_6h", "discharge_lag_6h", "discharge_lag_24h", "discharge_roll_max_24h",
        "discharge_trend_6h", "api_7d", "soil_moisture_change_6h", "highland_precip_24h",
        "highland_discharge_6h", "zone_cascade_risk", "is_flood")


@core.add("P21_warm_up_filter", O.sql(
    f"SELECT {KEYS}, precip_lag_48h, is_flood FROM h_framed WHERE precip_lag_48h IS NOT NULL "
    "AND is_flood IS NOT NULL", "h_framed"))
def _(spark, d):
    return (framed(spark, d).filter(F.col("precip_lag_48h").isNotNull() & F.col("is_flood").isNotNull())
            .select("zone", "time_6h", "precip_lag_48h", "is_flood"))


@core.add("G2_slot_floor", O.sql(
    "SELECT zone, time, time_bucket(INTERVAL '6 hours', time) AS slot, COUNT(*) AS n FROM weather "
    "GROUP BY ALL", "weather"))
def _(spark, d):
    return (A.weather_hourly(spark, d).withColumn("slot", R.slot_start("time"))
            .groupBy("zone", "time", "slot").agg(F.count(F.lit(1)).alias("n")))


@core.add("S7_bronze_union", O.sql(
    "SELECT zone, COUNT(*) AS n, MIN(time) AS first_time, MAX(time) AS last_time FROM h_weather GROUP BY zone",
    "h_weather"))
def _(spark, d):
    # one table with a zone column takes the place of a table per zone: one scan, and no zone is left out
    return (A.history_weather(spark, d).groupBy("zone")
            .agg(F.count(F.lit(1)).alias("n"), F.min("time").alias("first_time"),
                 F.max("time").alias("last_time")))
