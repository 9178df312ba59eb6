"""Checked queries: levels, alerts, archive, boards, small aggregates."""
from __future__ import annotations

from pyspark.sql import functions as F

from tideline import settings as S
from tideline.functions import columns as C
from tideline.operators import features as X, report as P, resample as R
from tideline.plans import flows, oracle as O
from tideline.plans.core_queries import h_silver
from tideline.plans.registry import Registry
from tideline.sources import adapters as A

report = Registry()
KEYS = "zone, time_6h"
H3 = "floor(({0}) * 1000e0 + 0.5e0) / 1000e0"
H1 = "floor(({0}) * 10e0 + 0.5e0) / 10e0"
H2 = "floor(({0}) * 100e0 + 0.5e0) / 100e0"
_CUT = O.level_cut("risk_score")
_LEVELS = {"lv": f"SELECT *, {_CUT} AS risk_level FROM scored"}


def scored(spark, d):
    return A.scored(spark, d).withColumn("risk_level", C.risk_level_cut("risk_score"))


def labelled(spark, d):
    return X.base(h_silver(spark, d))


# ---- levels, flags, texts --------------------------------------------------------
@report.add("P13_one_hot_align", O.sql(
    f"SELECT {KEYS}, precipitation, CASE WHEN zone = 'Low Relief' THEN 1 ELSE 0 END AS \"zone_Low Relief\", "
    "CASE WHEN zone = 'Moderate Relief' THEN 1 ELSE 0 END AS \"zone_Moderate Relief\", 0 AS absent_signal "
    "FROM h_base", "h_base"))
def _(spark, d):
    from tideline.operators.learning import align, encode_zone
    x = encode_zone(labelled(spark, d), ["High Relief", "Low Relief", "Moderate Relief"])
    names = ["precipitation", "zone_Low Relief", "zone_Moderate Relief", "absent_signal"]
    return align(x, names, keep=["zone", "time_6h"])


@report.add("P14_level_right_closed", O.sql(f"SELECT {KEYS}, {_CUT} AS risk_level FROM scored", "scored"))
def _(spark, d):
    return scored(spark, d).select("zone", "time_6h", "risk_level")


@report.add("P15_level_left_closed", O.sql(
    f"SELECT {KEYS}, {O.level_ge('risk_score')} AS risk_level FROM scored", "scored"))
def _(spark, d):
    return A.scored(spark, d).select("zone", "time_6h", C.risk_level_ge("risk_score").alias("risk_level"))


@report.add("P16_flag", O.sql(
    f"SELECT {KEYS}, CASE WHEN risk_score >= 0.45e0 THEN 1 ELSE 0 END AS flood_pred FROM scored", "scored"))
def _(spark, d):
    return A.scored(spark, d).select("zone", "time_6h", C.flood_pred("risk_score", 0.45).alias("flood_pred"))


_PCT = H1.format("peak * 100")
_ALERT = ("SELECT zone, " + H3.format("peak") + f" AS max_risk_score, {O.level_ge('peak')} AS risk_level, "
          "hours AS high_risk_exposure_hours, CASE WHEN peak >= 0.6e0 THEN '🚨 CRITICAL: ' || zone || ' shows ' || "
          f"({_PCT}) || '% flood probability. ' || hours || 'h total exposure predicted.' "
          f"WHEN peak >= 0.3e0 THEN '⚠️ WARNING: ' || zone || ' shows ' || ({_PCT}) || "
          "'% flood probability. Monitor levels.' "
          f"ELSE '✅ Normal: ' || zone || ' risk is low (' || ({_PCT}) || '%).' END AS alert_message FROM ")


@report.add("A5_zone_alerts", O.sql(
    _ALERT + "(SELECT zone, MAX(risk_score) AS peak, 6 * COUNT(*) FILTER (risk_level = 'HIGH') AS hours "
    "FROM lv GROUP BY 1) q", "scored", extra=_LEVELS))
def _(spark, d):
    return P.zone_alerts(scored(spark, d))


@report.add("P17_alert_text_per_day", O.sql(
    "SELECT day, zone, alert_message FROM (" + _ALERT.replace("SELECT zone,", "SELECT day, zone,", 1)
    + "(SELECT CAST(time_6h AS DATE) AS day, zone, MAX(risk_score) AS peak, 6 * COUNT(*) FILTER "
    "(risk_level = 'HIGH') AS hours FROM lv GROUP BY 1, 2) q) t", "scored", extra=_LEVELS))
def _(spark, d):
    day = scored(spark, d).groupBy(F.to_date("time_6h").alias("day"), "zone").agg(
        F.max("risk_score").alias("peak"), (6 * F.count_if(F.col("risk_level") == "HIGH")).alias("hours"))
    day = day.withColumn("lv", C.risk_level_ge("peak"))
    return day.select("day", "zone", C.alert_message("zone", "lv", "peak", "hours").alias("alert_message"))


@report.add("P18_zone_slug", O.sql(
    "SELECT lower(replace(zone, ' ', '_')) AS slug, COUNT(*) AS n FROM scored GROUP BY 1", "scored"))
def _(spark, d):
    return A.scored(spark, d).groupBy(C.zone_slug("zone").alias("slug")).agg(F.count(F.lit(1)).alias("n"))


@report.add("P19_date_range", O.sql(
    f"SELECT {KEYS}, risk_score FROM scored WHERE time_6h >= TIMESTAMP '1997-03-01' AND "
    "time_6h < TIMESTAMP '1999-06-15 12:00:00'", "scored"))
def _(spark, d):
    return P.between(A.scored(spark, d), "1997-03-01", "1999-06-15 12:00:00").select(
        "zone", "time_6h", "risk_score")


_VIEW = (f"SELECT zone, strftime(time_6h, '%Y-%m-%dT%H:%M:%S') AS time, precipitation, "
         "risk_score AS predicted_score, CAST(is_flood AS DOUBLE) AS actual_score, flood_pred, is_flood, "
         f"{O.level_ge('risk_score')} AS predicted_level, {O.level_ge('is_flood')} AS actual_level, "
         "CAST(NULL AS VARCHAR) AS event_label FROM scored")


@report.add("P22_history_view", O.sql(_VIEW, "scored"))
def _(spark, d):
    return P.history_view(A.scored(spark, d))


@report.add("P23_soil_gauge", O.sql(
    f"SELECT {KEYS}, CAST(floor(soil_moisture_0_to_7cm * 100 + 0.5e0) AS INT) AS pct, CASE WHEN "
    "floor(soil_moisture_0_to_7cm * 100 + 0.5e0) > 70 THEN 'RED' WHEN floor(soil_moisture_0_to_7cm * 100 + 0.5e0) "
    "> 45 THEN 'AMBER' ELSE 'GREEN' END AS band FROM h_silver", "h_silver"))
def _(spark, d):
    pct, band = C.soil_band("soil_moisture_0_to_7cm")
    return h_silver(spark, d).select("zone", "time_6h", pct.alias("pct"), band.alias("band"))


_SLOT = {"ix": "SELECT *, dense_rank() OVER (ORDER BY time_6h) - 1 AS slot FROM lv"}


@report.add("P24_horizon_label", O.sql(
    f"SELECT {KEYS}, slot, CASE WHEN slot = 0 THEN 'NOW' WHEN slot < 60 THEN '+' || (slot * 6) || 'h' "
    "ELSE 'DAY ' || (slot // 4 + 1) END AS label FROM ix", "scored", extra={**_LEVELS, **_SLOT}))
def _(spark, d):
    return P.slot_index(A.scored(spark, d)).select("zone", "time_6h", "slot",
                                                   C.horizon_label("slot").alias("label"))


@report.add("W12_slot_snapshot", O.sql(
    "SELECT zone, time_6h, slot, risk_score FROM ix", "scored", extra={**_LEVELS, **_SLOT}))
def _(spark, d):
    return P.slot_index(A.scored(spark, d)).select("zone", "time_6h", "slot", "risk_score")


_CHART = ("SELECT zone, time, " + H1.format("predicted_score * 100") + " AS predicted, "
          + H1.format("actual_score * 100") + " AS actual, " + H2.format("precipitation") + " AS precip FROM hv")


@report.add("P25_chart_rows", O.sql(_CHART, "scored", extra={"hv": _VIEW}))
def _(spark, d):
    return P.chart_rows(P.history_view(A.scored(spark, d)))


# ---- aggregates --------------------------------------------------------------------
@report.add("A6_zone_risk_summary", O.sql(
    "SELECT zone, " + H3.format("MAX(risk_score)") + " AS max_risk, " + H3.format(O.mean("risk_score"))
    + " AS mean_risk, COUNT(*) FILTER (risk_score >= 0.6) AS high_risk_periods, "
    "COUNT(*) FILTER (risk_score >= 0.3 AND risk_score < 0.6) AS med_risk_periods FROM scored GROUP BY 1", "scored"))
def _(spark, d):
    return P.zone_risk(A.scored(spark, d))


@report.add("A7_run_metadata", O.sql(
    "SELECT MIN(time_6h) AS forecast_start, MAX(time_6h) AS forecast_end, 30 AS horizon_days, "
    "COUNT(*) FILTER (risk_level = 'HIGH') AS high_risk_count, 'tide_gbt' AS model_used FROM lv", "scored",
    extra=_LEVELS))
def _(spark, d):
    return P.run_metadata(scored(spark, d), "tide_gbt")


@report.add("A8_archive_summary", O.sql(
    "SELECT zone, " + H1.format("MAX(precipitation)") + " AS peak_rain, COUNT(*) FILTER (is_flood = 1) AS "
    "flood_events, COUNT(*) FILTER (is_flood = 1 AND flood_pred = 1) AS detected, COUNT(*) FILTER "
    "(is_flood = 1 AND flood_pred = 0) AS missed FROM scored GROUP BY 1", "scored"))
def _(spark, d):
    return P.archive_summary(A.scored(spark, d))


_CITY = ("SELECT time_6h, CASE WHEN h > 0 THEN 'FLOOD ALERT' WHEN m >= 2 THEN 'CITY-WIDE ADVISORY' WHEN m = 1 THEN "
         "'LOCAL WATCH' ELSE 'ALL CLEAR' END AS label, CASE WHEN h > 0 THEN 'HIGH' WHEN m >= 1 THEN 'MEDIUM' "
         "ELSE 'LOW' END AS level FROM (SELECT time_6h, COUNT(*) FILTER (risk_level = 'HIGH') AS h, "
         "COUNT(*) FILTER (risk_level = 'MEDIUM') AS m FROM lv GROUP BY 1) q")


@report.add("A9_city_status", O.sql(_CITY, "scored", extra=_LEVELS))
def _(spark, d):
    return P.city_status(scored(spark, d))


_BAL = ("COUNT(*) AS \"rows\", CAST(SUM(is_flood) AS BIGINT) AS positives, CAST(COUNT(*) - SUM(is_flood) AS BIGINT) "
        "AS negatives, CAST(SUM(is_flood) AS DOUBLE) / COUNT(*) AS rate, (1 - CAST(SUM(is_flood) AS DOUBLE) / "
        "COUNT(*)) / greatest(CAST(SUM(is_flood) AS DOUBLE) / COUNT(*), 1e-9) AS imbalance FROM scored")


@report.add("A10_class_balance", O.sql(f"SELECT {_BAL}", "scored"))
def _(spark, d):
    return P.class_balance(A.scored(spark, d))


@report.add("A10_class_balance_by_zone", O.sql(f"SELECT zone, {_BAL} GROUP BY zone", "scored"))
def _(spark, d):
    return P.class_balance(A.scored(spark, d), ["zone"])


@report.add("A11_month_zone_pivot", O.sql(
    "SELECT extract(month FROM time_6h) AS month, " + ", ".join(
        f"CAST(SUM(is_flood) FILTER (zone = '{z}') AS DOUBLE) / COUNT(*) FILTER (zone = '{z}') AS \"{z}\""
        for z, _, _ in S.ZONES) + " FROM scored GROUP BY 1", "scored"))
def _(spark, d):
    return P.month_zone_rate(A.scored(spark, d), [z for z, _, _ in S.ZONES])


@report.add("A12_month_series", O.sql(
    "SELECT last_day(m) AS month_end, v AS mean_is_flood FROM (SELECT unnest(generate_series(date_trunc('month', "
    "MIN(time_6h)), date_trunc('month', MAX(time_6h)), INTERVAL '1 month')) AS m FROM scored WHERE "
    "zone = 'Low Relief') s LEFT JOIN (SELECT last_day(time_6h) AS e, CAST(SUM(is_flood) AS DOUBLE) / COUNT(*) AS v "
    "FROM scored WHERE zone = 'Low Relief' GROUP BY 1) q ON q.e = last_day(s.m)", "scored"))
def _(spark, d):
    return P.month_series(A.scored(spark, d), "Low Relief")


@report.add("A13_month_climatology", O.sql(
    "SELECT extract(month FROM time_6h) AS month, " + ", ".join(
        H3.format(e) + f" AS {n}" for e, n in (
            (O.mean("precipitation"), "precip_mean"), (O.mean("river_discharge"), "discharge_mean"),
            ("CAST(SUM(is_flood) AS DOUBLE) / COUNT(is_flood)", "flood_rate"),
            (O.mean("et0_fao_evapotranspiration"), "et0_mean")))
    + f" FROM (SELECT *, {O.label()} AS is_flood FROM h_silver) q GROUP BY 1", "h_silver"))
def _(spark, d):
    return P.month_climatology(h_silver(spark, d).withColumn("is_flood", C.flood_label()))


@report.add("A14_annual_totals", O.sql(
    f"SELECT zone, extract(year FROM time_6h) AS year, {O.total('precipitation')} AS precipitation_total "
    "FROM h_silver GROUP BY 1, 2", "h_silver"))
def _(spark, d):
    return P.annual_totals(h_silver(spark, d))


@report.add("A15_row_counts", O.sql("SELECT zone, COUNT(*) AS n FROM h_weather GROUP BY 1", "h_weather"))
def _(spark, d):
    return A.history_weather(spark, d).groupBy("zone").agg(F.count(F.lit(1)).alias("n"))


@report.add("A20_distinct_zones", O.sql("SELECT DISTINCT zone FROM weather", "weather"))
def _(spark, d):
    return A.weather_hourly(spark, d).select("zone").distinct()


@report.add("A22_chart_ceiling", O.sql(
    "SELECT zone, greatest(MAX(precipitation), 5e0) AS ceiling FROM scored GROUP BY 1", "scored"))
def _(spark, d):
    return P.chart_ceiling(A.scored(spark, d))


# ---- replay, archive, joins ---------------------------------------------------------------
_NEW = {"newest": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY time_6h "
                  "DESC) AS rn FROM lv) q WHERE rn <= 120"}
_REBASED = ("SELECT zone, TIMESTAMP '2026-01-01 06:00:00' + (time_6h - MIN(time_6h) OVER (PARTITION BY zone)) "
            "AS time_6h, risk_score, risk_level FROM newest")


@report.add("W5_newest_per_zone", O.sql("SELECT zone, time_6h, risk_score FROM newest", "scored",
                                        extra={**_LEVELS, **_NEW}))
def _(spark, d):
    return P.newest_slots(A.scored(spark, d)).select("zone", "time_6h", "risk_score")


@report.add("W6_rebase", O.sql(_REBASED, "scored", extra={**_LEVELS, **_NEW}))
def _(spark, d):
    base = F.lit("2026-01-01 06:00:00").cast("timestamp_ntz")
    return P.rebase(P.newest_slots(scored(spark, d)), base).select(
        "zone", "time_6h", "risk_score", "risk_level")


@report.add("C8_forecast_replay", O.sql(
    "SELECT zone, strftime(TIMESTAMP '2026-01-01 06:00:00' + (time_6h - MIN(time_6h) OVER (PARTITION BY zone)), "
    "'%Y-%m-%dT%H:%M:%S') AS time, "
    + O.cols([c for c in S.RECORD_COLUMNS if c not in (
        "zone", "time", "river_discharge", "risk_level", "flood_pred")], "coalesce({0}, 0) AS {0}")
    + ", 0e0 AS river_discharge, flood_pred, coalesce(risk_level, '0') AS risk_level FROM (SELECT *, row_number() "
    "OVER (PARTITION BY zone ORDER BY time_6h DESC) AS rn FROM predictions) q WHERE rn <= 120", "predictions"))
def _(spark, d):
    return flows.forecast_replay(A.predictions(spark, d), F.lit("2026-01-01 06:00:00").cast("timestamp_ntz"))


_NEAR = ("SELECT s.*, MAX(is_flood) OVER (PARTITION BY zone ORDER BY time_6h RANGE BETWEEN INTERVAL '48 hours' "
         "PRECEDING AND INTERVAL '48 hours' FOLLOWING) = 1 AS near FROM scored s")


@report.add("J8_near_event", O.sql(f"SELECT zone, time_6h, near FROM ({_NEAR}) q", "scored"))
def _(spark, d):
    return P.near_event(A.scored(spark, d)).select("zone", "time_6h", "near")


_STATUS = ("SELECT zone, time_6h, CASE WHEN is_flood = 1 AND flood_pred = 1 THEN 'DETECTED' WHEN is_flood = 1 THEN "
           f"'MISSED' WHEN near THEN 'EARLY WARNING' ELSE 'FALSE ALARM' END AS status FROM ({_NEAR}) q "
           "WHERE is_flood = 1 OR flood_pred = 1")


@report.add("M34_error_class", O.sql(_STATUS, "scored"))
def _(spark, d):
    return P.error_class(A.scored(spark, d)).select("zone", "time_6h", "status")


@report.add("M35_timeline", O.sql(
    f"SELECT {KEYS}, risk_score, is_flood, risk_score >= 0.45e0 AS over_threshold, risk_score >= 0.3e0 AS over_medium, "
    "risk_score >= 0.6e0 AS over_high FROM scored", "scored"))
def _(spark, d):
    return P.timeline(A.scored(spark, d), 0.45)


@report.add("C9_historical", O.sql(
    f"SELECT * FROM ({_VIEW}) q WHERE time >= '1998-01-01T00:00:00' AND time < '2000-01-01T00:00:00'", "scored"))
def _(spark, d):
    return flows.historical(A.scored(spark, d), "1998-01-01", "2000-01-01")


_SHOWN = {"shown": "SELECT * FROM scored WHERE time_6h >= TIMESTAMP '1998-01-01' AND "
                   "time_6h < TIMESTAMP '2000-01-01'"}


@report.add("C10_archive_report", O.sql(
    "SELECT zone, status, COUNT(*) AS n FROM (" + _STATUS.replace("FROM scored s", "FROM shown s")
    + ") q GROUP BY 1, 2", "scored", extra=_SHOWN))
def _(spark, d):
    shown = P.between(A.scored(spark, d), "1998-01-01", "2000-01-01")
    return P.error_class(shown).groupBy("zone", "status").agg(F.count(F.lit(1)).alias("n"))


_BOARD = ("SELECT t.time_6h, g.name, g.zone, coalesce(l.risk_level, 'LOW') AS risk_level, coalesce(l.risk_score, 0e0) "
          "AS score, CASE coalesce(l.risk_level, 'LOW') WHEN 'HIGH' THEN 0 WHEN 'MEDIUM' THEN 1 ELSE 2 END AS severity "
          "FROM (SELECT DISTINCT time_6h FROM lv) t, district_dim g LEFT JOIN lv l ON l.zone = g.zone AND "
          "l.time_6h = t.time_6h")


@report.add("J9_district_board", O.sql(_BOARD, "scored", "district_dim", extra=_LEVELS))
def _(spark, d):
    return P.district_board(scored(spark, d))


@report.add("K6_severity_order", O.sql(
    f"SELECT severity, risk_level, COUNT(*) AS n FROM ({_BOARD}) b GROUP BY 1, 2", "scored", "district_dim",
    extra=_LEVELS))
def _(spark, d):
    return (P.district_board(scored(spark, d)).groupBy("severity", "risk_level")
            .agg(F.count(F.lit(1)).alias("n")).orderBy("severity"))


@report.add("C11_city_board", O.sql(
    f"SELECT b.*, c.label, c.level FROM ({_BOARD}) b JOIN ({_CITY}) c USING (time_6h)", "scored", "district_dim",
    extra=_LEVELS))
def _(spark, d):
    x = scored(spark, d)
    return P.district_board(x).join(P.city_status(x), "time_6h")


@report.add("K4_next_alert", O.sql(
    "SELECT zone, time_6h, risk_level, risk_score, CAST(floor(risk_score * 100 + 0.5e0) AS INT) AS percent FROM "
    "(SELECT *, row_number() OVER (PARTITION BY zone ORDER BY time_6h) AS rn FROM lv WHERE risk_level <> 'LOW') q "
    "WHERE rn = 1", "scored", extra=_LEVELS))
def _(spark, d):
    return P.next_alert(scored(spark, d))


@report.add("K5_first_slots", O.sql(
    "SELECT zone, time_6h, precipitation FROM scored WHERE zone = 'Low Relief' ORDER BY time_6h LIMIT 20", "scored"))
def _(spark, d):
    return P.first_slots(A.scored(spark, d), "Low Relief").select("zone", "time_6h", "precipitation")


@report.add("K1_order_at_sink", O.sql(
    f"SELECT {KEYS}, risk_score FROM scored ORDER BY time_6h, zone", "scored"))
def _(spark, d):
    return A.scored(spark, d).select("zone", "time_6h", "risk_score").orderBy("time_6h", "zone")


_RUNS = {
    "n1": "SELECT zone, time_6h, risk_level, row_number() OVER (PARTITION BY zone ORDER BY time_6h) - 1 AS slot FROM lv",
    "n2": "SELECT *, MAX(CASE WHEN risk_level IS DISTINCT FROM 'MEDIUM' THEN slot END) OVER z AS o, "
          "MAX(CASE WHEN risk_level = 'HIGH' THEN slot END) OVER z AS hi FROM n1 WINDOW z AS (PARTITION BY zone "
          "ORDER BY time_6h ROWS UNBOUNDED PRECEDING)",
    "ticks": "SELECT zone, time_6h, slot, risk_level AS level FROM n2 WHERE risk_level = 'HIGH' OR "
             "(risk_level = 'MEDIUM' AND (slot - coalesce(o, -1) - 1 + CASE WHEN hi = o THEN 1 ELSE 0 END) % 2 = 0)",
}


@report.add("W10_event_ticks", O.sql("SELECT * FROM ticks", "scored", extra={**_LEVELS, **_RUNS}))
def _(spark, d):
    return P.event_ticks(scored(spark, d))


@report.add("W10_timeline_ticks", O.sql(
    "SELECT * FROM ticks WHERE zone = 'Low Relief' ORDER BY slot LIMIT 12", "scored", extra={**_LEVELS, **_RUNS}))
def _(spark, d):
    return P.timeline_ticks(scored(spark, d))


EPISODES = (
    "SELECT zone, MIN(time_6h) AS episode_start, MAX(time_6h) + INTERVAL '6 hours' AS episode_end, COUNT(*) AS slots, "
    "COUNT(*) * 6 AS duration_hours, MAX(risk_score) AS peak_score FROM (SELECT *, SUM(fresh) OVER (PARTITION BY zone "
    "ORDER BY time_6h) AS run FROM (SELECT *, CASE WHEN time_6h - LAG(time_6h) OVER (PARTITION BY zone ORDER BY "
    "time_6h) = INTERVAL '6 hours' THEN 0 ELSE 1 END AS fresh FROM scored WHERE flood_pred = 1) a) b GROUP BY zone, run")


@report.add("X7_alert_episodes_batch", O.sql(EPISODES, "scored"))
def _(spark, d):
    return P.alert_episodes(A.scored(spark, d).filter(F.col("flood_pred") == 1))


@report.add("J7_daily_join", O.sql(
    "SELECT w.zone, w.day, w.rain, q.river_discharge, CASE WHEN q.river_discharge > 1 THEN 1 ELSE 0 END AS above FROM "
    f"(SELECT zone, CAST(time AS DATE) AS day, {O.total('precipitation')} AS rain FROM weather GROUP BY 1, 2) w "
    "LEFT JOIN daily q ON q.zone = w.zone AND q.date_key = w.day", "weather", "daily"))
def _(spark, d):
    from tideline.functions.sums import total
    days = (A.weather_hourly(spark, d).groupBy("zone", F.to_date("time").alias("day"))
            .agg(total("precipitation").alias("rain")))
    q = R.daily_discharge(A.discharge_daily(spark, d)).withColumnRenamed("date_key", "day")
    return days.join(q, ["zone", "day"], "left").withColumn("above", C.exceeds(S.DISCHARGE))
