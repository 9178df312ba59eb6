"""Checked queries: climatology, horizon, upsert, feeds, audits."""
from __future__ import annotations

from pyspark.sql import functions as F

from tideline import settings as S
from tideline.functions import columns as C
from tideline.operators import climatology as K, features as X, quality as Q, resample as R
from tideline.plans import oracle as O
from tideline.plans.core_queries import h_silver, round_cycles, silver
from tideline.plans.registry import Registry
from tideline.session import cut_lineage, shared_folder
from tideline.sources import adapters as A, feeds
from tideline.sources.lake import Lake, upsert

climate = Registry()
M = S.MEASURES


@climate.add("A3_climatology_profile", O.sql("SELECT * FROM profile", "profile"))
def _(spark, d):
    return K.profile(h_silver(spark, d))


@climate.add("A4_zone_mean_of_profile", O.sql("SELECT * FROM zone_profile", "zone_profile"))
def _(spark, d):
    return K.zone_profile(K.profile(h_silver(spark, d)))


# The last 15 days of the history serve as live feed, what lies before as history.
_CUT = "(SELECT CAST(CAST(MAX(time_6h) AS DATE) AS TIMESTAMP) - INTERVAL '15 days' FROM h_slots)"
_LIVE = {
    "live": f"SELECT *, 0e0 AS river_discharge FROM h_slots WHERE time_6h >= {_CUT}",
    "past": f"SELECT * FROM h_silver WHERE time_6h < {_CUT}",
    "prof": "SELECT zone, extract(doy FROM time_6h) AS doy, extract(hour FROM time_6h) AS hour, "
            + ", ".join(f"{O.mean(c)} AS {c}" for c in M) + " FROM past GROUP BY 1, 2, 3",
    "zmean": "SELECT zone, " + ", ".join(f"{O.mean(c)} AS {c}" for c in M) + " FROM prof GROUP BY 1",
    "span": "SELECT MAX(time_6h) + INTERVAL '6 hours' AS a, MIN(time_6h) + INTERVAL '30 days' AS z FROM live",
    "grid": "SELECT v.zone, t.time_6h FROM zone_dim v, (SELECT unnest(generate_series("
            "time_bucket(INTERVAL '6 hours', a), time_bucket(INTERVAL '6 hours', z), INTERVAL '6 hours')) "
            "AS time_6h FROM span WHERE z > a) t",
    "looked": "SELECT g.zone, g.time_6h, " + O.cols(M, "p.{0}") + " FROM grid g LEFT JOIN prof p ON "
              "p.zone = g.zone AND p.doy = extract(doy FROM g.time_6h) AND p.hour = extract(hour FROM g.time_6h)",
    "filled": "SELECT l.zone, l.time_6h, " + O.cols(M, "coalesce(l.{0}, z.{0}) AS {0}")
              + ", 0e0 AS river_discharge FROM looked l LEFT JOIN zmean z ON z.zone = l.zone",
    "wide": "SELECT *, 'live' AS source FROM live UNION ALL BY NAME SELECT *, 'climatology' AS source FROM filled",
}
_NEED = ("h_slots", "h_silver", "zone_dim")


def split_history(spark, d):
    """(live, past): the last 15 days as forecast slots, the earlier silver rows.

    Both come from stored tables, as in a deployment.
    """
    slots = cut_lineage(R.forecast_slots(A.history_weather(spark, d)))
    history = cut_lineage(h_silver(spark, d))
    cut = slots.agg((F.to_date(F.max("time_6h")).cast("timestamp_ntz")
                     - F.make_dt_interval(F.lit(15))).alias("c")).scalar()
    return slots.filter(F.col("time_6h") >= cut), history.filter(F.col("time_6h") < cut)


def _bounds(spark, d):
    live, past = split_history(spark, d)
    return K.extension_bounds(live, A.zones(spark)), past


@climate.add("G1_time_grid", O.sql("SELECT zone, time_6h FROM grid", *_NEED, extra=_LIVE))
def _(spark, d):
    bounds, _ = _bounds(spark, d)
    return K.time_grid(bounds, "gap_start", "gap_end").select("zone", "time_6h")


@climate.add("J4_climatology_lookup", O.sql("SELECT * FROM looked", *_NEED, extra=_LIVE))
def _(spark, d):
    bounds, past = _bounds(spark, d)
    return K.lookup(K.time_grid(bounds, "gap_start", "gap_end"), K.profile(past))


@climate.add("J5_zone_mean_fallback", O.sql("SELECT * FROM filled", *_NEED, extra=_LIVE))
def _(spark, d):
    bounds, past = _bounds(spark, d)
    return K.climate_slots(bounds, "gap_start", "gap_end", K.profile(past))


@climate.add("G3_extend_horizon", O.sql("SELECT * EXCLUDE (source) FROM wide", *_NEED, extra=_LIVE))
def _(spark, d):
    live, past = split_history(spark, d)
    return K.extend_horizon(live, past, A.zones(spark))


@climate.add("U2_live_and_climatology", O.sql(
    "SELECT source, zone, COUNT(*) AS slots, MIN(time_6h) AS first_slot, MAX(time_6h) AS last_slot "
    "FROM wide GROUP BY 1, 2", *_NEED, extra=_LIVE))
def _(spark, d):
    live, past = split_history(spark, d)
    return (K.extend_horizon(live, past, A.zones(spark), tag_source=True).groupBy("source", "zone")
            .agg(F.count(F.lit(1)).alias("slots"), F.min("time_6h").alias("first_slot"),
                 F.max("time_6h").alias("last_slot")))


@climate.add("P26_source_tag", O.sql("SELECT zone, time_6h, source FROM wide", *_NEED, extra=_LIVE))
def _(spark, d):
    live, past = split_history(spark, d)
    return (K.extend_horizon(live, past, A.zones(spark), tag_source=True)
            .select("zone", "time_6h", "source"))


# ---- upsert -----------------------------------------------------------------------------
_PARTS = {  # stored: slots up to a cut; batch: slots from an earlier cut, with other values
    "stored": "SELECT zone, time_6h, precipitation FROM h_slots WHERE time_6h < TIMESTAMP '2000-01-01'",
    "batch": "SELECT zone, time_6h, precipitation + 1 AS precipitation FROM h_slots "
             "WHERE time_6h >= TIMESTAMP '1999-01-01'",
}


def _parts(spark, d):
    x = R.resample(A.history_weather(spark, d)).select("zone", "time_6h", "precipitation")
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    return (x.filter(F.col("time_6h") < at("2000-01-01")),
            x.filter(F.col("time_6h") >= at("1999-01-01"))
            .withColumn("precipitation", F.col("precipitation") + 1))


@climate.add("J6_insert_if_absent", O.sql(
    "SELECT * FROM stored UNION ALL SELECT * FROM batch b WHERE NOT EXISTS (SELECT 1 FROM stored s "
    "WHERE s.zone = b.zone AND s.time_6h = b.time_6h)", "h_slots", extra=_PARTS))
def _(spark, d):
    stored, batch = _parts(spark, d)
    return upsert(stored, batch, ["zone", "time_6h"])


@climate.add("J6_latest_wins", O.sql(
    "SELECT * FROM batch UNION ALL SELECT * FROM stored s WHERE NOT EXISTS (SELECT 1 FROM batch b "
    "WHERE s.zone = b.zone AND s.time_6h = b.time_6h)", "h_slots", extra=_PARTS))
def _(spark, d):
    stored, batch = _parts(spark, d)
    return upsert(stored, batch, ["zone", "time_6h"], mode="latest_wins")


@climate.add("U1_union_all", O.sql(
    "SELECT zone, time_6h, precipitation FROM stored UNION ALL SELECT * FROM batch", "h_slots", extra=_PARTS))
def _(spark, d):
    stored, batch = _parts(spark, d)
    return stored.unionByName(batch)


# ---- forecast flow ------------------------------------------------------------------------
_STREAM = dict(_LIVE)
_STREAM["st_base"] = O._base("wide", is_forecast=True)
_STREAM["st_framed"] = O._framed("st_base")
_STREAM["st_derived"] = O._derived("st_framed")
_STREAM["st_gold"] = O._gold("st_derived")
_NOW = "(SELECT MIN(time_6h) + INTERVAL '5 days' FROM live)"


@climate.add("C4_forecast_features", O.sql(f"SELECT * FROM st_gold WHERE time_6h >= {_NOW}", *_NEED,
                                           extra=_STREAM))
def _(spark, d):
    from tideline.plans.flows import forecast_features
    live, past = split_history(spark, d)
    now = live.agg((F.min("time_6h") + F.make_dt_interval(F.lit(5))).alias("n")).scalar()
    return round_cycles(forecast_features(live, past, A.zones(spark), now))


@climate.add("P20_future_only", O.sql(f"SELECT zone, time_6h FROM wide WHERE time_6h >= {_NOW}", *_NEED,
                                      extra=_LIVE))
def _(spark, d):
    live, past = split_history(spark, d)
    now = live.agg((F.min("time_6h") + F.make_dt_interval(F.lit(5))).alias("n")).scalar()
    return (K.extend_horizon(live, past, A.zones(spark)).filter(F.col("time_6h") >= now)
            .select("zone", "time_6h"))


# ---- landed feeds ---------------------------------------------------------------------------
_HOURS = {"hours": "SELECT zone, time, " + ", ".join(f"{O.mean(c)} AS {c}" for c in M)
          + " FROM weather GROUP BY 1, 2"}


def _hourly(spark, d):
    from tideline.functions.sums import mean
    return A.weather_hourly(spark, d).groupBy("zone", "time").agg(*[mean(c).alias(c) for c in M])


def _landed(spark, d):
    path = shared_folder(spark, "landed-hourly")
    feeds.write_documents(_hourly(spark, d), path, "hourly", M)
    return feeds.read_documents(spark, path, "hourly", M)


@climate.add("S1_columnar_json_hourly", O.sql("SELECT * FROM hours", "weather", extra=_HOURS))
def _(spark, d):
    return feeds.weather(_landed(spark, d))


@climate.add("S2_columnar_json_forecast", O.sql(
    "SELECT h.* FROM hours h JOIN (SELECT zone, MIN(time) + INTERVAL '15 days' AS z FROM hours GROUP BY 1) e "
    "ON e.zone = h.zone AND h.time < e.z", "weather", extra=_HOURS))
def _(spark, d):
    return feeds.forecast(_landed(spark, d))


@climate.add("S3_columnar_json_daily", O.sql("SELECT * FROM discharge", "discharge"))
def _(spark, d):
    path = shared_folder(spark, "landed-daily")
    feeds.write_documents(A.discharge_daily(spark, d), path, "daily", [S.DISCHARGE], per="month")
    return feeds.discharge(feeds.read_documents(spark, path, "daily", [S.DISCHARGE]))


@climate.add("S4_forecast_without_failed_zone", O.sql(
    "SELECT zone, COUNT(*) AS hours, COUNT(temperature_2m) AS temps FROM hours "
    "WHERE zone <> 'Low Relief' GROUP BY 1", "weather", extra=_HOURS))
def _(spark, d):
    docs = _landed(spark, d)
    broken = docs.withColumn("hourly", F.when(F.col("zone") != "Low Relief", F.col("hourly")))
    return (feeds.forecast(broken, days=10_000).groupBy("zone")
            .agg(F.count(F.lit(1)).alias("hours"), F.count("temperature_2m").alias("temps")))


@climate.add("S5_csv_scan", O.sql("SELECT zone, time, temperature_2m, precipitation FROM hours", "weather",
                                  extra=_HOURS))
def _(spark, d):
    path = shared_folder(spark, "landed-csv")
    feeds.write_csv(_hourly(spark, d).select(F.col("zone").alias("part"), "zone", "time",
                                             "temperature_2m", "precipitation"), path, ["part"])
    return feeds.read_csv(spark, f"{path}/part=*", "zone string, time timestamp_ntz, "
                                                  "temperature_2m double, precipitation double")


@climate.add("S9_gold_load", O.sql("SELECT zone, time_6h, api_7d, is_flood FROM gold", "gold"))
def _(spark, d):
    lake = Lake(spark, shared_folder(spark, "lake"))
    lake.replace(X.gold(silver(spark, d)), "gold", "flood_features", ["zone"])
    return lake.read("gold", "flood_features").select("zone", "time_6h", "api_7d", "is_flood")


@climate.add("S12_forecast_records", O.sql(
    "SELECT zone, strftime(time_6h, '%Y-%m-%dT%H:%M:%S') AS time, "
    + O.cols([c for c in S.RECORD_COLUMNS if c not in (
        "zone", "time", "river_discharge", "risk_level", "flood_pred")], "coalesce({0}, 0) AS {0}")
    + ", 0e0 AS river_discharge, flood_pred, coalesce(risk_level, '0') AS risk_level FROM predictions",
    "predictions"))
def _(spark, d):
    return feeds.records(A.predictions(spark, d))


# ---- audits ------------------------------------------------------------------------------------
_SPINE = {
    "ends": "SELECT zone, MIN(time_6h) AS a, MAX(time_6h) AS z FROM h_slots GROUP BY 1",
    "spine": "SELECT zone, unnest(generate_series(a, z, INTERVAL '6 hours')) AS time_6h FROM ends",
    "holes": "SELECT zone, time_6h FROM spine EXCEPT SELECT zone, time_6h FROM h_slots",
}


@climate.add("W11_gap_detection", O.sql("SELECT * FROM holes", "h_slots", extra=_SPINE))
def _(spark, d):
    return Q.missing_slots(R.resample(A.history_weather(spark, d)).select("zone", "time_6h"))


@climate.add("U3_expected_minus_present", O.sql(
    "SELECT zone, CAST(time_6h AS DATE) AS day, COUNT(*) AS missing FROM holes GROUP BY 1, 2", "h_slots",
    extra=_SPINE))
def _(spark, d):
    gaps = Q.missing_slots(R.resample(A.history_weather(spark, d)).select("zone", "time_6h"))
    return gaps.groupBy("zone", F.to_date("time_6h").alias("day")).agg(F.count(F.lit(1)).alias("missing"))


_NULLS = ", ".join(f"CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_{c}"
                   for c in ("temperature_2m", "wind_speed_10m"))


@climate.add("Q1_dataset_audit", O.sql(
    "SELECT 'hourly' AS dataset, h.zone, h.\"rows\", h.\"start\", h.\"end\", "
    "(SELECT COUNT(*) FROM (SELECT unnest(generate_series(h.\"start\", h.\"end\", INTERVAL '1 hour')) AS t "
    "EXCEPT SELECT time FROM weather w WHERE w.zone = h.zone)) AS gaps, null_temperature_2m, null_wind_speed_10m "
    "FROM (SELECT zone, COUNT(*) AS \"rows\", MIN(time) AS \"start\", MAX(time) AS \"end\", " + _NULLS
    + " FROM weather GROUP BY 1) h", "weather"))
def _(spark, d):
    x = Q.audit(A.weather_hourly(spark, d), "hourly", step_hours=1, by=["zone"])
    return x.select("dataset", "zone", "rows", "start", "end", "gaps",
                    F.col("nulls")["temperature_2m"].alias("null_temperature_2m"),
                    F.col("nulls")["wind_speed_10m"].alias("null_wind_speed_10m"))


@climate.add("Q2_null_rates", O.sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS missing, "
    f"CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / COUNT(*) AS rate FROM weather" for c in M), "weather"))
def _(spark, d):
    return Q.null_rates(A.weather_hourly(spark, d), M)


@climate.add("Q3_quality_gate", O.sql("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS missing, floor(CAST(COUNT(*) - COUNT({c}) AS DOUBLE)"
    f" / COUNT(*) * 100 * 100e0 + 0.5e0) / 100e0 AS missing_pct FROM weather" for c in M)
    + ") q WHERE missing_pct > 5", "weather"))
def _(spark, d):
    return Q.quality_gate(A.weather_hourly(spark, d), M)


@climate.add("Q4_dq_summary", O.sql(
    f"SELECT zone, {O.mean('dq_score')} AS mean_dq, COUNT(*) AS \"rows\", "
    "COUNT(*) FILTER (dq_score < 1) AS rows_below_one FROM (" + O.dq_of("f_slots") + ") q GROUP BY 1", "f_slots"))
def _(spark, d):
    x = R.forecast_slots(A.weather_hourly(spark, d)).select("zone", C.dq_score().alias("dq_score"))
    return Q.dq_summary(x)


@climate.add("Q7_table_profile", O.sql(
    "SELECT COUNT(*) AS \"rows\", MIN(time_6h) AS first_time, MAX(time_6h) AS last_time, "
    "COUNT(DISTINCT zone) AS zones, CAST(SUM(is_flood) AS DOUBLE) / COUNT(*) AS positive_rate FROM h_base",
    "h_base"))
def _(spark, d):
    return Q.table_profile(X.base(h_silver(spark, d)))
