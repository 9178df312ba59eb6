"""Streaming queries, each checked against the batch meaning."""
from __future__ import annotations

from pyspark.sql import functions as F

from tideline import settings as S
from tideline.operators import climatology as K, features as X, resample as R
from tideline.plans import oracle as O
from tideline.plans.core_queries import h_silver
from tideline.plans.report_queries import EPISODES
from tideline.plans.registry import Registry
from tideline.session import cut_lineage, shared_folder
from tideline.sources import adapters as A
from tideline.sources.lake import Lake
from tideline.streaming import streams as G

stream = Registry()
LAGS = [c.strip().split()[0] for c in G.LAG_SCHEMA.split(",")]


def hourly(spark, d):
    schema = A.table(spark, d, "events").schema
    return A.readings_from_events(G.file_stream(spark, d, schema, glob="events.parquet"))


def in_order(spark, df, part, n):
    """Land ``df`` in one pass as a file for each value of ``part`` (from 0), and stream a file at a time in that order."""
    path = shared_folder(spark, "feed")
    df.withColumn("_part", part).repartition(n, "_part").write.partitionBy("_part").parquet(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_part=*/*.parquet")
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for f in fs.globStatus(where) or []:     # a file source takes files by their time
        number = int(f.getPath().getParent().getName().split("=")[1])
        fs.setTimes(f.getPath(), 1_000_000_000_000 + 1000 * number, -1)
    return G.file_stream(spark, path, df.schema, files=1).drop("_part")


def landed(spark, df, time="time_6h", parts=3):
    """Land ``df`` as one file per part of its time range, in time order."""
    day = F.to_date(time)
    span = df.agg(F.min(day).alias("a"), F.datediff(F.max(day), F.min(day)).alias("n")).first()
    days = F.datediff(day, F.lit(span["a"]))
    return in_order(spark, df.filter(F.col(time).isNotNull()), F.floor(days / ((span["n"] or 0) // parts + 1)).cast("int"), parts)


@stream.add("X1_stream_resample", O.sql("SELECT * FROM slots", "slots"))
def _(spark, d):
    return G.run_to_table(G.resample_stream(hourly(spark, d)), "update", ["zone", "time_6h"])


@stream.add("X2_stream_sliding_day", O.sql(
    f"SELECT zone, s AS window_start, {O.total('precipitation')} AS rain_24h, {O.total('et0_fao_evapotranspiration')} AS "
    "et0_24h, MAX(precipitation) AS rain_max_24h, MAX(relative_humidity_2m) AS humidity_max_24h FROM (SELECT *, "
    "unnest([time_bucket(INTERVAL '6 hours', time), time_bucket(INTERVAL '6 hours', time) - INTERVAL '6 hours', "
    "time_bucket(INTERVAL '6 hours', time) - INTERVAL '12 hours', time_bucket(INTERVAL '6 hours', time) - INTERVAL "
    "'18 hours']) AS s FROM weather) q GROUP BY 1, 2", "weather"))
def _(spark, d):
    return G.run_to_table(G.sliding_stream(hourly(spark, d)), "update", ["zone", "window_start"])


@stream.add("X3_stream_first_wins", O.sql("SELECT zone, time_6h, precipitation FROM h_slots", "h_slots"))
def _(spark, d):
    slots = R.resample(A.history_weather(spark, d)).select("zone", "time_6h", "precipitation")
    feed = landed(spark, slots)
    lake = Lake(spark, shared_folder(spark, "lake"))
    # the same feed twice: the second delivery must change nothing
    for _ in range(2):
        G.into_first_wins(feed, lake, "silver", "weather_stream_6h", shared_folder(spark, "progress")).awaitTermination()
    return lake.read("silver", "weather_stream_6h").select("zone", "time_6h", "precipitation")


@stream.add("X3_stream_drop_duplicates", O.sql("SELECT DISTINCT zone, time FROM weather", "weather"))
def _(spark, d):
    rows = hourly(spark, d).select("zone", "time")
    return G.run_to_table(G.first_per_slot(rows, "time"), "append")


# a reading comes up to ten hours late, every 23rd hour 150 hours more; a file holds what came in sixty hours
_HOURS = "CAST(epoch(time) AS BIGINT) // 3600"
_ARRIVED = (f"SELECT zone, time, precipitation, ({_HOURS} + ({_HOURS} * 7) % 11 + CASE WHEN {_HOURS} % 23 = 0 THEN 150 "
            "ELSE 0 END) // 60 AS part FROM weather WHERE time IS NOT NULL")
_CLOCKED = ("SELECT a.*, c.clock, time_bucket(INTERVAL '6 hours', a.time) AS slot, time_bucket(INTERVAL '6 hours', a.time) + "
            "INTERVAL '18 hours' AS due FROM arrived a JOIN (SELECT part, MAX(newest) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED "
            "PRECEDING AND 1 PRECEDING) AS clock FROM (SELECT part, MAX(time) AS newest FROM arrived GROUP BY 1) p) c ON "
            "c.part = a.part")


@stream.add("X4_stream_late_rows", O.sql(
    f"SELECT 'late' AS kind, zone, time, 1::BIGINT AS readings, coalesce(round(precipitation, 9), 0) AS "
    "precipitation FROM clocked WHERE due <= clock UNION ALL SELECT 'slot', zone, slot, COUNT(*), "
    f"coalesce({O.total('precipitation')}, 0) FROM clocked WHERE clock IS NULL OR due > clock GROUP BY zone, slot, "
    "due HAVING due <= (SELECT MAX(time) FROM arrived)", "weather", extra={"arrived": _ARRIVED, "clocked": _CLOCKED}))
def _(spark, d):
    rows = A.weather_hourly(spark, d).select("zone", "time", "precipitation")
    hour = F.floor(F.unix_seconds(F.col("time").cast("timestamp")) / 3600)
    part = F.floor((hour + F.pmod(hour * 7, F.lit(11)) + F.when(F.pmod(hour, F.lit(23)) == 0, 150).otherwise(0)) / 60)
    rows = rows.filter(F.col("time").isNotNull()).withColumn("_p", part)
    ends = rows.agg(F.min("_p").alias("a"), F.max("_p").alias("z")).first()
    first, last = ends["a"] or 0, ends["z"] or 0
    feed = in_order(spark, rows, (F.col("_p") - first).cast("int"), int(last - first) + 1)
    with G.rocksdb_state(spark):
        return G.run_to_table(G.slots_and_late_rows(feed.drop("_p")), "append")


@stream.add("X5_stream_stateful_lags", O.sql("SELECT " + ", ".join(LAGS) + " FROM h_framed", "h_framed"))
def _(spark, d):
    base = X.base(h_silver(spark, d)).select("zone", "time_6h", *G._SIGNALS)
    return G.run_to_table(G.stateful_lags(landed(spark, base)), "append")


@stream.add("X6_stream_static_join", O.sql(
    "SELECT w.zone, w.time_6h, w.precipitation, d.river_discharge, z.latitude FROM h_slots w LEFT JOIN h_daily d ON "
    "w.zone = d.zone AND CAST(w.time_6h AS DATE) = d.date_key + 1 LEFT JOIN zone_dim z ON z.zone = w.zone",
    "h_slots", "h_daily", "zone_dim"))
def _(spark, d):
    feed = landed(spark, R.resample(A.history_weather(spark, d)).select("zone", "time_6h", "precipitation"))
    joined = G.with_daily(feed, R.daily_discharge(A.history_discharge(spark, d)))
    zones = F.broadcast(A.zones(spark).select("zone", "latitude"))  # three rows
    return G.run_to_table(joined.join(zones, "zone", "left"), "append")


_SEASON = "extract(doy FROM time_6h) AS doy, extract(hour FROM time_6h) AS hour"


@stream.add("X6_stream_climatology", O.sql(
    "SELECT w.zone, w.time_6h, w.precipitation, p.usual AS usual_precipitation, round(w.precipitation - p.usual, 9) AS "
    "precipitation_departure FROM h_slots w LEFT JOIN prof p ON p.zone = w.zone AND p.doy = extract(doy FROM w.time_6h) AND "
    "p.hour = extract(hour FROM w.time_6h)", "h_slots",
    extra={"prof": f"SELECT zone, {_SEASON}, {O.mean('precipitation')} AS usual FROM h_slots WHERE extract(year FROM time_6h) < 1997 "
                   "GROUP BY 1, 2, 3"}))
def _(spark, d):
    slots = cut_lineage(R.resample(A.history_weather(spark, d)).select("zone", "time_6h", "precipitation"))
    usual = K.profile(slots.filter(F.year("time_6h") < 1997), ["precipitation"])
    x = G.run_to_table(G.with_climatology(landed(spark, slots), usual), "append")
    return x.withColumn("precipitation_departure", F.round("precipitation_departure", 9))


@stream.add("X7_stream_episodes", O.sql(EPISODES, "scored"))
def _(spark, d):
    flagged = A.scored(spark, d).filter(F.col("flood_pred") == 1).select("zone", "time_6h", "risk_score")
    return G.run_to_table(G.episodes_stream(landed(spark, flagged)), "complete")


@stream.add("X8_stream_scoring")
def _(spark, d):
    from tideline.operators import learning as L, splits as T
    from tideline.plans import training as W
    gold = X.gold(h_silver(spark, d))
    x, names, categories = W.prepare(gold)
    fit, _ = T.chronological_split(x)
    model = L.boosted().fit(L.weighted(fit))
    bundle = W.Bundle(L.FoldedModel([(model, L.isotonic(L.probability(model, fit)))]), names, categories, 0.4)
    out = shared_folder(spark, "alerts")
    G.score_stream(landed(spark, gold), bundle, out, shared_folder(spark, "progress")).awaitTermination()
    return spark.read.parquet(out)
