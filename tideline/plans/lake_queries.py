"""Stored tables: sinks, replacement, probes, guards, purge and the slot cache."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tideline.operators import resample as R
from tideline.plans import oracle as O
from tideline.plans.registry import Registry
from tideline.session import cut_lineage, shared_folder
from tideline.sources import adapters as A, feeds
from tideline.sources.lake import Lake, require_column, require_rows
from tideline.streaming.streams import SlotCache

stored = Registry()
CSV_SCHEMA = "time_6h timestamp_ntz, temperature_2m double, precipitation double, zone string"
_TIMES = {"newest": "SELECT MAX(time) AS t FROM weather"}


def slots(spark, d):
    return R.resample(A.weather_hourly(spark, d))


def counted(spark, lake, step, probes):
    """A row for each probed table: is it stored, and how many rows has it."""
    rows = []
    for layer, name in probes:
        there = lake.exists(layer, name)
        rows.append((step, layer, name, name in lake.tables(layer), lake.read(layer, name).count() if there else None))
    return spark.createDataFrame(rows, "step string, layer string, table_name string, is_stored boolean, n long")


@stored.add("S6_csv_per_zone", O.sql("SELECT zone, time_6h, temperature_2m, precipitation FROM slots", "slots"))
def _(spark, d):
    path = shared_folder(spark, "csv")
    feeds.write_csv(slots(spark, d).select("zone", "time_6h", "temperature_2m", "precipitation"), path, ["zone"])
    return feeds.read_csv(spark, path, CSV_SCHEMA).select("zone", "time_6h", "temperature_2m", "precipitation")


@stored.add("S8_replace_table", O.sql("SELECT zone, time_6h, precipitation + 1e0 AS precipitation FROM slots", "slots"))
def _(spark, d):
    lake = Lake(spark, shared_folder(spark, "lake"))
    first = lake.replace(slots(spark, d).select("zone", "time_6h", "precipitation"), "silver", "slots", ["zone"])
    # a table is replaced by rows read from itself
    return lake.replace(first.withColumn("precipitation", F.col("precipitation") + 1), "silver", "slots", ["zone"]).select(
        "zone", "time_6h", "precipitation")


_PROBE = "SELECT '{0}' AS step, '{1}' AS layer, '{2}' AS table_name, {3} AS is_stored, {4} AS n"
_WEATHER, _SLOTS = "(SELECT COUNT(*) FROM weather)", "(SELECT COUNT(*) FROM slots)"


def _probes(*rows):
    return O.sql(" UNION ALL ".join(_PROBE.format(*r) for r in rows), "weather", "slots")


def _filled(spark, d):
    lake = Lake(spark, shared_folder(spark, "lake"))
    lake.replace(A.weather_hourly(spark, d), "bronze", "weather_raw", ["zone"])
    lake.replace(R.resample(lake.read("bronze", "weather_raw")), "silver", "weather_6h", ["zone"])
    return lake


@stored.add("S10_catalog_probes", _probes(
    ("filled", "bronze", "weather_raw", "true", _WEATHER), ("filled", "silver", "weather_6h", "true", _SLOTS),
    ("filled", "gold", "flood_features", "false", "NULL")))
def _(spark, d):
    return counted(spark, _filled(spark, d), "filled",
                   [("bronze", "weather_raw"), ("silver", "weather_6h"), ("gold", "flood_features")])


@stored.add("S15_purge_bronze", _probes(
    ("not asked", "bronze", "weather_raw", "true", _WEATHER), ("asked", "bronze", "weather_raw", "false", "NULL"),
    ("asked", "silver", "weather_6h", "true", _SLOTS)))
def _(spark, d):
    lake = _filled(spark, d)
    lake.purge("bronze")
    before = counted(spark, lake, "not asked", [("bronze", "weather_raw")])
    lake.purge("bronze", enabled=True)
    return before.unionByName(counted(spark, lake, "asked", [("bronze", "weather_raw"), ("silver", "weather_6h")]))


@stored.add("Q5_guards", O.sql(
    "SELECT zone, COUNT(*) > 0 AS has_rows, COUNT(*) FILTER (precipitation > 1) > 0 AS has_rain, true AS has_column, false AS "
    "has_label, COUNT(*) AS n FROM slots GROUP BY 1", "slots"))
def _(spark, d):
    kept = cut_lineage(slots(spark, d))
    zones = A.zones(spark).select("zone").collect()      # three rows

    def passes(guard, *args):
        try:
            guard(*args)
            return True
        except ValueError:
            return False

    rows = [(z["zone"], passes(require_rows, of, z["zone"]), passes(require_rows, of.filter("precipitation > 1"), z["zone"]),
             passes(require_column, of, "precipitation"), passes(require_column, of, "is_flood"))
            for z in zones for of in [kept.filter(F.col("zone") == z["zone"])]]
    guards = spark.createDataFrame(rows, "zone string, has_rows boolean, has_rain boolean, has_column boolean, has_label boolean")
    return kept.groupBy("zone").agg(F.count(F.lit(1)).alias("n")).join(guards, "zone")


@stored.add("X9_slot_cache", O.sql(
    "SELECT zone, time_6h, precipitation, 2::BIGINT AS builds FROM slots WHERE time_6h = (SELECT time_bucket(INTERVAL '6 hours', t) "
    "FROM newest)", "weather", "slots", extra=_TIMES))
def _(spark, d):
    cache, builds = SlotCache(Lake(spark, shared_folder(spark, "lake"))), []
    x = slots(spark, d).select("zone", "time_6h", "precipitation")
    newest = x.agg(F.max("time_6h").alias("t")).first()["t"]

    def at(now):
        def build():
            builds.append(now)
            return x.filter(F.col("time_6h") == now.replace(hour=now.hour // 6 * 6, minute=0))
        return cache.get(now, build)

    if newest is None:
        return x.withColumn("builds", F.lit(0).cast("long"))
    at(newest - dt.timedelta(hours=6))
    at(newest)
    again = at(newest + dt.timedelta(hours=5, minutes=59))     # the same slot: not built again
    return again.withColumn("builds", F.lit(len(builds)).cast("long"))
