"""The given tables in the shapes the operators work on.

``events`` gives 30 days of hourly readings with missing values; ``lineitem``
gives a multi-year history for climatology, splits, scores and learning.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline import settings as S
from tideline.functions.sums import mean
from tideline.functions.columns import flood_pred


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def _event_zone():
    return (F.when(F.col("user_id") % 3 == 0, "High Relief")
            .when(F.col("user_id") % 3 == 1, "Moderate Relief").otherwise("Low Relief"))


def _item_zone():
    return (F.when(F.col("l_returnflag") == "A", "High Relief")
            .when(F.col("l_returnflag") == "N", "Moderate Relief").otherwise("Low Relief"))


def readings_from_events(events: DataFrame) -> DataFrame:
    """Hourly readings; also works on a stream of events."""
    kind, value = F.col("event_type"), F.col("value")
    return events.select(
        _event_zone().alias("zone"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time"),
        F.when(kind == "view", value / 2 - 10).alias("temperature_2m"),
        F.when(kind.isin("click", "view"), F.least(55 + value / 2, F.lit(100.0)))
        .alias("relative_humidity_2m"),
        F.when(kind == "purchase", value / 20).otherwise(F.lit(0.0)).alias("precipitation"),
        F.when(kind == "error", value).alias("wind_speed_10m"),
        ((F.col("event_id") % 45).cast("double") / 100).alias("soil_moisture_0_to_7cm"),
        ((F.col("event_id") % 37).cast("double") / 100).alias("soil_moisture_7_to_28cm"),
        ((F.col("event_id") % 40).cast("double") - 10).alias("soil_temperature_0_to_7cm"),
        ((F.col("user_id") % 7).cast("double") / 100).alias("et0_fao_evapotranspiration"),
    )


def weather_hourly(spark, folder) -> DataFrame:
    return readings_from_events(table(spark, folder, "events"))


def discharge_daily(spark, folder) -> DataFrame:
    return (table(spark, folder, "events").filter(F.col("event_type") == "error")
            .groupBy(_event_zone().alias("zone"), F.to_date("ts").cast("timestamp_ntz").alias("time"))
            .agg((mean("value") / 50).alias(S.DISCHARGE)))


def _item_time():
    hours = (F.col("l_linenumber") % 4) * 6
    return F.col("l_shipdate") + F.make_dt_interval(F.lit(0), hours)


def history_weather(spark, folder) -> DataFrame:
    """Multi-year readings; wind is missing on a third of the rows."""
    return table(spark, folder, "lineitem").select(
        _item_zone().alias("zone"),
        _item_time().alias("time"),
        (F.col("l_quantity") - 15).alias("temperature_2m"),
        (50 + F.col("l_discount") * 500).alias("relative_humidity_2m"),
        F.when(F.col("l_suppkey") % 5 < 2, F.col("l_tax") * 25).otherwise(F.lit(0.0))
        .alias("precipitation"),
        F.when(F.col("l_partkey") % 3 != 0, F.col("l_extendedprice") / 1000).alias("wind_speed_10m"),
        ((F.col("l_partkey") % 45).cast("double") / 100).alias("soil_moisture_0_to_7cm"),
        ((F.col("l_suppkey") % 37).cast("double") / 100).alias("soil_moisture_7_to_28cm"),
        (F.col("l_quantity") - 20).alias("soil_temperature_0_to_7cm"),
        (F.col("l_discount") * 2).alias("et0_fao_evapotranspiration"),
    )


def history_discharge(spark, folder) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        _item_zone().alias("zone"), F.col("l_shipdate").alias("time"),
        (F.col("l_extendedprice") / 90000).alias(S.DISCHARGE))


def scored(spark, folder, threshold: float = S.RISK_HIGH) -> DataFrame:
    """A deterministic multi-year score table: zone, slot, score, label, rain, flag.

    The score is the mean price in units of 100,000, to four digits, from whole
    cents, so that every engine gives the same double.
    """
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    tenths = F.sum(cents).cast("double") / (F.count(F.lit(1)) * F.lit(1000.0))
    return (
        table(spark, folder, "lineitem")
        .groupBy(_item_zone().alias("zone"), _item_time().alias("time_6h"))
        .agg((F.floor(tenths + 0.5) / F.lit(10000.0)).alias("risk_score"),
             F.max(F.when(F.col("l_quantity") >= 49, 1).otherwise(0)).cast("int").alias(S.TARGET),
             (F.sum(F.floor(F.col("l_discount") * 100 + 0.5)).cast("double")).alias("precipitation"))
        .withColumn("flood_pred", flood_pred("risk_score", threshold))
    )


def predictions(spark, folder) -> DataFrame:
    """Stored predictions: the scored slots with the measures reports show."""
    base = scored(spark, folder)
    readings = (history_weather(spark, folder).groupBy("zone", F.col("time").alias("time_6h"))
                .agg(*[mean(c).alias(c) for c in (
                    "temperature_2m", "relative_humidity_2m", "wind_speed_10m",
                    "soil_moisture_0_to_7cm", "soil_moisture_7_to_28cm",
                    "et0_fao_evapotranspiration")]))
    from tideline.functions.columns import risk_level_cut
    return (base.join(readings, ["zone", "time_6h"])
            .withColumn("risk_level", risk_level_cut("risk_score"))
            .select(*S.PREDICTION_COLUMNS))


def zones(spark) -> DataFrame:
    return spark.createDataFrame(S.ZONES, "zone string, latitude double, longitude double")


def zone_meta(spark) -> DataFrame:
    return spark.createDataFrame(
        S.ZONE_META, "zone string, zone_id string, elevation_mean double, slope_mean double, "
                     "impervious_ratio double, watershed_area double")


def districts(spark) -> DataFrame:
    return spark.createDataFrame(S.DISTRICTS, "name string, zone string")
