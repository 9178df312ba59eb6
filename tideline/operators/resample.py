"""Hourly readings to the six-hour grid, daily discharge, label joins."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tideline import settings as S
from tideline.functions.sums import mean, total


def slot_start(time, hours: int = S.SLOT_HOURS) -> Column:
    """Floor a timestamp to the slot grid."""
    return F.window(time, f"{hours} hours")["start"]


def resample(hourly: DataFrame, hours: int = S.SLOT_HOURS, measures=None,
             time: str = "time", out: str = "time_6h") -> DataFrame:
    """Mean of state variables and sum of flux variables per zone and slot.

    Partial aggregation runs before the shuffle, so a slot with very many
    readings arrives as one row per task.
    """
    measures = measures or S.MEASURES
    return (hourly.groupBy("zone", F.window(time, f"{hours} hours").alias("_w"))
            .agg(*[(total if c in S.FLUX_MEASURES else mean)(c).alias(c) for c in measures])
            .select("zone", F.col("_w.start").alias(out), *measures))


def daily_discharge(daily: DataFrame) -> DataFrame:
    return (daily.groupBy("zone", F.to_date("time").alias("date_key"))
            .agg(F.max(S.DISCHARGE).alias(S.DISCHARGE)))


def join_discharge(slots: DataFrame, daily: DataFrame, lag_days: int = 1) -> DataFrame:
    """Left join of the discharge seen ``lag_days`` earlier (0 = the same day).

    No broadcast hint: the daily side grows with zones and days, so AQE decides
    from its real size and splits skewed partitions of the slot side.
    """
    shifted = daily.select("zone", F.date_add("date_key", lag_days).alias("_day"), S.DISCHARGE)
    return (slots.withColumn("_day", F.to_date("time_6h"))
            .join(shifted, ["zone", "_day"], "left").drop("_day"))


def silver(hourly: DataFrame, daily: DataFrame, lag_days: int = 1) -> DataFrame:
    """Six-hour history with the lagged discharge; missing values become 0."""
    joined = join_discharge(resample(hourly), daily_discharge(daily), lag_days)
    return (joined.na.fill(0.0, S.MEASURES + [S.DISCHARGE])
            .select("zone", "time_6h", *S.MEASURES, S.DISCHARGE))


def forecast_slots(hourly: DataFrame) -> DataFrame:
    """Six-hour forecast; missing values stay null and discharge is 0."""
    return resample(hourly).withColumn(S.DISCHARGE, F.lit(0.0))
