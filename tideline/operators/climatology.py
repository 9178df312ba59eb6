"""Seasonal profile, its fallback, and the horizon extension."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tideline import settings as S
from tideline.functions.sums import mean
from tideline.operators.resample import slot_start


def season_keys(time="time_6h") -> list[Column]:
    return [F.dayofyear(time).alias("doy"), F.hour(time).alias("hour")]


def profile(history: DataFrame, measures=None) -> DataFrame:
    """Mean of every measure per zone, day of year and slot hour."""
    measures = measures or S.MEASURES
    return history.groupBy("zone", *season_keys()).agg(*[mean(c).alias(c) for c in measures])


def zone_profile(prof: DataFrame, measures=None) -> DataFrame:
    """Unweighted mean of the profile rows of a zone."""
    measures = measures or S.MEASURES
    return prof.groupBy("zone").agg(*[mean(c).alias(c) for c in measures])


def time_grid(bounds: DataFrame, start: str, end: str, hours: int = S.SLOT_HOURS,
              out: str = "time_6h") -> DataFrame:
    """Slots from floor(start) to floor(end), both included, for every row of ``bounds``.

    Days are generated first and slots second, so a long range is spread over
    tasks instead of building one long array.
    """
    days = bounds.withColumn("_a", slot_start(start, hours)).withColumn("_z", slot_start(end, hours))
    days = days.filter(F.col("_a") <= F.col("_z")).withColumn(
        "_day", F.explode(F.sequence(F.to_date("_a"), F.to_date("_z"))))
    step = F.make_dt_interval(F.lit(0), F.lit(hours))
    first = F.col("_day").cast("timestamp_ntz")
    slots = F.sequence(first, first + F.make_dt_interval(F.lit(0), F.lit(24 - hours)), step)
    return (days.withColumn(out, F.explode(slots))
            .filter(F.col(out).between(F.col("_a"), F.col("_z"))).drop("_a", "_z", "_day"))


def lookup(grid: DataFrame, prof: DataFrame, measures=None) -> DataFrame:
    """Profile value for every (zone, slot); null where the profile has none."""
    measures = measures or S.MEASURES
    keyed = grid.select("zone", "time_6h", *season_keys())
    return (keyed.join(prof, ["zone", "doy", "hour"], "left")
            .select("zone", "time_6h", *measures))


def fill_from_zone(values: DataFrame, zone_means: DataFrame, measures=None) -> DataFrame:
    """Replace what the lookup left empty by the zone mean."""
    measures = measures or S.MEASURES
    fallback = zone_means.select("zone", *[F.col(c).alias(f"_z_{c}") for c in measures])
    return (values.join(fallback, "zone", "left")
            .select("zone", "time_6h",
                    *[F.coalesce(F.col(c), F.col(f"_z_{c}")).alias(c) for c in measures]))


def climate_slots(bounds: DataFrame, start: str, end: str, prof: DataFrame) -> DataFrame:
    """Profile-based slots for every zone row of ``bounds``, discharge 0."""
    grid = time_grid(bounds, start, end).select("zone", "time_6h")
    filled = fill_from_zone(lookup(grid, prof), zone_profile(prof))
    return filled.withColumn(S.DISCHARGE, F.lit(0.0))


def extension_bounds(live: DataFrame, zones: DataFrame, days: int = S.HORIZON_DAYS) -> DataFrame:
    """One row per zone with the gap to fill, or no row when there is none.

    The gap runs from one slot after the last live slot to ``days`` after the
    first; both ends come from the whole feed, not from one zone.
    """
    span = live.agg(
        (F.max("time_6h") + F.make_dt_interval(F.lit(0), F.lit(S.SLOT_HOURS))).alias("a"),
        (F.min("time_6h") + F.make_dt_interval(F.lit(days))).alias("z"))
    return (zones.select("zone", span.select("a").scalar().alias("gap_start"),
                         span.select("z").scalar().alias("gap_end"))
            .filter(F.col("gap_end") > F.col("gap_start")))


def extend_horizon(live: DataFrame, history: DataFrame, zones: DataFrame,
                   days: int = S.HORIZON_DAYS, tag_source: bool = False) -> DataFrame:
    """Live slots followed by profile slots up to ``days`` after the first live one."""
    tag = (lambda df, name: df.withColumn("source", F.lit(name))) if tag_source else (lambda df, _: df)
    if days <= S.LIVE_DAYS:
        return tag(live, "live")
    extra = climate_slots(extension_bounds(live, zones, days), "gap_start", "gap_end",
                          profile(history))
    return tag(live, "live").unionByName(tag(extra, "climatology"), allowMissingColumns=True)
