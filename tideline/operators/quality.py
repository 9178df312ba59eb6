"""Audits, null rates, gaps, gates and profiles."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tideline import settings as S
from tideline.functions import columns as C
from tideline.functions.sums import mean
from tideline.operators.climatology import time_grid


def audit(df: DataFrame, name: str, step_hours: int = 24, time: str = "time",
          by: list[str] = ()) -> DataFrame:
    """Rows, range, missing grid points and non-zero null counts, per ``by``.

    The expected grid starts at the first time and ends at the last; a grid
    point is present when some row has exactly that time. Distinct times per
    key are counted on a grouped frame, so no time list is built.
    """
    others = [c for c in df.columns if c not in by]
    facts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.min(time).alias("start"), F.max(time).alias("end"),
        *[F.sum(F.col(c).isNull().cast("bigint")).alias(f"_n_{c}") for c in others])
    first = df.groupBy(*by).agg(F.min(time).alias("_first"))
    step = F.lit(step_hours * 3600)
    stamps = df.select(*by, F.col(time).alias("_t")).distinct()
    if by:
        stamps = stamps.join(first, list(by))
    else:
        stamps = stamps.withColumn("_first", first.scalar())
    away = C.local_seconds("_t") - C.local_seconds("_first")
    whole = F.col("_t") == F.date_trunc("second", "_t").cast("timestamp_ntz")
    on_grid = stamps.groupBy(*by).agg(
        F.sum(F.when((F.pmod(away, step) == 0) & whole, 1).otherwise(0)).cast("bigint").alias("_seen"))
    x = facts.join(on_grid, list(by)) if by else facts.withColumn("_seen", on_grid.scalar())
    expected = F.floor((C.local_seconds("end") - C.local_seconds("start")) / step) + 1
    nulls = F.map_filter(F.create_map(*[p for c in others for p in (F.lit(c), F.col(f"_n_{c}"))]),
                         lambda _, v: v > 0)
    return x.select(F.lit(name).alias("dataset"), *by, "rows", "start", "end",
                    (expected - F.col("_seen")).cast("bigint").alias("gaps"), nulls.alias("nulls"))


def missing_slots(df: DataFrame, time: str = "time_6h", hours: int = S.SLOT_HOURS) -> DataFrame:
    """Grid slots between first and last slot of a zone that have no row."""
    span = df.groupBy("zone").agg(F.min(time).alias("_s"), F.max(time).alias("_e"))
    return time_grid(span, "_s", "_e", hours, time).select("zone", time).join(
        df.select("zone", time), ["zone", time], "left_anti")


def null_rates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: null count and share, from one pass."""
    columns = columns or df.columns
    once = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in columns])
    long = once.unpivot(["_n"], columns, "column", "missing")
    return long.select("column", "missing", (F.col("missing") / F.col("_n")).alias("rate"))


def quality_gate(df: DataFrame, columns=None, max_pct: float = S.MAX_MISSING_PCT,
                 strict: bool = False) -> DataFrame:
    """Columns whose missing share, in percent to two digits, is above the limit."""
    failed = (null_rates(df, columns)
              .select("column", "missing", C.half_up(F.col("rate") * 100, 2).alias("missing_pct"))
              .filter(F.col("missing_pct") > max_pct))
    if strict:
        names = [r["column"] for r in failed.select("column").collect()]
        if names:
            raise ValueError(f"columns above {max_pct}% missing: {names}")
    return failed


def dq_summary(df: DataFrame) -> DataFrame:
    """Mean quality score and the number of rows below 1, per zone."""
    return df.groupBy("zone").agg(
        mean("dq_score").alias("mean_dq"), F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("dq_score") < 1).alias("rows_below_one"))


def table_profile(df: DataFrame, time: str = "time_6h") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min(time).alias("first_time"),
                  F.max(time).alias("last_time"), F.count_distinct("zone").alias("zones"),
                  (F.sum(S.TARGET) / F.count(F.lit(1))).alias("positive_rate"))
