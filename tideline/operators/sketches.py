"""Mergeable summaries of a measure per zone and day: quantiles and distinct counts of any range of days.

The data is read once; a percentile of a month or a year then merges small sketches instead of sorting values again.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

KLL_K = 400           # a quantile's rank errs by at most RANK_ERROR, with 99 % confidence
RANK_ERROR = 0.0075
HLL_BITS = 14         # distinct counts err by 0.8 % (one standard error)


def daily_sketches(df: DataFrame, value: str, time: str = "time", keys: list[str] = ("zone",)) -> DataFrame:
    """A row per key and day: rows with a value, quantile sketch, distinct sketch.

    Null and not-a-number values and rows without a time are left out; a day without any value has no row.
    """
    v = F.col(value).cast("double")
    x = df.select(*keys, F.to_date(time).alias("day"), v.alias("_v")).filter(
        F.col("day").isNotNull() & F.col("_v").isNotNull() & ~F.isnan("_v"))
    return x.groupBy(*keys, "day").agg(F.count("_v").alias("n"), F.kll_sketch_agg_double("_v", KLL_K).alias("quantiles"),
                                       F.hll_sketch_agg(F.col("_v").cast("string"), HLL_BITS).alias("distinct"))


def merged(sketches: DataFrame, first=None, last=None, keys: list[str] = ("zone",)) -> DataFrame:
    """One sketch row per key for the days from ``first`` to ``last``, both included; None leaves an end open."""
    x = sketches
    if first is not None:
        x = x.filter(F.col("day") >= F.lit(first))
    if last is not None:
        x = x.filter(F.col("day") <= F.lit(last))
    return x.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
                                F.hll_union_agg("distinct").alias("distinct"))


def estimates(rows: DataFrame, points: dict[str, float]) -> DataFrame:
    """The sketch columns replaced by approximate quantiles and ``distinct_values``; a quantile is one of the values."""
    kept = [c for c in rows.columns if c not in ("quantiles", "distinct")]
    return rows.select(*kept, *[F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p))).alias(name)
                                for name, p in points.items()],
                       F.hll_sketch_estimate("distinct").alias("distinct_values"))
