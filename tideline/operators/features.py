"""Engineered signals: lags, rolling sums, antecedent rain, cascade, cycles."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tideline import settings as S
from tideline.functions import columns as C
from tideline.functions.sums import mean_over, total_over, value
from tideline.operators.scale import halo_windows

LOOK_BACK = 11  # the 72 h sum reads eleven earlier slots


def base(slots: DataFrame, is_forecast: bool = False) -> DataFrame:
    """Label and quality score from the raw readings; discharge ends here."""
    label = F.lit(0) if is_forecast else C.flood_label()
    return slots.select(
        "zone", "time_6h",
        *[C.zero_if_null(c).alias(c) for c in S.MEASURES],
        label.alias(S.TARGET), C.dq_score().alias("dq_score"))


def _frames(w):
    rain, hum, et0 = "precipitation", "relative_humidity_2m", "et0_fao_evapotranspiration"

    def last(n):
        return w.rowsBetween(1 - n, 0)

    return [
        *[F.lag(rain, k).over(w).alias(f"precip_lag_{6 * k}h") for k in (1, 2, 4, 8)],
        F.lag("temperature_2m", 4).over(w).alias("temp_lag_24h"),
        *[total_over(rain, last(n)).alias(f"precip_roll_sum_{6 * n}h") for n in (4, 8, 12)],
        F.max(rain).over(last(4)).alias("precip_roll_max_24h"),
        F.max(hum).over(last(4)).alias("humidity_roll_max_24h"),
        total_over(et0, last(4)).alias("et0_roll_sum_24h"),
        F.lag("soil_moisture_0_to_7cm", 1).over(w).alias("_soil_before"),
    ]


def window_features(slots: DataFrame, **scale) -> DataFrame:
    """Lags and rolling values per zone; one window for all of them."""
    return halo_windows(slots, ["zone"], "time_6h", LOOK_BACK, _frames, **scale)


def derived(x: DataFrame) -> DataFrame:
    index = C.decay_index("precipitation", {1: "precip_lag_6h", 2: "precip_lag_12h",
                                            4: "precip_lag_24h"})
    soil = (F.col("soil_moisture_0_to_7cm") + F.col("soil_moisture_7_to_28cm")) / F.lit(2.0)
    return x.select(
        "*",
        index.alias("api_7d"),
        soil.alias("soil_saturation_index"),
        (F.col("soil_moisture_0_to_7cm") - F.col("_soil_before")).alias("soil_moisture_change_6h"),
        (F.lit(0.45) - soil).alias("soil_moisture_deficit"),
        F.when(F.col("soil_temperature_0_to_7cm") < 0, 1).otherwise(0).cast("int")
        .alias("frozen_ground_flag"),
        (F.col("temperature_2m") - F.col("temp_lag_24h")).alias("temp_trend_24h"),
        (F.col("precipitation") - F.col("et0_fao_evapotranspiration")).alias("et_deficit_6h"),
        (F.col("precip_roll_sum_24h") - F.col("et0_roll_sum_24h")).alias("et_deficit_24h"),
        (F.col("relative_humidity_2m") * F.col("precipitation")).alias("humidity_precip_product"),
    ).drop("_soil_before")


def with_upstream(x: DataFrame, source: str = S.SOURCE_ZONE,
                  carry: dict[str, str] | None = None) -> DataFrame:
    """Attach values of the source zone at the same time.

    The zone filter reaches the scan below the windows, so the second branch
    only reads the source zone. A zone without an upstream slot gets null.
    """
    carry = carry or {"precip_roll_sum_24h": "highland_precip_24h"}
    upstream = (x.filter(F.col("zone") == source)
                .select(F.col("time_6h").alias("_t"), *[F.col(a).alias(b) for a, b in carry.items()]))
    return x.join(upstream, F.col("time_6h") == F.col("_t"), "left").drop("_t")


def cascade_risk(source: str = S.SOURCE_ZONE, shares=None):
    load = F.when(F.col("zone") == source, F.col("precip_roll_sum_24h")).otherwise(
        C.zero_if_null("highland_precip_24h"))
    return load * C.cascade_share(shares=shares)


def gold(slots: DataFrame, is_forecast: bool = False, source: str = S.SOURCE_ZONE,
         shares=None, **scale) -> DataFrame:
    """All engineered signals plus quality score and label, in a fixed order."""
    x = derived(window_features(base(slots, is_forecast), **scale))
    x = with_upstream(x, source)
    x = x.withColumn("zone_cascade_risk", cascade_risk(source, shares))
    for name, col in C.cyclic("time_6h").items():
        x = x.withColumn(name, col)
    flags = ["frozen_ground_flag", "is_winter"]
    plain = [c for c in S.GOLD_FEATURES if c not in flags]
    return (x.select("zone", "time_6h", *S.GOLD_FEATURES, "dq_score", S.TARGET)
            .na.fill(0.0, plain).na.fill(0, flags))


# ---- the earlier feature set, which keeps discharge ---------------------------
def legacy_features(slots: DataFrame, warm_up: bool = True, **scale) -> DataFrame:
    """Same-day label variant: discharge lags are features and nulls stay null."""
    def frames(w):
        return _frames(w) + [
            F.lag(S.DISCHARGE, 1).over(w).alias("discharge_lag_6h"),
            F.lag(S.DISCHARGE, 4).over(w).alias("discharge_lag_24h"),
            F.max(S.DISCHARGE).over(w.rowsBetween(-3, 0)).alias("discharge_roll_max_24h"),
        ]

    x = derived(halo_windows(slots, ["zone"], "time_6h", LOOK_BACK, frames, **scale))
    x = x.withColumn("discharge_trend_6h", F.col(S.DISCHARGE) - F.col("discharge_lag_6h"))
    x = with_upstream(x, carry={"precip_roll_sum_24h": "highland_precip_24h",
                                S.DISCHARGE: "highland_discharge_6h"})
    load = F.when(F.col("zone") == S.SOURCE_ZONE, F.col("precip_roll_sum_24h")).otherwise(
        F.col("highland_precip_24h"))
    x = x.withColumn("zone_cascade_risk", load * C.cascade_share())
    for name, col in C.cyclic("time_6h").items():
        x = x.withColumn(name, col)
    wet = (F.col("precipitation") > S.RAIN_LIMIT) | (F.col("relative_humidity_2m") > S.HUMIDITY_LIMIT)
    x = x.withColumn(S.TARGET, F.when((F.col(S.DISCHARGE) > S.DISCHARGE_LIMIT) & wet, 1)
                     .otherwise(0).cast("int"))
    return x.filter(F.col("precip_lag_48h").isNotNull()) if warm_up else x


def rolling_mean(df: DataFrame, col: str, n: int, key: str = "zone", order: str = "time_6h",
                 out: str | None = None, **scale) -> DataFrame:
    """Mean of the last ``n`` rows, null until ``n`` values are there; NaN is no value."""
    out = out or f"{col}_mean_{n}"

    def frames(w):
        frame = w.rowsBetween(1 - n, 0)
        return [F.when(F.count(value(col)).over(frame) == n, mean_over(col, frame)).alias(out)]

    return halo_windows(df, [key], order, n - 1, frames, **scale)
