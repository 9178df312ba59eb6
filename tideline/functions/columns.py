"""Column builders: labels, levels, scores, encodings, texts."""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, functions as F

from tideline import settings as S


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def zero_if_null(col) -> Column:
    return F.coalesce(_c(col), F.lit(0.0))


def flood_label(discharge=S.DISCHARGE, rain="precipitation", humidity="relative_humidity_2m",
                discharge_limit=S.DISCHARGE_LIMIT, rain_limit=S.RAIN_LIMIT,
                humidity_limit=S.HUMIDITY_LIMIT) -> Column:
    wet = (zero_if_null(rain) > rain_limit) | (zero_if_null(humidity) > humidity_limit)
    return F.when((zero_if_null(discharge) > discharge_limit) & wet, 1).otherwise(0).cast("int")


def exceeds(col, limit=S.DISCHARGE_LIMIT) -> Column:
    """1 where the value is above the limit; a missing value is not."""
    return F.when(_c(col) > limit, 1).otherwise(0).cast("int")


def violations(bounds=None) -> Column:
    """Number of sensors outside their range; a missing reading counts."""
    bounds = bounds or S.SENSOR_BOUNDS
    flags = [F.when(F.col(c).between(lo, hi), 0).otherwise(1) for c, (lo, hi) in bounds.items()]
    return reduce(lambda a, b: a + b, flags)


def dq_score(bounds=None) -> Column:
    bounds = bounds or S.SENSOR_BOUNDS
    return F.lit(1.0) - violations(bounds) / F.lit(float(len(bounds)))


def decay_index(now, lags: dict, decay=S.DECAY, powers=None) -> Column:
    """now + sum over lags of decay**power * lag, missing lags counting as 0.

    ``lags`` maps slots back to a column. The weights are taken from an exact
    decimal power, so 0.85 squared is 0.7225.
    """
    powers = powers or S.DECAY_POWERS
    out = _c(now)
    for back, col in lags.items():
        out = out + F.lit(float(decay ** powers[back])) * zero_if_null(col)
    return out


def risk_level_cut(score, medium=S.RISK_MEDIUM, high=S.RISK_HIGH) -> Column:
    """Right-closed bins: 0.30 is LOW, 0.60 is MEDIUM; outside (-0.001, 1.001] is null."""
    s = _c(score)
    return (F.when((s > -0.001) & (s <= medium), "LOW")
            .when((s > medium) & (s <= high), "MEDIUM")
            .when((s > high) & (s <= 1.001), "HIGH"))


def risk_level_ge(score, medium=S.RISK_MEDIUM, high=S.RISK_HIGH) -> Column:
    """Left-closed bins: 0.30 is MEDIUM, 0.60 is HIGH."""
    s = _c(score)
    return F.when(s >= high, "HIGH").when(s >= medium, "MEDIUM").otherwise("LOW")


def flood_pred(score, threshold) -> Column:
    return F.when(_c(score) >= threshold, 1).otherwise(0).cast("int")


def severity(level) -> Column:
    return F.when(_c(level) == "HIGH", 0).when(_c(level) == "MEDIUM", 1).otherwise(2)


def zone_slug(zone) -> Column:
    return F.regexp_replace(F.lower(_c(zone)), " ", "_")


def cyclic(time="time_6h") -> dict[str, Column]:
    """Hour and day-of-year on the circle; the year always counts 365 days."""
    turn = F.lit(2 * math.pi)
    hour = turn * F.hour(time) / F.lit(24)
    day = turn * F.dayofyear(time) / F.lit(365)
    return {
        "hour_sin": F.sin(hour), "hour_cos": F.cos(hour),
        "doy_sin": F.sin(day), "doy_cos": F.cos(day),
        "is_winter": F.when(F.month(time).isin(11, 12, 1, 2), 1).otherwise(0).cast("int"),
    }


def cascade_share(zone="zone", shares=None, default=S.CASCADE_DEFAULT) -> Column:
    shares = shares or S.CASCADE_SHARE
    out = F
    for name, share in shares.items():
        out = out.when(_c(zone) == name, F.lit(share))
    return out.otherwise(F.lit(default))


def half_up(col, digits: int) -> Column:
    """Round half up on the double itself (the same in any SQL engine)."""
    scale = float(10 ** digits)
    return F.floor(_c(col) * scale + 0.5) / F.lit(scale)


def alert_message(zone="zone", level="risk_level", score="max_risk_score", hours="hours") -> Column:
    pct = half_up(_c(score) * 100, 1).cast("string")
    return (
        F.when(_c(level) == "HIGH",
               F.concat(F.lit("🚨 CRITICAL: "), _c(zone), F.lit(" shows "), pct,
                        F.lit("% flood probability. "), _c(hours).cast("string"),
                        F.lit("h total exposure predicted.")))
        .when(_c(level) == "MEDIUM",
              F.concat(F.lit("⚠️ WARNING: "), _c(zone), F.lit(" shows "), pct,
                       F.lit("% flood probability. Monitor levels.")))
        .otherwise(F.concat(F.lit("✅ Normal: "), _c(zone), F.lit(" risk is low ("), pct, F.lit("%).")))
    )


def soil_band(col) -> tuple[Column, Column]:
    """Whole percent and its band: above 70 red, above 45 amber, both strict."""
    pct = F.floor(_c(col) * 100 + 0.5).cast("int")
    return pct, F.when(pct > 70, "RED").when(pct > 45, "AMBER").otherwise("GREEN")


def horizon_label(slot) -> Column:
    s = _c(slot)
    return (F.when(s == 0, "NOW")
            .when(s < 60, F.concat(F.lit("+"), (s * 6).cast("string"), F.lit("h")))
            .otherwise(F.concat(F.lit("DAY "), (F.floor(s / 4) + 1).cast("string"))))


def neg_log10(p) -> Column:
    return -F.log10(_c(p) + F.lit(1e-300))


EPOCH = "1970-01-01 00:00:00"


def local_seconds(time) -> Column:
    """Seconds of a local time stamp since 1970, whatever the session time zone."""
    t = _c(time)
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.floor(F.extract(F.lit("SECOND"), t))


def as_event_time(time) -> Column:
    """A local time stamp as an instant (read as UTC); watermarks need that type."""
    return F.timestamp_seconds(local_seconds(time))


def from_event_time(col) -> Column:
    """Back to a local time stamp."""
    secs = F.unix_seconds(_c(col))
    return F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(
        F.floor(secs / 86400).cast("int"), F.lit(0), F.lit(0), F.pmod(secs, F.lit(86400)).cast("decimal(18,6)"))


def iso_time(col) -> Column:
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
