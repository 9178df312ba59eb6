"""Building blocks for the check SQL: named views composed into one statement."""
from __future__ import annotations

from tideline import settings as S

ZONE_EVENT = ("CASE user_id % 3 WHEN 0 THEN 'High Relief' WHEN 1 THEN 'Moderate Relief' "
              "ELSE 'Low Relief' END")
ZONE_ITEM = ("CASE l_returnflag WHEN 'A' THEN 'High Relief' WHEN 'N' THEN 'Moderate Relief' "
             "ELSE 'Low Relief' END")
ITEM_TIME = "l_shipdate + (l_linenumber % 4) * INTERVAL '6 hours'"


# the term beside the value keeps halves from being decided by the order of a sum
def total(x, over=""):
    return f"round(SUM(CAST({x} AS DOUBLE)){over} + 1.37e-11, 9)"


def mean(x, over=""):
    return f"round(AVG(CAST({x} AS DOUBLE)){over} + 1.37e-11, 9)"


def cols(names, fmt="{0}"):
    return ", ".join(fmt.format(n) for n in names)


def _resample(view):
    parts = [f"{total(c) if c in S.FLUX_MEASURES else mean(c)} AS {c}" for c in S.MEASURES]
    return (f"SELECT zone, time_bucket(INTERVAL '6 hours', time) AS time_6h, {', '.join(parts)} "
            f"FROM {view} GROUP BY 1, 2")


def _silver(slots, daily, lag=1):
    filled = cols(S.MEASURES, "coalesce(w.{0}, 0e0) AS {0}")
    return (f"SELECT w.zone, w.time_6h, {filled}, coalesce(d.river_discharge, 0e0) AS river_discharge "
            f"FROM {slots} w LEFT JOIN {daily} d ON d.zone = w.zone "
            f"AND d.date_key + {lag} = CAST(w.time_6h AS DATE)")


def _daily(view):
    return (f"SELECT zone, CAST(time AS DATE) AS date_key, MAX(river_discharge) AS river_discharge "
            f"FROM {view} GROUP BY 1, 2")


def label(q="river_discharge", p="precipitation", h="relative_humidity_2m"):
    return (f"CASE WHEN coalesce({q}, 0) > 1 AND (coalesce({p}, 0) > 1 OR coalesce({h}, 0) > 85) "
            f"THEN 1 ELSE 0 END")


def violations():
    return " + ".join(f"CASE WHEN {c} BETWEEN {lo} AND {hi} THEN 0 ELSE 1 END"
                      for c, (lo, hi) in S.SENSOR_BOUNDS.items())


def dq():
    return f"1e0 - ({violations()}) / 6e0"


def _base(view, is_forecast=False):
    return (f"SELECT zone, time_6h, {cols(S.MEASURES, 'coalesce({0}, 0e0) AS {0}')}, "
            f"{'0' if is_forecast else label()} AS is_flood, {dq()} AS dq_score "
            f"FROM (SELECT zone, time_6h, {cols(S.MEASURES, '{0}')}, river_discharge FROM {view}) q")


def dq_of(view):
    """The quality score must see the stored column, not a filled alias."""
    return f"SELECT zone, time_6h, {dq()} AS dq_score FROM {view}"


def frames(extra=""):
    f = [f"LAG(precipitation, {k}) OVER s AS precip_lag_{6 * k}h" for k in (1, 2, 4, 8)]
    f.append("LAG(temperature_2m, 4) OVER s AS temp_lag_24h")
    for n in (4, 8, 12):
        over = f" OVER (s ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        f.append(f"{total('precipitation', over)} AS precip_roll_sum_{6 * n}h")
    day = " OVER (s ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"
    f.append(f"MAX(precipitation){day} AS precip_roll_max_24h")
    f.append(f"MAX(relative_humidity_2m){day} AS humidity_roll_max_24h")
    f.append(f"{total('et0_fao_evapotranspiration', day)} AS et0_roll_sum_24h")
    f.append("LAG(soil_moisture_0_to_7cm, 1) OVER s AS soil_before")
    return ", ".join(f) + extra


def _framed(view, extra=""):
    return f"SELECT *, {frames(extra)} FROM {view} WINDOW s AS (PARTITION BY zone ORDER BY time_6h)"


def derive_list():
    index = "precipitation + 0.85e0 * coalesce(precip_lag_6h, 0) + 0.7225e0 * coalesce(precip_lag_12h, 0)" \
            " + 0.52200625e0 * coalesce(precip_lag_24h, 0)"
    soil = "(soil_moisture_0_to_7cm + soil_moisture_7_to_28cm) / 2e0"
    return (f"{index} AS api_7d, {soil} AS soil_saturation_index, "
            "soil_moisture_0_to_7cm - soil_before AS soil_moisture_change_6h, "
            f"0.45e0 - {soil} AS soil_moisture_deficit, "
            "CASE WHEN soil_temperature_0_to_7cm < 0 THEN 1 ELSE 0 END AS frozen_ground_flag, "
            "temperature_2m - temp_lag_24h AS temp_trend_24h, "
            "precipitation - et0_fao_evapotranspiration AS et_deficit_6h, "
            "precip_roll_sum_24h - et0_roll_sum_24h AS et_deficit_24h, "
            "relative_humidity_2m * precipitation AS humidity_precip_product")


def _derived(view):
    return f"SELECT * EXCLUDE (soil_before), {derive_list()} FROM {view}"


def cycle_list(t="time_6h"):
    turn = "2 * pi()"
    return (f"round(sin({turn} * extract(hour FROM {t}) / 24), 9) AS hour_sin, "
            f"round(cos({turn} * extract(hour FROM {t}) / 24), 9) AS hour_cos, "
            f"round(sin({turn} * extract(doy FROM {t}) / 365), 9) AS doy_sin, "
            f"round(cos({turn} * extract(doy FROM {t}) / 365), 9) AS doy_cos, "
            f"CASE WHEN extract(month FROM {t}) IN (1, 2, 11, 12) THEN 1 ELSE 0 END AS is_winter")


CASCADE = ("CASE x.zone WHEN 'High Relief' THEN x.precip_roll_sum_24h * (1e0 / 3e0) "
           "WHEN 'Moderate Relief' THEN coalesce(up.rain, 0) * (1e0 / 1.5e0) "
           "ELSE coalesce(up.rain, 0) * 1e0 END")


def _gold(derived):
    made = [c for c in S.GOLD_FEATURES
            if c not in ("highland_precip_24h", "zone_cascade_risk", "hour_sin", "hour_cos",
                         "doy_sin", "doy_cos", "is_winter")]
    return (f"SELECT x.zone, x.time_6h, {cols(made, 'coalesce(x.{0}, 0) AS {0}')}, "
            f"coalesce(up.rain, 0e0) AS highland_precip_24h, {CASCADE} AS zone_cascade_risk, "
            f"{cycle_list('x.time_6h')}, x.dq_score, x.is_flood FROM {derived} x "
            f"LEFT JOIN (SELECT time_6h AS t, precip_roll_sum_24h AS rain FROM {derived} "
            f"WHERE zone = 'High Relief') up ON up.t = x.time_6h")


def _curve(view, score="risk_score", y="is_flood"):
    """Per distinct score: rows and positives at or above it."""
    return (f"SELECT {score} AS threshold, n, pos, "
            f"CAST(SUM(n) OVER d AS BIGINT) AS flagged, CAST(SUM(pos) OVER d AS BIGINT) AS tp, "
            f"CAST(SUM(n) OVER () AS BIGINT) AS total_n, CAST(SUM(pos) OVER () AS BIGINT) AS total_pos "
            f"FROM (SELECT {score}, COUNT(*) AS n, SUM({y}) AS pos FROM {view} GROUP BY 1) g "
            f"WINDOW d AS (ORDER BY {score} DESC ROWS UNBOUNDED PRECEDING)")


VIEWS = {
    "weather": ((), f"""SELECT {ZONE_EVENT} AS zone, date_trunc('hour', ts) AS time,
        CASE WHEN event_type = 'view' THEN value / 2 - 10 END AS temperature_2m,
        CASE WHEN event_type IN ('click', 'view') THEN least(55 + value / 2, 100) END AS relative_humidity_2m,
        CASE WHEN event_type = 'purchase' THEN value / 20 ELSE 0e0 END AS precipitation,
        CASE WHEN event_type = 'error' THEN value END AS wind_speed_10m,
        CAST(event_id % 45 AS DOUBLE) / 100 AS soil_moisture_0_to_7cm,
        CAST(event_id % 37 AS DOUBLE) / 100 AS soil_moisture_7_to_28cm,
        CAST(event_id % 40 AS DOUBLE) - 10 AS soil_temperature_0_to_7cm,
        CAST(user_id % 7 AS DOUBLE) / 100 AS et0_fao_evapotranspiration FROM events"""),
    "discharge": ((), f"""SELECT {ZONE_EVENT} AS zone, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS time,
        {mean('value')} / 50 AS river_discharge FROM events WHERE event_type = 'error' GROUP BY 1, 2"""),
    "h_weather": ((), f"""SELECT {ZONE_ITEM} AS zone, {ITEM_TIME} AS time,
        l_quantity - 15 AS temperature_2m, 50 + l_discount * 500 AS relative_humidity_2m,
        CASE WHEN l_suppkey % 5 < 2 THEN l_tax * 25 ELSE 0e0 END AS precipitation,
        CASE WHEN l_partkey % 3 <> 0 THEN l_extendedprice / 1000 END AS wind_speed_10m,
        CAST(l_partkey % 45 AS DOUBLE) / 100 AS soil_moisture_0_to_7cm,
        CAST(l_suppkey % 37 AS DOUBLE) / 100 AS soil_moisture_7_to_28cm,
        l_quantity - 20 AS soil_temperature_0_to_7cm, l_discount * 2 AS et0_fao_evapotranspiration
        FROM lineitem"""),
    "h_discharge": ((), f"SELECT {ZONE_ITEM} AS zone, l_shipdate AS time, "
                        "l_extendedprice / 90000 AS river_discharge FROM lineitem"),
    "slots": (("weather",), _resample("weather")),
    "h_slots": (("h_weather",), _resample("h_weather")),
    "daily": (("discharge",), _daily("discharge")),
    "h_daily": (("h_discharge",), _daily("h_discharge")),
    "silver": (("slots", "daily"), _silver("slots", "daily")),
    "h_silver": (("h_slots", "h_daily"), _silver("h_slots", "h_daily")),
    "base": (("silver",), _base("silver")),
    "h_base": (("h_silver",), _base("h_silver")),
    "framed": (("base",), _framed("base")),
    "h_framed": (("h_base",), _framed("h_base")),
    "derived": (("framed",), _derived("framed")),
    "h_derived": (("h_framed",), _derived("h_framed")),
    "gold": (("derived",), _gold("derived")),
    "h_gold": (("h_derived",), _gold("h_derived")),
    # the forecast keeps nulls until the base step and carries no label
    "f_slots": (("slots",), "SELECT *, 0e0 AS river_discharge FROM slots"),
    "profile": (("h_silver",), "SELECT zone, extract(doy FROM time_6h) AS doy, "
                "extract(hour FROM time_6h) AS hour, "
                + ", ".join(f"{mean(c)} AS {c}" for c in S.MEASURES)
                + " FROM h_silver GROUP BY 1, 2, 3"),
    "zone_profile": (("profile",), "SELECT zone, " + ", ".join(f"{mean(c)} AS {c}" for c in S.MEASURES)
                     + " FROM profile GROUP BY 1"),
    "scored": ((), f"""SELECT zone, time_6h, risk_score, is_flood, precipitation,
        CASE WHEN risk_score >= 0.6e0 THEN 1 ELSE 0 END AS flood_pred FROM (
        SELECT {ZONE_ITEM} AS zone, {ITEM_TIME} AS time_6h,
        floor(CAST(SUM(CAST(floor(l_extendedprice * 100 + 0.5e0) AS BIGINT)) AS DOUBLE)
              / (COUNT(*) * 1000e0) + 0.5e0) / 10000e0 AS risk_score,
        MAX(CASE WHEN l_quantity >= 49 THEN 1 ELSE 0 END) AS is_flood,
        CAST(SUM(CAST(floor(l_discount * 100 + 0.5e0) AS BIGINT)) AS DOUBLE) AS precipitation
        FROM lineitem GROUP BY 1, 2) q"""),
    "curve": (("scored",), _curve("scored")),
    "pr": (("curve",), "SELECT threshold, flagged, tp, total_n, total_pos, "
           "CAST(tp AS DOUBLE) / flagged AS p, CAST(tp AS DOUBLE) / total_pos AS r FROM curve"),
    "predictions": (("scored", "h_weather"), """SELECT s.zone, s.time_6h, temperature_2m,
        relative_humidity_2m, s.precipitation, wind_speed_10m, soil_moisture_0_to_7cm,
        soil_moisture_7_to_28cm, et0_fao_evapotranspiration, is_flood, risk_score, flood_pred,
        CASE WHEN risk_score > -0.001 AND risk_score <= 0.3e0 THEN 'LOW'
             WHEN risk_score > 0.3e0 AND risk_score <= 0.6e0 THEN 'MEDIUM'
             WHEN risk_score > 0.6e0 AND risk_score <= 1.001e0 THEN 'HIGH' END AS risk_level
        FROM scored s JOIN (SELECT zone, time, """
        + ", ".join(f"{mean(c)} AS {c}" for c in (
            "temperature_2m", "relative_humidity_2m", "wind_speed_10m", "soil_moisture_0_to_7cm",
            "soil_moisture_7_to_28cm", "et0_fao_evapotranspiration"))
        + " FROM h_weather GROUP BY 1, 2) m ON m.zone = s.zone AND m.time = s.time_6h"),
    "zone_dim": ((), "SELECT * FROM (VALUES " + ", ".join(
        f"('{z}', {a}e0, {b}e0)" for z, a, b in S.ZONES) + ") v(zone, latitude, longitude)"),
    "district_dim": ((), "SELECT * FROM (VALUES " + ", ".join(
        f"('{d}', '{z}')" for d, z in S.DISTRICTS) + ") v(name, zone)"),
}


def sql(body: str, *views: str, extra: dict[str, str] | None = None) -> str:
    """``body`` after a WITH clause that defines the views it needs, in order."""
    done: list[str] = []

    def need(name):
        if name in done:
            return
        for dep in VIEWS[name][0]:
            need(dep)
        done.append(name)

    for v in views:
        need(v)
    parts = [f"{v} AS ({VIEWS[v][1]})" for v in done]
    parts += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def level_ge(x):
    return f"CASE WHEN {x} >= 0.6e0 THEN 'HIGH' WHEN {x} >= 0.3e0 THEN 'MEDIUM' ELSE 'LOW' END"


def level_cut(x):
    return (f"CASE WHEN {x} > -0.001e0 AND {x} <= 0.3e0 THEN 'LOW' WHEN {x} > 0.3e0 AND {x} <= 0.6e0 "
            f"THEN 'MEDIUM' WHEN {x} > 0.6e0 AND {x} <= 1.001e0 THEN 'HIGH' END")
