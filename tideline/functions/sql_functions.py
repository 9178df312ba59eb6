"""The scalar rules as SQL functions, inlined by the optimizer."""
from __future__ import annotations

from pyspark.sql import SparkSession

from tideline import settings as S


def register(spark: SparkSession) -> list[str]:
    """Create the temporary functions and return their names."""
    lo, hi = S.RISK_MEDIUM, S.RISK_HIGH
    bounds = list(S.SENSOR_BOUNDS.items())
    args = ", ".join(f"v{i} DOUBLE" for i in range(len(bounds)))
    bad = " + ".join(f"CASE WHEN v{i} BETWEEN {a}D AND {b}D THEN 0 ELSE 1 END" for i, (_, (a, b)) in enumerate(bounds))
    weights = [float(S.DECAY ** p) for p in S.DECAY_POWERS.values()]
    lags = ", ".join(f"l{i} DOUBLE" for i in range(len(weights)))
    index = " + ".join(["now"] + [f"{w!r}D * coalesce(l{i}, 0D)" for i, w in enumerate(weights)])
    bodies = {
        "flood_label(discharge DOUBLE, rain DOUBLE, humidity DOUBLE) RETURNS INT":
            f"CASE WHEN coalesce(discharge, 0D) > {S.DISCHARGE_LIMIT}D AND (coalesce(rain, 0D) > {S.RAIN_LIMIT}D OR "
            f"coalesce(humidity, 0D) > {S.HUMIDITY_LIMIT}D) THEN 1 ELSE 0 END",
        f"dq_score({args}) RETURNS DOUBLE": f"1D - ({bad}) / {float(len(bounds))}D",
        "risk_level_cut(score DOUBLE) RETURNS STRING":
            f"CASE WHEN score > -0.001D AND score <= {lo}D THEN 'LOW' WHEN score > {lo}D AND score <= {hi}D THEN 'MEDIUM' "
            f"WHEN score > {hi}D AND score <= 1.001D THEN 'HIGH' END",
        "risk_level_ge(score DOUBLE) RETURNS STRING":
            f"CASE WHEN score >= {hi}D THEN 'HIGH' WHEN score >= {lo}D THEN 'MEDIUM' ELSE 'LOW' END",
        f"decay_index(now DOUBLE, {lags}) RETURNS DOUBLE": index,
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [h.split("(")[0] for h in bodies]
