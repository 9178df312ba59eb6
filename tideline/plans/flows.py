"""The end-to-end flows a user runs, composed from the operators."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline import settings as S
from tideline.operators import climatology as K, features as X, resample as R
from tideline.session import cut_lineage
from tideline.sources.lake import Lake

KEY = ["zone", "time_6h"]


def bronze_to_silver(hourly: DataFrame, daily: DataFrame) -> DataFrame:
    return R.silver(hourly, daily)


def silver_to_gold(slots: DataFrame, is_forecast: bool = False) -> DataFrame:
    return X.gold(slots, is_forecast)


def ingest(lake: Lake, hourly: DataFrame, daily: DataFrame) -> None:
    """Insert what the bronze tables lack, keyed by zone and time."""
    lake.insert_absent(hourly, "bronze", "weather_raw", ["zone", "time"], ["zone"])
    lake.insert_absent(daily, "bronze", "flood_raw", ["zone", "time"], ["zone"])


def build_history(lake: Lake, purge_bronze: bool = False) -> DataFrame:
    """Bronze to silver to gold, each stage stored before the next reads it."""
    slots = lake.replace(
        bronze_to_silver(lake.read("bronze", "weather_raw"), lake.read("bronze", "flood_raw")),
        "silver", "weather_flood_6h", ["zone"])
    features = lake.replace(silver_to_gold(slots), "gold", "flood_features", ["zone"])
    lake.purge("bronze", purge_bronze)
    return features


def forecast_features(live: DataFrame, history: DataFrame, zones: DataFrame, now: Column,
                      days: int = S.HORIZON_DAYS) -> DataFrame:
    """Live slots, extended by climatology, as features from ``now`` on."""
    stream = cut_lineage(K.extend_horizon(live, history, zones, days))  # read by several branches
    return silver_to_gold(stream, is_forecast=True).filter(F.col("time_6h") >= now)


def run_forecast(lake: Lake, hourly: DataFrame, zones: DataFrame, now: Column,
                 days: int = S.HORIZON_DAYS) -> DataFrame:
    """The same against the stored stream table, where the first row of a slot stays."""
    stream = K.extend_horizon(R.forecast_slots(hourly), lake.read("silver", "weather_flood_6h"),
                              zones, days)
    stored = lake.insert_absent(stream, "silver", "weather_stream_6h", KEY, ["zone"])
    return silver_to_gold(stored, is_forecast=True).filter(F.col("time_6h") >= now)


def forecast_replay(predictions: DataFrame, base: Column) -> DataFrame:
    """The newest stored slots per zone, shifted to start at ``base``, as records."""
    from tideline.operators.report import newest_slots, rebase
    from tideline.sources.feeds import records
    return records(rebase(newest_slots(predictions), base))


def historical(predictions: DataFrame, start, end) -> DataFrame:
    from tideline.operators.report import between, history_view
    return history_view(between(predictions, start, end))


def archive_report(predictions: DataFrame, zone: str, start, end) -> dict[str, DataFrame]:
    """Summary, error classes and chart rows of one zone and range."""
    from tideline.operators import report as P
    rows = P.between(predictions, start, end).filter(F.col("zone") == zone)
    return {"summary": P.archive_summary(rows), "errors": P.error_class(rows),
            "chart": P.chart_rows(P.history_view(rows))}


def city_board(predictions: DataFrame, slot: int) -> dict[str, DataFrame]:
    """Everything the dashboard shows for one slot."""
    from tideline.operators import report as P
    now = P.snapshot(predictions, slot)
    return {"status": P.city_status(now, []),
            "districts": P.district_board(now).orderBy("severity"),
            "next_alert": P.next_alert(predictions.filter(F.col("zone") == "Low Relief")),
            "ticks": P.timeline_ticks(predictions)}


def forecast_run(lake: Lake, hourly: DataFrame, zones: DataFrame, now: Column, bundle, name: str,
                 days: int = S.HORIZON_DAYS) -> dict[str, DataFrame]:
    """Scored forecast, alerts by zone and one row of metadata."""
    from tideline.operators.report import run_metadata, zone_alerts
    from tideline.plans.training import predict
    scored = cut_lineage(predict(run_forecast(lake, hourly, zones, now, days), bundle))
    return {"forecast": scored, "alerts": zone_alerts(scored).orderBy(F.col("max_risk_score").desc()),
            "metadata": run_metadata(scored, name, days)}
