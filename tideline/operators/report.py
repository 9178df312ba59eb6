"""Alerts, boards, archive views and the small aggregates behind the charts."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tideline import settings as S
from tideline.functions import columns as C
from tideline.functions.sums import mean, total
from tideline.operators.scale import row_index, running, time_block

# ---- alerts and summaries -----------------------------------------------------
def zone_alerts(scored: DataFrame) -> DataFrame:
    """Peak score, exposure hours, level and text per zone.

    Exposure counts right-closed HIGH slots, the level uses the left-closed rule.
    """
    peak = scored.groupBy("zone").agg(
        F.max("risk_score").alias("_peak"),
        (F.count_if(F.col("risk_level") == "HIGH") * S.SLOT_HOURS).alias("high_risk_exposure_hours"))
    level = C.risk_level_ge("_peak")
    return peak.select(
        "zone", C.half_up("_peak", 3).alias("max_risk_score"), level.alias("risk_level"),
        "high_risk_exposure_hours",
        C.alert_message("zone", level, "_peak", "high_risk_exposure_hours").alias("alert_message"))


def zone_risk(scored: DataFrame) -> DataFrame:
    s = F.col("risk_score")
    return scored.groupBy("zone").agg(
        C.half_up(F.max(s), 3).alias("max_risk"), C.half_up(mean(s), 3).alias("mean_risk"),
        F.count_if(s >= S.RISK_HIGH).alias("high_risk_periods"),
        F.count_if((s >= S.RISK_MEDIUM) & (s < S.RISK_HIGH)).alias("med_risk_periods"))


def run_metadata(scored: DataFrame, model: str, days: int = S.HORIZON_DAYS) -> DataFrame:
    return scored.agg(
        F.min("time_6h").alias("forecast_start"), F.max("time_6h").alias("forecast_end"),
        F.lit(days).alias("horizon_days"),
        F.count_if(F.col("risk_level") == "HIGH").alias("high_risk_count"),
        F.lit(model).alias("model_used"))


def archive_summary(history: DataFrame) -> DataFrame:
    flood, flag = F.col(S.TARGET) == 1, F.col("flood_pred")
    return history.groupBy("zone").agg(
        C.half_up(F.max("precipitation"), 1).alias("peak_rain"),
        F.count_if(flood).alias("flood_events"),
        F.count_if(flood & (flag == 1)).alias("detected"),
        F.count_if(flood & (flag == 0)).alias("missed"))


def _city(high: Column, medium: Column, rows: Column) -> tuple[Column, Column]:
    label = (F.when(rows == 0, "UNKNOWN").when(high > 0, "FLOOD ALERT")
             .when(medium >= 2, "CITY-WIDE ADVISORY").when(medium == 1, "LOCAL WATCH")
             .otherwise("ALL CLEAR"))
    level = (F.when(rows == 0, "LOW").when(high > 0, "HIGH").when(medium >= 1, "MEDIUM")
             .otherwise("LOW"))
    return label, level


def city_status(scored: DataFrame, by: list[str] = ("time_6h",)) -> DataFrame:
    """City-wide label per slot; without ``by`` one row even for an empty slot."""
    label, level = _city(F.count_if(F.col("risk_level") == "HIGH"),
                         F.count_if(F.col("risk_level") == "MEDIUM"), F.count(F.lit(1)))
    return scored.groupBy(*by).agg(label.alias("label"), level.alias("level"))


def class_balance(df: DataFrame, by: list[str] = ()) -> DataFrame:
    pos, n = F.sum(S.TARGET), F.count(F.lit(1))
    rate = pos / n
    return df.groupBy(*by).agg(
        n.alias("rows"), pos.cast("bigint").alias("positives"), (n - pos).cast("bigint").alias("negatives"),
        rate.alias("rate"), ((1 - rate) / F.greatest(rate, F.lit(1e-9))).alias("imbalance"))


def month_zone_rate(df: DataFrame, zones: list[str]) -> DataFrame:
    """Flood rate per calendar month, one column per zone."""
    return (df.groupBy(F.month("time_6h").alias("month")).pivot("zone", zones)
            .agg(F.sum(S.TARGET) / F.count(F.lit(1))))


def month_series(df: DataFrame, zone: str, col: str = S.TARGET) -> DataFrame:
    """Monthly mean for one zone; a month without rows is null."""
    one = df.filter(F.col("zone") == zone).withColumn("month_end", F.last_day("time_6h"))
    means = one.groupBy("month_end").agg((F.sum(col) / F.count(col)).alias(f"mean_{col}"))
    span = one.agg(F.min("month_end").alias("a"), F.max("month_end").alias("z"))
    spine = span.select(F.explode(F.sequence(F.trunc("a", "month"), F.trunc("z", "month"),
                                             F.expr("INTERVAL 1 MONTH"))).alias("m"))
    return spine.select(F.last_day("m").alias("month_end")).join(means, "month_end", "left")


def month_climatology(df: DataFrame) -> DataFrame:
    return df.groupBy(F.month("time_6h").alias("month")).agg(
        C.half_up(mean("precipitation"), 3).alias("precip_mean"),
        C.half_up(mean(S.DISCHARGE), 3).alias("discharge_mean"),
        C.half_up(F.sum(S.TARGET) / F.count(S.TARGET), 3).alias("flood_rate"),
        C.half_up(mean("et0_fao_evapotranspiration"), 3).alias("et0_mean"))


def annual_totals(df: DataFrame, time="time_6h", col="precipitation") -> DataFrame:
    return df.groupBy("zone", F.year(time).alias("year")).agg(total(col).alias(f"{col}_total"))


# ---- replay and archive ---------------------------------------------------------
def newest_slots(df: DataFrame, n: int = S.REPLAY_SLOTS) -> DataFrame:
    """The newest ``n`` rows per zone; Spark limits each task before the shuffle."""
    from pyspark.sql import Window
    newest = Window.partitionBy("zone").orderBy(F.col("time_6h").desc())
    return df.withColumn("rn", F.row_number().over(newest)).filter(F.col("rn") <= n).drop("rn")


def rebase(df: DataFrame, base: Column) -> DataFrame:
    """Shift every zone so that its first slot is ``base``."""
    first = df.groupBy("zone").agg(F.min("time_6h").alias("_first"))
    return (df.join(first, "zone")
            .withColumn("time_6h", F.col("time_6h") + (base - F.col("_first"))).drop("_first"))


def between(df: DataFrame, start, end, time="time_6h") -> DataFrame:
    """Rows from ``start`` (included) to ``end`` (excluded)."""
    at = lambda v: F.lit(v).cast("timestamp_ntz") if isinstance(v, str) else v
    return df.filter((F.col(time) >= at(start)) & (F.col(time) < at(end)))


def history_view(df: DataFrame) -> DataFrame:
    """Archive records: predicted and actual score with their levels."""
    actual = F.col(S.TARGET).cast("double")
    return df.select(
        "zone", C.iso_time("time_6h").alias("time"), F.col("precipitation").cast("double").alias("precipitation"),
        F.col("risk_score").alias("predicted_score"), actual.alias("actual_score"),
        "flood_pred", S.TARGET, C.risk_level_ge("risk_score").alias("predicted_level"),
        C.risk_level_ge(actual).alias("actual_level"),
        F.lit(None).cast("string").alias("event_label"))


def near_event(df: DataFrame, hours: int = 48, event: str = S.TARGET) -> DataFrame:
    """Add ``near``: some event in the same zone within ``hours`` either way.

    Time is cut in cells of that length. An event in the same cell is near; for
    the cells before and after only their latest and earliest event matter, so
    each cell is summarised once and joined by equality.
    """
    cell = F.floor(C.local_seconds("time_6h") / F.lit(hours * 3600))
    x = df.withColumn("_cell", cell)
    seen = x.filter(F.col(event) == 1).groupBy("zone", "_cell").agg(
        F.min("time_6h").alias("_a"), F.max("time_6h").alias("_z"))
    sides = seen.select("zone", F.explode(F.array(
        F.struct((F.col("_cell") + 1).alias("_cell"), F.col("_z").alias("prev"),
                 F.lit(None).cast("timestamp_ntz").alias("next"), F.lit(0).alias("here")),
        F.struct((F.col("_cell") - 1).alias("_cell"), F.lit(None).cast("timestamp_ntz").alias("prev"),
                 F.col("_a").alias("next"), F.lit(0).alias("here")),
        F.struct(F.col("_cell").alias("_cell"), F.lit(None).cast("timestamp_ntz").alias("prev"),
                 F.lit(None).cast("timestamp_ntz").alias("next"), F.lit(1).alias("here")))).alias("s"))
    facts = sides.select("zone", "s.*").groupBy("zone", "_cell").agg(
        F.max("prev").alias("_prev"), F.min("next").alias("_next"), F.max("here").alias("_here"))
    reach = F.make_dt_interval(F.lit(0), F.lit(hours))
    near = ((F.col("_here") == 1) | (F.col("_prev") >= F.col("time_6h") - reach)
            | (F.col("_next") <= F.col("time_6h") + reach))
    return (x.join(facts, ["zone", "_cell"], "left")
            .withColumn("near", F.coalesce(near, F.lit(False)))
            .select(*df.columns, "near"))


def error_class(df: DataFrame, hours: int = 48) -> DataFrame:
    """DETECTED, MISSED, EARLY WARNING or FALSE ALARM for floods and predictions."""
    flood, flag = F.col(S.TARGET) == 1, F.col("flood_pred") == 1
    status = (F.when(flood & flag, "DETECTED").when(flood, "MISSED")
              .when(F.col("near"), "EARLY WARNING").otherwise("FALSE ALARM"))
    return (near_event(df, hours).filter(flood | flag).withColumn("status", status).drop("near"))


def chart_rows(view: DataFrame) -> DataFrame:
    return view.select(
        "zone", "time", C.half_up(F.col("predicted_score") * 100, 1).alias("predicted"),
        C.half_up(F.col("actual_score") * 100, 1).alias("actual"),
        C.half_up("precipitation", 2).alias("precip"))


# ---- boards ------------------------------------------------------------------------
def slot_index(df: DataFrame) -> DataFrame:
    """0-based position of each row's time among all times, for any number of zones."""
    times = df.select("time_6h").distinct()
    numbered = row_index(times, [], ["time_6h"], time_block("time_6h"), "slot")
    return df.join(numbered.withColumn("slot", F.col("slot").cast("int")), "time_6h")


def snapshot(df: DataFrame, slot: int) -> DataFrame:
    return slot_index(df).filter(F.col("slot") == slot)


def district_board(scored: DataFrame, districts=None) -> DataFrame:
    """Every district at every slot with its zone's level; LOW and 0 without a row."""
    districts = districts or S.DISTRICTS
    listed = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(z).alias("zone")) for n, z in districts])
    grid = (scored.select("time_6h").distinct().select("time_6h", F.explode(listed).alias("d"))
            .select("time_6h", "d.name", "d.zone"))
    now = scored.select("time_6h", "zone", "risk_level", "risk_score")
    level = F.coalesce("risk_level", F.lit("LOW"))
    return grid.join(now, ["time_6h", "zone"], "left").select(
        "time_6h", "name", "zone", level.alias("risk_level"),
        F.coalesce("risk_score", F.lit(0.0)).alias("score"), C.severity(level).alias("severity"))


def next_alert(scored: DataFrame, by: list[str] = ("zone",)) -> DataFrame:
    """First slot that is not LOW."""
    hot = scored.filter(F.col("risk_level") != "LOW")
    first = F.min_by(F.struct("time_6h", "risk_level", "risk_score"), "time_6h").alias("f")
    return hot.groupBy(*by).agg(first).select(
        *by, "f.*", F.floor(F.col("f.risk_score") * 100 + 0.5).cast("int").alias("percent"))


def first_slots(df: DataFrame, zone: str, n: int = 20) -> DataFrame:
    return df.filter(F.col("zone") == zone).orderBy("time_6h").limit(n)


def chart_ceiling(df: DataFrame, col: str = "precipitation", floor: float = 5.0) -> DataFrame:
    return df.groupBy("zone").agg(F.greatest(F.max(col), F.lit(floor)).alias("ceiling"))


def event_ticks(scored: DataFrame) -> DataFrame:
    """Timeline marks per zone: every HIGH slot, and a MEDIUM slot unless the slot
    before it has a mark. Inside a run of MEDIUM slots that is every second one,
    starting with the second when the run follows a HIGH slot."""
    block = time_block("time_6h")
    x = row_index(scored.select("zone", "time_6h", "risk_level"), ["zone"], ["time_6h"], block, "slot")
    i = F.col("slot")
    medium = F.coalesce(F.col("risk_level") == "MEDIUM", F.lit(False))
    x = running(x, ["zone"], ["time_6h"], block, {
        "_other": (F.when(~medium, i), "max"),
        "_high": (F.when(F.col("risk_level") == "HIGH", i), "max")})
    start = F.coalesce("_other", F.lit(-1))
    after_high = F.coalesce((F.col("_high") == F.col("_other")).cast("int"), F.lit(0))
    place = i - start - 1 + after_high
    keep = (F.col("risk_level") == "HIGH") | (medium & (place % 2 == 0))
    return x.filter(keep).select("zone", "time_6h", "slot", F.col("risk_level").alias("level"))


def timeline_ticks(scored: DataFrame, zone: str = "Low Relief", cap: int = 12) -> DataFrame:
    return event_ticks(scored.filter(F.col("zone") == zone)).orderBy("slot").limit(cap)


def alert_episodes(flagged: DataFrame, hours: int = S.SLOT_HOURS) -> DataFrame:
    """Consecutive flagged slots of a zone as one episode.

    Slot number minus position among the flagged slots is constant in a run, so
    a run is a plain group and no task sees a whole zone.
    """
    x = row_index(flagged.select("zone", "time_6h", "risk_score"), ["zone"], ["time_6h"],
                  time_block("time_6h"), "_i")
    run = F.floor(C.local_seconds("time_6h") / F.lit(hours * 3600)) - F.col("_i")
    return x.groupBy("zone", run.alias("_run")).agg(
        F.min("time_6h").alias("episode_start"),
        (F.max("time_6h") + F.make_dt_interval(F.lit(0), F.lit(hours))).alias("episode_end"),
        F.count(F.lit(1)).alias("slots"), (F.count(F.lit(1)) * hours).alias("duration_hours"),
        F.max("risk_score").alias("peak_score")).drop("_run")


def timeline(scored: DataFrame, threshold: float) -> DataFrame:
    """Score, truth and the three line crossings of a test period."""
    s = F.col("risk_score")
    return scored.select(
        "zone", "time_6h", "risk_score", S.TARGET, (s >= threshold).alias("over_threshold"),
        (s >= S.RISK_MEDIUM).alias("over_medium"), (s >= S.RISK_HIGH).alias("over_high"))
