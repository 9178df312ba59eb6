"""Structured Streaming forms of the batch operators."""
from __future__ import annotations

from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tideline import settings as S
from tideline.functions.columns import as_event_time, from_event_time
from tideline.functions.sums import DIGITS, mean, settle, total, value
from tideline.session import shared_folder

LATENESS = "12 hours"
BUFFER = 12


def file_stream(spark: SparkSession, folder: str, schema, files: int | None = None, glob: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(folder)


def resample_stream(hourly: DataFrame, lateness: str = LATENESS, hours: int = S.SLOT_HOURS) -> DataFrame:
    """Tumbling six-hour slots; state is kept until the watermark passes the slot."""
    x = hourly.withColumn("_at", as_event_time("time")).withWatermark("_at", lateness)
    return (x.groupBy("zone", F.window("_at", f"{hours} hours").alias("_w"))
            .agg(*[(total if c in S.FLUX_MEASURES else mean)(c).alias(c) for c in S.MEASURES])
            .select("zone", from_event_time("_w.start").alias("time_6h"), *S.MEASURES))


def sliding_stream(hourly: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """24-hour rain, evapotranspiration and maxima, every six hours."""
    x = hourly.withColumn("_at", as_event_time("time")).withWatermark("_at", lateness)
    return (x.groupBy("zone", F.window("_at", "24 hours", "6 hours").alias("_w"))
            .agg(total("precipitation").alias("rain_24h"), total("et0_fao_evapotranspiration").alias("et0_24h"),
                 F.max("precipitation").alias("rain_max_24h"), F.max("relative_humidity_2m").alias("humidity_max_24h"))
            .select("zone", from_event_time("_w.start").alias("window_start"), "rain_24h", "et0_24h",
                    "rain_max_24h", "humidity_max_24h"))


def first_per_slot(slots: DataFrame, time: str = "time_6h", lateness: str = LATENESS) -> DataFrame:
    """The first row of a (zone, slot) inside the lateness; later ones are dropped."""
    return (slots.withColumn("_at", as_event_time(time)).withWatermark("_at", lateness)
            .dropDuplicatesWithinWatermark(["zone", time]).drop("_at"))


def episodes_stream(flagged: DataFrame, lateness: str = LATENESS, hours: int = S.SLOT_HOURS) -> DataFrame:
    """Consecutive flagged slots as sessions; the gap is one slot and a second."""
    x = flagged.withColumn("_at", as_event_time("time_6h")).withWatermark("_at", lateness)
    return (x.groupBy("zone", F.session_window("_at", f"{hours} hours 1 second").alias("_w"))
            .agg(F.min("time_6h").alias("episode_start"), F.max("time_6h").alias("_last"),
                 F.count(F.lit(1)).alias("slots"), F.max("risk_score").alias("peak_score"))
            .select("zone", "episode_start",
                    (F.col("_last") + F.make_dt_interval(F.lit(0), F.lit(hours))).alias("episode_end"), "slots",
                    (F.col("slots") * hours).alias("duration_hours"), "peak_score"))


def with_daily(slots: DataFrame, daily: DataFrame, lag_days: int = 1) -> DataFrame:
    """Stream of slots against the static daily discharge of the day before."""
    from tideline.operators.resample import join_discharge
    return join_discharge(slots, daily, lag_days)


def with_climatology(slots: DataFrame, profile: DataFrame, measures=("precipitation",)) -> DataFrame:
    """Stream of slots with the static seasonal profile beside each measure, and the departure from it.

    A slot without a profile row has null in both. Whether the profile is broadcast is left to its measured size.
    """
    from tideline.operators.climatology import season_keys
    usual = profile.select("zone", "doy", "hour", *[F.col(c).alias(f"usual_{c}") for c in measures])
    x = slots.select("*", *season_keys()).join(usual, ["zone", "doy", "hour"], "left").drop("doy", "hour")
    return x.select("*", *[(F.col(c) - F.col(f"usual_{c}")).alias(f"{c}_departure") for c in measures])


# ---- stateful lags ---------------------------------------------------------------------
_SIGNALS = ["precipitation", "temperature_2m", "relative_humidity_2m", "et0_fao_evapotranspiration"]
LAG_SCHEMA = ("zone string, time_6h timestamp_ntz, precip_lag_6h double, precip_lag_12h double, precip_lag_24h double, "
              "precip_lag_48h double, temp_lag_24h double, precip_roll_sum_24h double, precip_roll_sum_48h double, "
              "precip_roll_sum_72h double, precip_roll_max_24h double, humidity_roll_max_24h double, "
              "et0_roll_sum_24h double")
_STATE = "slots array<struct<at:timestamp_ntz,v:array<double>>>"


def _lag_rows(zone: str, seen: pd.DataFrame, fresh: pd.DataFrame) -> pd.DataFrame:
    x = pd.concat([seen, fresh], ignore_index=True)
    rain, hum = x["precipitation"], x["relative_humidity_2m"]
    # every window is added up anew: a running sum would keep what a large value left behind
    roll = lambda s, n: sum(s.shift(k, fill_value=0.0) for k in range(n)).round(DIGITS)
    out = pd.DataFrame({"zone": zone, "time_6h": x["time_6h"]})
    for k in (1, 2, 4, 8):
        out[f"precip_lag_{6 * k}h"] = rain.shift(k)
    out["temp_lag_24h"] = x["temperature_2m"].shift(4)
    for n in (4, 8, 12):
        out[f"precip_roll_sum_{6 * n}h"] = roll(rain, n)
    out["precip_roll_max_24h"] = rain.rolling(4, min_periods=1).max()
    out["humidity_roll_max_24h"] = hum.rolling(4, min_periods=1).max()
    out["et0_roll_sum_24h"] = roll(x["et0_fao_evapotranspiration"], 4)
    return out.iloc[len(seen):]


def _lag_step(key, batches, state):
    zone = key[0]
    names = ["time_6h"] + _SIGNALS
    kept = state.get[0] if state.exists else []
    seen = pd.DataFrame([[e["at"], *e["v"]] for e in kept], columns=names)
    fresh = pd.concat(list(batches), ignore_index=True)[names].sort_values("time_6h", kind="stable")
    fresh = fresh.drop_duplicates("time_6h")
    if len(seen):
        fresh = fresh[fresh["time_6h"] > seen["time_6h"].iloc[-1]]  # an emitted slot never changes
    if not len(fresh):
        return
    seen["time_6h"] = pd.to_datetime(seen["time_6h"])
    out = _lag_rows(zone, seen, fresh)
    tail = pd.concat([seen, fresh], ignore_index=True).tail(BUFFER)
    state.update(([{"at": t.to_pydatetime(), "v": [float(v) for v in row]}
                   for t, row in zip(tail["time_6h"], tail[_SIGNALS].to_numpy())],))
    yield out


def stateful_lags(slots: DataFrame) -> DataFrame:
    """Lags and rolling values per zone from the last twelve slots kept as state.

    Slots arrive in time order; a zone's part of one micro-batch is handled at
    once, so ``maxFilesPerTrigger`` bounds the memory.
    """
    from tideline.functions.columns import zero_if_null
    x = slots.select("zone", "time_6h", *[zero_if_null(c).alias(c) for c in _SIGNALS])
    return x.groupBy("zone").applyInPandasWithState(
        _lag_step, LAG_SCHEMA, _STATE, "append", "NoTimeout")


# ---- late rows ------------------------------------------------------------------------------
HOLD_MS = 3650 * 86_400_000       # Spark's own watermark trails this far behind the newest row, so that it drops nothing
CLOSED_SCHEMA = "kind string, zone string, at long, readings long, rain double"


class ClosedSlots(StatefulProcessor):
    """Open slots of a zone as map state, a timer for each: fired when the newest row is past end and lateness."""

    def __init__(self, slot_ms: int, lateness_ms: int):
        self.slot_ms, self.lateness_ms = slot_ms, lateness_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "slot long", "readings long, rain double")

    def _due(self, slot):
        return slot + self.slot_ms + self.lateness_ms - HOLD_MS

    def handleInputRows(self, key, rows, timerValues):
        clock = timerValues.getCurrentWatermarkInMs()      # newest row of earlier micro-batches, less HOLD_MS
        for x in rows:
            late = self._due(x["slot"]) <= clock
            if late.any():
                y = x[late]
                yield pd.DataFrame({"kind": "late", "zone": key[0], "at": y["at"], "readings": 1, "rain": y["rain"]})
            sums = x[~late].groupby("slot")["rain"].agg(["size", "sum"])
            for slot, n, rain in zip(sums.index.tolist(), sums["size"].tolist(), sums["sum"].tolist()):
                if self.open.containsKey((slot,)):
                    seen = self.open.getValue((slot,))
                    n, rain = n + seen[0], rain + seen[1]
                else:
                    self.handle.registerTimer(self._due(slot))
                self.open.updateValue((slot,), (n, rain))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        slot = expiredTimerInfo.getExpiryTimeInMs() + HOLD_MS - self.lateness_ms - self.slot_ms
        n, rain = self.open.getValue((slot,))
        self.open.removeKey((slot,))
        yield pd.DataFrame({"kind": ["slot"], "zone": [key[0]], "at": [slot], "readings": [n], "rain": [rain]})

    def close(self) -> None:
        pass


def slots_and_late_rows(hourly: DataFrame, lateness_hours: int = BUFFER, hours: int = S.SLOT_HOURS) -> DataFrame:
    """Closed slots (``kind`` slot: start, readings, rain) and each row that came after its slot closed (``kind`` late).

    A slot closes once the newest row of earlier micro-batches, of any zone, is ``lateness_hours`` or more past its end;
    its state goes with it. No row is lost: every row is in one closed slot, in one still open, or is a late row. Rows
    without time or zone have no slot and are left out; rain that is null or no number counts as none. Needs the RocksDB
    state store (``rocksdb_state``) and times after 1980.
    """
    hour = 3_600_000
    x = hourly.select("zone", as_event_time("time").alias("_at"), "precipitation").filter(
        F.col("zone").isNotNull() & F.col("_at").isNotNull()).withWatermark("_at", f"{HOLD_MS // 86_400_000} days")
    at = F.unix_millis("_at")
    x = x.select("zone", "_at", at.alias("at"), (at - F.pmod(at, F.lit(hours * hour))).alias("slot"),
                 F.coalesce(value("precipitation"), F.lit(0.0)).alias("rain"))
    out = x.groupBy("zone").transformWithStateInPandas(
        ClosedSlots(hours * hour, lateness_hours * hour), CLOSED_SCHEMA, "Append", "EventTime")
    return out.select("kind", "zone", from_event_time(F.timestamp_millis("at")).alias("time"), "readings",
                      settle(F.col("rain")).alias("precipitation"))


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; the session's setting is put back afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


# ---- sinks ---------------------------------------------------------------------------------
def run_to_table(stream: DataFrame, mode: str, keys: list[str] | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run what is available into a shared folder and read the table back.

    Every micro-batch writes its own folder, so a repeated batch replaces
    itself. In update mode the last batch that holds a key wins; in complete
    mode the last batch is the table. A feed without a file has no batch and
    gives an empty table.
    """
    spark = stream.sparkSession
    path = shared_folder(spark, "stream")
    work = checkpoint or shared_folder(spark, "progress")
    written = []

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number:09d}")
        written.append(number)

    q = (stream.writeStream.outputMode(mode).option("checkpointLocation", work)
         .trigger(availableNow=True).foreachBatch(put).start())
    q.awaitTermination()
    if not written:
        return spark.createDataFrame([], stream.schema)
    schema = T.StructType(stream.schema.fields + [T.StructField("batch", T.IntegerType())])
    rows = spark.read.schema(schema).parquet(path)
    cols = stream.columns
    if mode == "update":
        last = F.max_by(F.struct(*[c for c in cols if c not in keys]), "batch").alias("_r")
        return rows.groupBy(*keys).agg(last).select(*keys, "_r.*").select(*cols)
    if mode == "complete":
        newest = rows.agg(F.max("batch")).scalar()
        return rows.filter(F.col("batch") == newest).select(*cols)
    return rows.select(*cols)


def into_first_wins(stream: DataFrame, lake, layer: str, name: str, checkpoint: str, keys=("zone", "time_6h")):
    """Append rows with a new key to a stored table; safe to repeat after a failure."""
    def put(batch: DataFrame, _: int) -> None:
        lake.insert_absent(batch, layer, name, list(keys), dedupe=True)

    return (stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .foreachBatch(put).start())


def score_stream(features: DataFrame, bundle, alerts_to: str, checkpoint: str):
    """Score each micro-batch with a stored model and write its alerts."""
    from tideline.operators.report import zone_alerts
    from tideline.plans.training import predict

    def put(batch: DataFrame, number: int) -> None:
        zone_alerts(predict(batch, bundle)).write.mode("overwrite").parquet(f"{alerts_to}/batch={number:09d}")

    return (features.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .foreachBatch(put).start())


class SlotCache:
    """One stored result per six-hour slot; a new slot rebuilds it."""

    def __init__(self, lake, name: str = "forecast"):
        self.lake, self.name = lake, name

    def table(self, now) -> str:
        return f"{self.name}_{now:%Y%m%d}_{now.hour // S.SLOT_HOURS}"

    def get(self, now, build) -> DataFrame:
        name = self.table(now)
        if not self.lake.exists("cache", name):
            self.lake.replace(build(), "cache", name)
        return self.lake.read("cache", name)
