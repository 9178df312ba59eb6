"""Late data, restarts, several micro-batches, slot cache."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tideline import settings as S
from tideline.session import shared_folder
from tideline.sources.lake import Lake
from tideline.streaming import streams as G

SCHEMA = "zone string, time timestamp_ntz, " + ", ".join(f"{m} double" for m in S.MEASURES)
DAY = dt.datetime(2024, 1, 1)


def land(spark, path, hours, value=1.0):
    rows = [("A", DAY + dt.timedelta(hours=h), *[value] * 8) for h in hours]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, path, work, out):
    stream = G.file_stream(spark, path, spark.read.schema(SCHEMA).parquet(path).schema, files=1)

    def put(batch, n):
        batch.write.mode("overwrite").parquet(f"{out}/batch={n}")

    q = (G.resample_stream(stream, "6 hours").writeStream.outputMode("append").option("checkpointLocation", work)
         .trigger(availableNow=True).foreachBatch(put).start())
    q.awaitTermination()
    return q


def test_closed_slots_never_change_and_restart_goes_on(spark):
    path, work, out = (shared_folder(spark, n) for n in ("in", "progress", "out"))
    land(spark, path, range(0, 30))
    run(spark, path, work, out)
    read = lambda: {(r["time_6h"].day, r["time_6h"].hour): r["precipitation"]
                    for r in spark.read.schema("zone string, time_6h timestamp_ntz, precipitation double").parquet(out).collect()}
    first = read()
    assert first and set(first.values()) == {6.0}
    land(spark, path, [1, 2], value=50.0)   # far behind the watermark
    land(spark, path, range(30, 60))
    q = run(spark, path, work, out)         # same checkpoint: only the new files are read
    after = read()
    assert {k: after[k] for k in first} == first and len(after) > len(first) and set(after.values()) == {6.0}
    dropped = sum(o.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for o in p["stateOperators"])
    assert dropped >= 1


def test_stateful_lags_over_many_batches_and_late_slots(spark, slots):
    path = shared_folder(spark, "feed")
    cols = G._SIGNALS
    mk = lambda ns: slots([("A", n, *[float(n)] * 4) for n in ns], cols)
    for part in (range(0, 5), range(5, 6), range(6, 20)):
        mk(part).coalesce(1).write.mode("append").parquet(path)
    mk([3]).withColumn("precipitation", F.lit(99.0)).coalesce(1).write.mode("append").parquet(path)  # late
    feed = G.file_stream(spark, path, mk([0]).schema, files=1)
    got = {int((r["time_6h"] - DAY).total_seconds() // 21600): r for r in
           G.run_to_table(G.stateful_lags(feed), "append").collect()}
    assert len(got) == 20
    for n, r in got.items():
        assert r["precip_lag_48h"] == (float(n - 8) if n >= 8 else None)
        assert r["precip_roll_sum_72h"] == sum(range(max(0, n - 11), n + 1))
        assert r["precip_roll_max_24h"] == n


def test_first_row_of_a_slot_wins_across_batches(spark, slots):
    path, work = shared_folder(spark, "feed"), shared_folder(spark, "progress")
    lake = Lake(spark, shared_folder(spark, "lake"))
    for value in (1.0, 2.0):
        slots([("A", 0, value), ("A", int(value), value)], ["v"]).coalesce(1).write.mode("append").parquet(path)
        feed = G.file_stream(spark, path, slots([("A", 0, 1.0)], ["v"]).schema, files=1)
        G.into_first_wins(feed, lake, "silver", "s", work).awaitTermination()
    got = sorted((r["time_6h"].hour, r["v"]) for r in lake.read("silver", "s").collect())
    assert got == [(0, 1.0), (6, 1.0), (12, 2.0)]


def test_slot_cache_rebuilds_with_a_new_slot(spark, slots):
    cache, calls = G.SlotCache(Lake(spark, shared_folder(spark, "lake"))), []

    def build():
        calls.append(1)
        return slots([("A", 0, float(len(calls)))], ["v"])

    at = lambda h: dt.datetime(2024, 5, 1, h)
    assert [cache.get(at(h), build).first()["v"] for h in (0, 5, 6, 11, 12)] == [1.0, 1.0, 2.0, 2.0, 3.0]
    with pytest.raises(LookupError):
        cache.lake.read("cache", "nothing")


def test_late_rows_go_to_the_side_and_no_row_is_lost(spark):
    """Thirty files out of order, inside and beyond the lateness, against a plain loop over the files."""
    import random
    rnd, path = random.Random(7), shared_folder(spark, "feed")
    rows = [("AB"[i % 2], DAY + dt.timedelta(hours=rnd.randrange(300)), rnd.choice([0.5, 1e-6, None, float("nan")]))
            for i in range(600)]
    came = sorted(rows, key=lambda r: r[1] + dt.timedelta(hours=rnd.choice([0, 3, 9, 60])))
    files = [came[i * 20:(i + 1) * 20] for i in range(30)]
    files[4].append(("A", None, 1.0))
    files[5].append((None, DAY, 1.0))
    schema = "zone string, time timestamp_ntz, precipitation double"
    for f in files:
        spark.createDataFrame(f, schema).coalesce(1).write.mode("append").parquet(path)
    with G.rocksdb_state(spark):
        feed = G.file_stream(spark, path, spark.read.parquet(path).schema, files=1)
        got = sorted(tuple(r) for r in G.run_to_table(G.slots_and_late_rows(feed, 12), "append").collect())
    rain = lambda v: 0.0 if v is None or v != v else v
    late, slots, clock = [], {}, None
    for f in files:
        f = [r for r in f if r[0] and r[1]]
        for z, t, v in f:
            start = t - dt.timedelta(hours=t.hour % 6)
            if clock is not None and start + dt.timedelta(hours=18) <= clock:
                late.append(("late", z, t, 1, rain(v)))
            else:
                n, s = slots.get((z, start), (0, 0.0))
                slots[z, start] = (n + 1, round(s + rain(v), 6))
        clock = max([t for _, t, _ in f] + ([clock] if clock else []))
    closed = [("slot", z, t, n, s) for (z, t), (n, s) in slots.items() if t + dt.timedelta(hours=18) <= clock]
    assert late and got == sorted(late + closed)
    still_open = sum(n for (z, t), (n, _) in slots.items() if t + dt.timedelta(hours=18) > clock)
    assert sum(r[3] for r in got) + still_open == 600


def test_a_table_without_flagged_slots_has_no_episodes(spark, tmp_path):
    """Slots of many rows: every mean price is below the threshold, so that nothing is landed."""
    from tideline.plans.stream_queries import stream
    rows = spark.range(400).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber", "50D AS l_quantity",
        "52000D AS l_extendedprice", "0.05D AS l_discount", "0.02D AS l_tax", "'A' AS l_returnflag",
        "CAST('1996-01-01' AS timestamp_ntz) + make_dt_interval(id % 4) AS l_shipdate")
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = stream.queries["X7_stream_episodes"](spark, str(tmp_path))
    assert got.columns == ["zone", "episode_start", "episode_end", "slots", "duration_hours", "peak_score"]
    assert got.collect() == []


def test_late_rows_of_an_empty_feed(spark):
    path = shared_folder(spark, "feed")
    spark.createDataFrame([], "zone string, time timestamp_ntz, precipitation double").write.parquet(path)
    with G.rocksdb_state(spark):
        feed = G.file_stream(spark, path, spark.read.parquet(path).schema)
        assert G.run_to_table(G.slots_and_late_rows(feed), "append").count() == 0
