"""Landed feeds, layered tables, catalog probes."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tideline import settings as S
from tideline.operators import quality as Q
from tideline.plans import flows
from tideline.sources import feeds, lake as lk

M = ["temperature_2m", "precipitation"]


@pytest.fixture
def docs(tmp_path):
    def put(zone, doc, name="a.json"):
        folder = tmp_path / "in" / f"zone={zone}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(json.dumps(doc, indent=1))
        return str(tmp_path / "in")
    return put


def good(n=3):
    return {"hourly": {"time": [f"2024-01-01T{h:02d}:00" for h in range(n)], "temperature_2m": [1.5, None, 3.0][:n],
                       "precipitation": [0.0, 0.1, 0.2][:n]}}


def test_columnar_json_to_rows(spark, docs):
    path = docs("High Relief", good())
    rows = feeds.weather(feeds.read_documents(spark, path, "hourly", M, whole_file=True), M).orderBy("time").collect()
    assert [(r["zone"], r["time"].hour, r["temperature_2m"], r["precipitation"]) for r in rows] == [
        ("High Relief", 0, 1.5, 0.0), ("High Relief", 1, None, 0.1), ("High Relief", 2, 3.0, 0.2)]


def test_missing_hourly_block_is_an_error_and_can_be_skipped(spark, docs):
    docs("A", good())
    path = docs("B", {"error": True, "reason": "limit"})
    d = feeds.read_documents(spark, path, "hourly", M, whole_file=True)
    with pytest.raises(Exception, match="malformed response"):
        feeds.weather(d, M).collect()
    assert {r["zone"] for r in feeds.forecast(d, measures=M).collect()} == {"A"}
    assert [tuple(r) for r in feeds.bad_documents(d, "hourly").collect()] == [("B", 1)]


def test_all_forecast_feeds_failed(spark, docs):
    path = docs("A", {"error": True})
    with pytest.raises(RuntimeError):
        feeds.forecast(feeds.read_documents(spark, path, "hourly", M, whole_file=True), measures=M)


def test_missing_daily_block_gives_no_rows(spark, docs):
    path = docs("A", {"daily": {"time": ["2024-01-01"], "river_discharge": [1.25]}})
    docs("B", {"reason": "none"})
    d = feeds.read_documents(spark, path, "daily", ["river_discharge"], whole_file=True)
    assert [(r["zone"], r["river_discharge"]) for r in feeds.discharge(d).collect()] == [("A", 1.25)]


def test_csv_round_trip_by_zone(spark, tmp_path, slots):
    df = slots([("High Relief", 0, 1.5), ("B", 1, None), ("B", 2, 3.0)], ["v"])
    out = str(tmp_path / "csv")
    feeds.write_csv(df.withColumn("part", F.col("zone")), out, ["part"])
    back = feeds.read_csv(spark, out + "/part=*", "zone string, time_6h timestamp_ntz, v double")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_records_fill_nulls_and_add_discharge(spark, slots):
    df = slots([("A", 0, *[None] * 7, 0.4, 1, "LOW")], S.PREDICTION_COLUMNS[2:9] + ["risk_score", "flood_pred", "risk_level"])
    r = feeds.records(df).first()
    assert r["time"] == "2024-01-01T00:00:00" and r["precipitation"] == 0 and r["river_discharge"] == 0
    assert feeds.records(df).columns == S.RECORD_COLUMNS
    assert json.loads(feeds.as_json(feeds.records(df)).first()[0])["risk_level"] == "LOW"


def test_points(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"points": [[49.5, 40.3, 12.0, 2], [49.6, 40.4, -3.0, 0]]}))
    assert sorted(map(tuple, feeds.points(spark, str(tmp_path)).collect())) == [(49.5, 40.3, 12.0, 2), (49.6, 40.4, -3.0, 0)]


# ---- lake ----------------------------------------------------------------------------------
@pytest.fixture
def lake(spark, tmp_path):
    return lk.Lake(spark, str(tmp_path / "lake"))


def test_tables_exist_list_replace_purge(spark, lake, slots):
    assert not lake.exists("gold", "t") and lake.tables("gold") == []
    with pytest.raises(LookupError):
        lake.read("gold", "t")
    lake.replace(slots([("A", 0, 1.0)], ["v"]), "gold", "t", ["zone"])
    lake.replace(slots([("A", 0, 2.0)], ["v"]), "gold", "t", ["zone"])
    assert lake.exists("gold", "t") and lake.tables("gold") == ["t"] and lake.read("gold", "t").first()["v"] == 2.0
    assert lake.purge("gold") is False and lake.exists("gold", "t")
    assert lake.purge("gold", enabled=True) is True and not lake.exists("gold", "t")


def test_a_failed_replace_leaves_the_old_rows(spark, lake, slots):
    lake.replace(slots([("A", 0, 1.0), ("B", 0, 2.0)], ["v"]), "gold", "t", ["zone"])
    bad = slots([("A", n, float(n)) for n in range(50)], ["v"]).repartition(8, "time_6h").withColumn(
        "v", F.when(F.col("v") == 49, F.raise_error("lost").cast("double")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        lake.replace(bad, "gold", "t", ["zone"])
    assert sorted(r["v"] for r in lake.read("gold", "t").collect()) == [1.0, 2.0] and lake.tables("gold") == ["t"]


def test_a_switch_cut_short_is_undone(spark, lake, slots):
    import os
    lake.replace(slots([("A", 0, 1.0)], ["v"]), "gold", "t")
    at = lake.path("gold", "t")
    os.rename(at, lake._aside("gold", "t", "old"))          # lost between the two renames
    assert lake.exists("gold", "t") and lake.read("gold", "t").first()["v"] == 1.0
    # a table may be replaced by rows that are read from it
    lake.replace(lake.read("gold", "t").withColumn("v", F.col("v") + 1), "gold", "t")
    assert lake.read("gold", "t").first()["v"] == 2.0 and lake.tables("gold") == ["t"]


def test_catalog_switch_keeps_readers_and_survives_a_failed_write(spark, slots, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS switched LOCATION '{tmp_path}/switched'")
    try:
        lk.add_catalog_table(slots([("01", 0, 1.0)], ["v"]), "switched.t", ["zone"])
        begun = spark.table("switched.t")
        bad = slots([("01", 0, 2.0)], ["v"]).withColumn("v", F.raise_error("lost").cast("double"))
        with pytest.raises(Exception, match="lost"):
            lk.add_catalog_table(bad, "switched.t", ["zone"])
        assert spark.table("switched.t").first()["v"] == 1.0
        lk.add_catalog_table(slots([("A", 0, 2.0)], ["v"]), "switched.t")
        assert begun.first()["v"] == 1.0 and spark.table("switched.t").first()["v"] == 2.0
        assert spark.table("switched.t").schema["time_6h"].dataType.typeName() == "timestamp_ntz"
    finally:
        spark.sql("DROP DATABASE switched CASCADE")


def test_one_row_of_a_key_does_not_depend_on_partitions(spark, lake, slots):
    rows = [("A", 0, 3.0), ("A", 0, 1.0), ("A", 0, None), ("B", 1, 2.0), ("B", 1, 2.0)]
    for n in (1, 4):
        got = lk.one_per_key(slots(rows, ["v"]).repartition(n), ["zone", "time_6h"]).collect()
        assert sorted(((r["zone"], r["v"]) for r in got), key=str) == [("A", None), ("B", 2.0)]
    assert lk.one_per_key(slots(rows, ["v"]).drop("v"), ["zone", "time_6h"]).count() == 2


def test_insert_if_absent_is_idempotent_and_first_wins(lake, slots):
    keys = ["zone", "time_6h"]
    lake.insert_absent(slots([("A", 0, 1.0), ("A", 1, 1.0)], ["v"]), "silver", "s", keys, ["zone"])
    for _ in range(2):
        lake.insert_absent(slots([("A", 1, 9.0), ("A", 2, 9.0)], ["v"]), "silver", "s", keys, ["zone"])
    assert sorted((r["time_6h"].hour, r["v"]) for r in lake.read("silver", "s").collect()) == [(0, 1.0), (6, 1.0), (12, 9.0)]


def test_history_build_is_repeatable_and_forecast_uses_stored_rows(spark, lake, slots):
    start = dt.datetime(2024, 1, 1)
    hours = [("High Relief", start + dt.timedelta(hours=h), *[float(h % 7)] * 8) for h in range(24 * 40)]
    schema = "zone string, time timestamp_ntz, " + ", ".join(f"{m} double" for m in S.MEASURES)
    hourly = spark.createDataFrame(hours, schema)
    daily = spark.createDataFrame([("High Relief", start + dt.timedelta(days=d), 2.0) for d in range(40)],
                                  "zone string, time timestamp_ntz, river_discharge double")
    flows.ingest(lake, hourly, daily)
    flows.ingest(lake, hourly, daily)
    first = sorted(map(tuple, flows.build_history(lake).collect()), key=str)
    assert len(first) == 160 and lake.read("bronze", "weather_raw").count() == 960
    assert sorted(map(tuple, flows.build_history(lake, purge_bronze=True).collect()), key=str) == first
    assert not lake.exists("bronze", "weather_raw")
    live = spark.createDataFrame([(z, t + dt.timedelta(days=40), *v) for z, t, *v in hours[:360]], schema)
    zones = spark.createDataFrame([("High Relief",)], "zone string")
    now = F.lit("2024-02-12").cast("timestamp_ntz")
    out = flows.run_forecast(lake, live, zones, now)
    assert out.agg(F.min("time_6h")).first()[0] == dt.datetime(2024, 2, 12)
    assert lake.read("silver", "weather_stream_6h").count() == 60 + 61
    before = out.count()
    assert flows.run_forecast(lake, live, zones, now).count() == before


def test_catalog_probes(spark, slots, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS probe LOCATION '{tmp_path}/probe'")
    try:
        assert not lk.catalog_has(spark, "probe.t") and lk.catalog_tables(spark, "nothing") == []
        lk.add_catalog_table(slots([("A", 0, 1.0)], ["v"]), "probe.t")
        lk.add_catalog_table(slots([("A", 0, 2.0)], ["v"]), "probe.t")
        assert lk.catalog_has(spark, "probe.t") and lk.catalog_tables(spark, "probe") == ["t"]
        assert spark.table("probe.t").first()["v"] == 2.0
    finally:
        spark.sql("DROP DATABASE probe CASCADE")


def test_guards(spark):
    with pytest.raises(ValueError):
        lk.require_rows(spark.range(0), "gold")
    with pytest.raises(ValueError):
        lk.require_column(spark.range(1), "is_flood")


# ---- audits ------------------------------------------------------------------------------------
def test_audit_counts_gaps_and_nulls(spark, slots):
    x = slots([("A", 0, 1.0), ("A", 4, None), ("A", 12, 2.0), ("A", 13, 2.0)], ["v"])
    r = Q.audit(x, "demo", step_hours=24, time="time_6h").first()  # days 1, 2, 4: day 3 is missing
    assert (r["rows"], r["gaps"], r["nulls"]) == (4, 1, {"v": 1})
    by = Q.audit(x, "demo", step_hours=6, time="time_6h", by=["zone"]).first()
    assert by["gaps"] == 10


def test_strict_gate(spark, slots):
    x = slots([("A", n, 1.0 if n else None) for n in range(10)], ["v"])
    assert [r["column"] for r in Q.quality_gate(x, ["v"]).collect()] == ["v"]
    with pytest.raises(ValueError):
        Q.quality_gate(x, ["v"], strict=True)
    assert Q.quality_gate(x, ["v"], max_pct=10.0).count() == 0
