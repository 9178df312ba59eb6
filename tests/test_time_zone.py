"""Local time stamps mean the same in any session time zone, clock changes included."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tideline.functions import columns as C
from tideline.operators import climatology as K, quality as Q, report as P, resample as R
from tideline.streaming import streams as G


@pytest.fixture
def new_york(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", before)


def test_seconds_and_event_time_round_trip(new_york, slots):
    x = slots([("A", n) for n in range(12)], [], dt.datetime(2024, 3, 9, 12))  # the clock changes on March 10
    rows = x.select("time_6h", C.local_seconds("time_6h").alias("s"),
                    C.from_event_time(C.as_event_time("time_6h")).alias("back")).orderBy("time_6h").collect()
    assert all(r["back"] == r["time_6h"] for r in rows)
    assert {b["s"] - a["s"] for a, b in zip(rows, rows[1:])} == {21600}


def test_grid_gaps_neighbourhood_and_slots(new_york, slots):
    start = dt.datetime(2024, 3, 9)
    x = slots([("A", n, int(n == 0), 1) for n in range(10) if n != 5], ["is_flood", "flood_pred"], start)
    assert [r["time_6h"] for r in Q.missing_slots(x.select("zone", "time_6h")).collect()] == [start + dt.timedelta(hours=30)]
    near = {(r["time_6h"] - start).total_seconds() / 21600: r["near"] for r in P.near_event(x).collect()}
    assert near[8] and not near[9]
    hours = slots([("A", n, 1.0) for n in range(3)], ["precipitation"], dt.datetime(2024, 3, 10, 2)).select(
        "zone", F.col("time_6h").alias("time"), "precipitation")
    got = sorted(r["time_6h"].hour for r in R.resample(hours, measures=["precipitation"]).collect())
    assert got == [0, 6, 12]


def test_stream_slots_equal_batch_slots(new_york):
    from tideline import settings as S
    from tideline.session import shared_folder
    spark = new_york
    rows = [("A", dt.datetime(2024, 3, 9) + dt.timedelta(hours=h), *[float(h)] * 8) for h in range(72)]
    df = spark.createDataFrame(rows, "zone string, time timestamp_ntz, " + ", ".join(f"{m} double" for m in S.MEASURES))
    path = shared_folder(spark, "feed")
    df.coalesce(1).write.parquet(path)
    got = G.run_to_table(G.resample_stream(G.file_stream(spark, path, df.schema)), "update", ["zone", "time_6h"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, R.resample(df).collect()))
