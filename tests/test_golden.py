"""Recorded feature rows of the same-day variant, rebuilt from the readings behind them."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tideline import settings as S
from tideline.operators import features as X

START = dt.datetime(2024, 3, 20)
RAIN = [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.8, 5.3, 5.3, 4.8, 1.8, 2.3, 0.2, 0.0, 0.7, 0.4]  # slots -11 .. 4
TEMP = {-4: 8.033333, -3: 8.066667, -2: 8.366667, -1: 7.633333, 0: 7.416667, 1: 7.966667, 2: 8.85, 3: 6.533333, 4: 6.033333}
SOIL0 = {-1: 0.382333, 0: 0.388333, 1: 0.383, 2: 0.365333, 3: 0.356833, 4: 0.351167}
SOIL7 = {0: 0.2825, 1: 0.293167, 2: 0.2975, 3: 0.300333, 4: 0.302167}
WANT = {  # slot: lag 24 h, lag 48 h, sums of 24/48/72 h, index, saturation, soil change, deficit, temperature trend
    0: (5.3, 0.0, 14.2, 20.3, 20.3, 10.064633, 0.335417, 0.006, 0.114583, -0.616667),
    1: (5.3, 0.0, 9.1, 20.5, 20.5, 6.222133, 0.338083, -0.005333, 0.111917, -0.1),
    2: (4.8, 0.0, 4.3, 20.5, 20.5, 4.337380, 0.331417, -0.017667, 0.118583, 0.483333),
    3: (1.8, 0.8, 3.2, 20.4, 21.2, 1.784111, 0.328583, -0.0085, 0.121417, -1.1),
    4: (2.3, 5.3, 1.3, 15.5, 21.6, 2.195614, 0.326667, -0.005667, 0.123333, -1.383333),
}


def test_recorded_rows(spark):
    rows = []
    for i, rain in enumerate(RAIN):
        n = i - 11
        rows.append(("Low Relief", START + dt.timedelta(hours=6 * n), TEMP.get(n, 0.0), 80.0, rain, 0.0,
                     SOIL0.get(n, 0.0), SOIL7.get(n, 0.0), 7.0, 0.1, 0.08))
    schema = "zone string, time_6h timestamp_ntz, " + ", ".join(f"{c} double" for c in S.MEASURES) + ", river_discharge double"
    out = X.legacy_features(spark.createDataFrame(rows, schema)).filter(F.col("time_6h") >= F.lit(str(START)).cast("timestamp_ntz"))
    cols = ["precip_lag_24h", "precip_lag_48h", "precip_roll_sum_24h", "precip_roll_sum_48h", "precip_roll_sum_72h", "api_7d",
            "soil_saturation_index", "soil_moisture_change_6h", "soil_moisture_deficit", "temp_trend_24h"]
    got = [tuple(r[c] for c in cols) for r in out.orderBy("time_6h").collect()]
    assert len(got) == 5
    for slot, values in enumerate(got):
        assert values == pytest.approx(WANT[slot], abs=2e-6)
    first = out.orderBy("time_6h").first()
    assert first["doy_sin"] == pytest.approx(0.981306, abs=1e-6) and first["hour_cos"] == 1.0
