"""Sketches of days merge to the quantiles of a range."""
import datetime as dt
import random

from tideline.operators import sketches as K

START = dt.datetime(2024, 1, 1)


def test_merged_days_keep_the_rank_error(spark):
    rnd = random.Random(4)
    rows = [("A", START + dt.timedelta(hours=rnd.randrange(24 * 40)), rnd.choice([rnd.gauss(0, 1), 7.0])) for _ in range(20000)]
    odd = [("A", START, None), ("A", START, float("nan")), ("A", None, 1.0), ("B", START, 3.0), ("C", START, None)]
    days = K.daily_sketches(spark.createDataFrame(rows + odd, "zone string, time timestamp_ntz, v double"), "v")
    a, z = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
    got = {r["zone"]: r for r in K.estimates(K.merged(days, a, z), {"p10": 0.1, "p90": 0.9}).collect()}
    values = sorted(v for _, t, v in rows if a <= t.date() <= z)
    r = got["A"]
    assert set(got) == {"A"} and r["n"] == len(values)
    for p, q in (("p10", 0.1), ("p90", 0.9)):
        below, upto = sum(v < r[p] for v in values) / len(values), sum(v <= r[p] for v in values) / len(values)
        assert below <= q + 2 * K.RANK_ERROR and upto >= q - 2 * K.RANK_ERROR   # the bound itself has 99 %
    assert abs(r["distinct_values"] - len(set(values))) <= 0.05 * len(set(values))
    whole = {r["zone"]: r for r in K.estimates(K.merged(days), {"p50": 0.5}).collect()}
    assert set(whole) == {"A", "B"} and (whole["B"]["n"], whole["B"]["p50"], whole["B"]["distinct_values"]) == (1, 3.0, 1)
    assert K.merged(days.limit(0)).count() == 0
