"""Missing classes, equal scores, NaN and repeated keys."""
import math

import pytest

from tideline.operators import metrics as M
from tideline.operators.features import rolling_mean
from tideline.sources.lake import upsert


@pytest.mark.parametrize("label, area", [(0, 0.0), (1, 1.0)])
def test_one_class(spark, label, area):
    df = spark.createDataFrame([(0.1 * i, label) for i in range(5)], "risk_score double, is_flood int")
    c = M.curve(df)
    both = M.ranking_metrics(c).first()
    assert both["auc_roc"] is None and both["auc_pr"] == area
    assert M.roc_auc(c).first()["auc_roc"] is None and M.average_precision(c).first()["auc_pr"] == area


def test_equal_scores(spark):
    df = spark.createDataFrame([(0.4, i % 2) for i in range(6)], "risk_score double, is_flood int")
    rows = M.histogram(df, bins=4).collect()
    assert sorted((r["is_flood"], r["n"]) for r in rows) == [(0, 3), (1, 3)]
    assert all(r["density"] == pytest.approx(4.0) for r in rows)


def test_nan_is_no_value(slots):
    values = [1.0, 1.0, math.nan, 1.0, 1.0, 1.0]
    df = slots([("a", i, v) for i, v in enumerate(values)], ["x"])
    got = [r["m"] for r in rolling_mean(df, "x", 3, out="m").orderBy("time_6h").collect()]
    assert got == [None, None, None, None, None, 1.0]


def test_latest_wins_once(spark):
    old = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    new = spark.createDataFrame([(2, "new"), (2, "new")], "k int, v string")
    assert sorted(map(tuple, upsert(old, new, ["k"], "latest_wins", dedupe=True).collect())) == [(1, "old"), (2, "new")]


def test_outline_edge_cases(spark):
    from tideline.operators import geo as G
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.0, 0.5), (3, 5.0, 5.0), (4, None, 0.5)], "id int, lon double, lat double")
    square = [(0, 10, 0.0, 0.0), (0, 30, 1.0, 0.0), (0, 70, 1.0, 1.0), (0, 71, 0.0, 1.0)]
    hole = [(1, 1, 0.4, 0.4), (1, 2, 0.6, 0.4), (1, 3, 0.6, 0.6), (1, 4, 0.4, 0.6)]
    vertices = lambda rows: spark.createDataFrame(rows, "part int, seq int, lon double, lat double")
    assert [r["id"] for r in G.inside(points, vertices(square)).collect()] == [1]
    assert G.inside(points, vertices(square + hole)).count() == 0
    assert G.inside(points, vertices([(0, 1, 0.0, 0.5), (0, 2, 2.0, 0.5)])).count() == 0
    assert G.inside(points, vertices([])).count() == 0
