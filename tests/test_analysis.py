"""Metrics, statistics, reports against brute force."""
import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.functions import tails
from tideline.operators import metrics as M, report as P, splits as T, stats as Z


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(5)
    rows = [(round(rnd.random() ** 2, 2), int(rnd.random() < 0.2)) for _ in range(800)]
    return rows, spark.createDataFrame(rows, "risk_score double, is_flood int").cache()


@pytest.fixture(scope="module", params=["one block", "many blocks"])
def curve(request, spark, scored):
    return M.curve(scored[1], parts=1 if request.param == "one block" else 9)


def brute(rows):
    s, y = np.array([a for a, _ in rows]), np.array([b for _, b in rows])
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg))
    ap, before = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        f = s >= t
        r = (y[f] == 1).sum() / len(pos)
        ap += (r - before) * y[f].mean()
        before = r
    return auc, ap


def test_areas(scored, curve):
    auc, ap = brute(scored[0])
    r = M.ranking_metrics(curve).first()
    assert r["auc_roc"] == pytest.approx(auc, abs=1e-12) and r["auc_pr"] == pytest.approx(ap, abs=1e-12)
    assert M.roc_auc(curve).first()[0] == pytest.approx(auc) and M.average_precision(curve).first()[0] == pytest.approx(ap)


def test_best_threshold(scored, curve):
    s, y = np.array([a for a, _ in scored[0]]), np.array([b for _, b in scored[0]])
    best = None
    for t in sorted(set(s)):
        f = s >= t
        p, r = y[f].mean(), y[f].sum() / y.sum()
        v = 5 * p * r / (4 * p + r + 1e-9)
        if best is None or v > best[0]:
            best = (v, t)
    got = M.best_threshold(curve).first()
    assert got["threshold"] == best[1] and got["fbeta"] == pytest.approx(best[0])


def test_reliability_bins(scored, curve):
    s, y = np.array([a for a, _ in scored[0]]), np.array([b for _, b in scored[0]])
    inner = np.quantile(s, np.linspace(0, 1, 11))[1:-1]
    bins = np.searchsorted(inner, s)
    got = {r["bin"]: r for r in M.reliability(curve).collect()}
    assert set(got) == set(bins)
    for b in got:
        assert got[b]["mean_score"] == pytest.approx(s[bins == b].mean()) and got[b]["observed_rate"] == pytest.approx(y[bins == b].mean())


def test_average_precision_per_key(spark, scored):
    two = scored[1].withColumn("k", F.lit("a")).unionByName(
        scored[1].withColumn("risk_score", 1 - F.col("risk_score")).withColumn("k", F.lit("b")))
    got = {r["k"]: r["auc_pr"] for r in M.average_precision(M.curve(two, keys=["k"]), ["k"]).collect()}
    assert got["a"] == pytest.approx(brute(scored[0])[1])
    assert got["b"] == pytest.approx(brute([(1 - a, b) for a, b in scored[0]])[1])


def test_report_with_an_empty_class(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "is_flood int, flood_pred int")
    r = {x["class"]: x for x in M.classification_report(df).collect()}
    assert r["1"]["precision"] == 0.0 and r["1"]["f1"] == 0.0 and r["accuracy"]["f1"] == 0.5
    assert r["weighted avg"]["support"] == 2


# ---- statistics -----------------------------------------------------------------------
@pytest.mark.parametrize("r,n,p", [(0.361, 30, 0.05), (0.463, 30, 0.01), (0.632, 10, 0.05), (0.273, 52, 0.05), (0.0, 30, 1.0)])
def test_correlation_p_against_published_critical_values(r, n, p):
    assert tails.student_two_sided(r, n) == pytest.approx(p, rel=0.012)


def test_normal_tail():
    assert tails.normal_two_sided(1.959963985) == pytest.approx(0.05, abs=1e-9)
    assert tails.normal_two_sided(-0.5) == 1.0 and math.isnan(tails.student_two_sided(math.nan, 9))


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(11)
    rows = []
    for _ in range(300):
        y = int(rnd.random() < 0.3)
        rows.append((y, float(rnd.randint(0, 9) + 2 * y), rnd.gauss(0, 1) if rnd.random() < 0.9 else None, 0.0))
    return rows, spark.createDataFrame(rows, "is_flood int, a double, b double, flat double").cache()


def ranks(v):
    v = np.asarray(v)
    return np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])


@pytest.mark.parametrize("parts", [1, 7])
def test_rank_statistics(spark, table, parts):
    rows, df = table
    feats = ["a", "b", "flat"]
    rt = Z.rank_table(df, feats, parts=parts)
    rho = {r["feature"]: r for r in Z.spearman(rt).collect()}
    mw = {r["feature"]: r for r in Z.rank_sum_test(rt).collect()}
    for i, f in enumerate(feats[:2], 1):
        pairs = [(r[i], r[0]) for r in rows if r[i] is not None]
        x, y = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
        assert rho[f]["correlation"] == pytest.approx(np.corrcoef(ranks(x), ranks(y))[0, 1])
        u = (x[y == 1][:, None] > x[y == 0][None]).sum() + 0.5 * (x[y == 1][:, None] == x[y == 0][None]).sum()
        assert mw[f]["mw_statistic"] == pytest.approx(u)
        assert mw[f]["flood_median"] == pytest.approx(np.median(x[y == 1]))
        assert mw[f]["no_flood_median"] == pytest.approx(np.median(x[y == 0]))
    assert rho["flat"]["correlation"] is None and mw["flat"]["p_value"] == 1.0
    assert mw["a"]["significant"] and mw["a"]["effect_direction"] == "higher_on_flood"
    top = Z.importance(Z.spearman(rt), Z.rank_sum_test(rt), top=1).first()
    assert top["feature"] == "a" and Z.select_features(feats, ["b"], Z.rank_sum_test(rt)) == ["a"]


def test_spearman_matrix_and_pairs(spark, table):
    df = table[1].select("a", (F.col("a") * 2 + 1).alias("twice"), (-F.col("a")).alias("minus"))
    pairs = Z.redundant_pairs(Z.correlation_matrix(df, ["a", "twice", "minus"])).collect()
    assert [(r["feature_a"], r["feature_b"]) for r in pairs] == [("a", "twice")]


# ---- reports ---------------------------------------------------------------------------
def test_tick_rule(spark, slots):
    levels = ["LOW", "MEDIUM", "MEDIUM", "MEDIUM", "HIGH", "MEDIUM", "MEDIUM", "LOW"]
    x = slots([("Low Relief", n, v) for n, v in enumerate(levels)], ["risk_level"])
    assert sorted(r["slot"] for r in P.timeline_ticks(x).collect()) == [1, 3, 4, 6]


def test_tick_rule_against_the_loop(spark, slots):
    rnd = random.Random(2)
    levels = [rnd.choice(["LOW", "MEDIUM", "MEDIUM", "HIGH"]) for _ in range(400)]
    x = slots([("Z", 3 * n, v) for n, v in enumerate(levels)], ["risk_level"])
    want = []
    for i, v in enumerate(levels):
        if v == "HIGH" or (v == "MEDIUM" and (not want or want[-1] != i - 1)):
            want.append(i)
    assert sorted(r["slot"] for r in P.event_ticks(x).collect()) == want


def test_error_classes_at_the_edge_of_the_window(spark, slots):
    x = slots([("A", 0, 0, 1), ("A", 1, 0, 1), ("A", 2, 0, 1), ("A", 9, 1, 0), ("B", 9, 0, 1), ("A", 17, 0, 1), ("A", 18, 0, 1),
               ("A", 40, 1, 1), ("A", 60, 0, 0)], ["is_flood", "flood_pred"])
    got = {(r["zone"], (r["time_6h"] - dt.datetime(2024, 1, 1)).total_seconds() / 21600): r["status"]
           for r in P.error_class(x).collect()}
    assert got == {("A", 0): "FALSE ALARM", ("A", 1): "EARLY WARNING", ("A", 2): "EARLY WARNING", ("A", 9): "MISSED",
                   ("B", 9): "FALSE ALARM", ("A", 17): "EARLY WARNING", ("A", 18): "FALSE ALARM", ("A", 40): "DETECTED"}


def test_city_status_and_board(spark, slots):
    x = slots([("Low Relief", 0, "HIGH", 0.9), ("Low Relief", 1, "MEDIUM", 0.4), ("High Relief", 1, "MEDIUM", 0.5),
               ("Low Relief", 2, "MEDIUM", 0.4), ("Low Relief", 3, "LOW", 0.1)], ["risk_level", "risk_score"])
    got = [r["label"] for r in P.city_status(x).orderBy("time_6h").collect()]
    assert got == ["FLOOD ALERT", "CITY-WIDE ADVISORY", "LOCAL WATCH", "ALL CLEAR"]
    assert P.city_status(x.limit(0), []).first()["label"] == "UNKNOWN"
    board = {r["name"]: r for r in P.district_board(P.snapshot(x, 0)).collect()}
    assert len(board) == 9 and board["Sabail"]["risk_level"] == "HIGH" and board["Yasamal"]["risk_level"] == "LOW"
    assert P.next_alert(x).filter("zone = 'Low Relief'").first()["percent"] == 90


def test_alerts_mix_both_level_rules(spark, slots):
    x = slots([("A", 0, 0.6, "MEDIUM"), ("A", 1, 0.2, "LOW")], ["risk_score", "risk_level"])
    r = P.zone_alerts(x).first()
    assert r["risk_level"] == "HIGH" and r["high_risk_exposure_hours"] == 0 and "60.0%" in r["alert_message"]


def test_episodes(spark, slots):
    x = slots([("A", n, 0.7 + n / 100) for n in (0, 1, 2, 5, 7, 8)], ["risk_score"])
    got = sorted((r["slots"], r["duration_hours"]) for r in P.alert_episodes(x).collect())
    assert got == [(1, 6), (2, 12), (3, 18)]


def test_month_series_has_empty_months(spark):
    x = spark.createDataFrame([("Z", dt.datetime(2024, 1, 5), 1), ("Z", dt.datetime(2024, 4, 5), 0)],
                              "zone string, time_6h timestamp_ntz, is_flood int")
    got = [(r["month_end"].month, r["mean_is_flood"]) for r in P.month_series(x, "Z").orderBy("month_end").collect()]
    assert got == [(1, 1.0), (2, None), (3, None), (4, 0.0)]


# ---- draws ---------------------------------------------------------------------------------
def test_stratified_folds_are_even(spark, slots):
    x = slots([("A", n, int(n % 10 == 0)) for n in range(203)], ["is_flood"])
    sizes = T.stratified_folds(x).groupBy("is_flood", "fold").count().collect()
    for y in (0, 1):
        n = [r["count"] for r in sizes if r["is_flood"] == y]
        assert len(n) == 5 and max(n) - min(n) <= 1
    again = sorted(map(tuple, T.stratified_folds(x.repartition(7)).collect()))
    assert again == sorted(map(tuple, T.stratified_folds(x).collect()))


def test_archive_and_board_flows(spark, slots):
    from tideline.plans import flows
    x = slots([("Low Relief", 0, 1.26, 1, 0.7, 1, "HIGH"), ("Low Relief", 1, 0.0, 0, 0.4, 0, "MEDIUM"),
               ("High Relief", 1, 2.0, 0, 0.65, 1, "HIGH")],
              ["precipitation", "is_flood", "risk_score", "flood_pred", "risk_level"])
    rep = flows.archive_report(x, "Low Relief", "2024-01-01", "2024-02-01")
    assert tuple(rep["summary"].first()) == ("Low Relief", 1.3, 1, 1, 0)
    assert [r["status"] for r in rep["errors"].collect()] == ["DETECTED"]
    assert sorted(r["predicted"] for r in rep["chart"].collect()) == [40.0, 70.0]
    board = flows.city_board(x, 1)
    assert board["status"].first()["label"] == "FLOOD ALERT" and board["districts"].count() == 9
    assert board["next_alert"].first()["percent"] == 70 and board["ticks"].count() == 1


def test_kernel_density_equals_the_direct_sum(spark):
    import numpy as np
    rnd = np.random.default_rng(3)
    values = {0: rnd.normal(0, 1, 300), 1: np.concatenate([rnd.normal(5, 0.2, 80), [40.0]]), 2: np.array([7.0, 7.0]),
              3: np.array([1.0, 2.0])}
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [(0, None), (0, float("nan")), (None, 1.0)]
    df = spark.createDataFrame(rows, "is_flood int, risk_score double")
    got = M.kernel_density(df, points=60).orderBy("is_flood", "point").collect()
    assert [r["is_flood"] for r in got] == [0] * 60 + [1] * 60 + [3] * 60        # one value alone has no density
    for k in (0, 1, 3):
        v = values[k]
        h = v.std(ddof=1) * len(v) ** -0.2
        at = np.linspace(v.min() - 3 * h, v.max() + 3 * h, 60)
        direct = np.exp(-(((at[:, None] - v) / h) ** 2) / 2).sum(axis=1) / (len(v) * h * np.sqrt(2 * np.pi))
        mine = [r for r in got if r["is_flood"] == k]
        assert np.allclose([r["place"] for r in mine], at) and np.allclose([r["density"] for r in mine], direct, atol=1e-11)
    assert M.kernel_density(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        M.kernel_density(df, points=1)
