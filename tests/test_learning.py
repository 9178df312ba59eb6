"""Neighbours, balancing, learners, calibration: invariants and brute force."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.operators import learning as L, neighbours as N, sampling as B
from tideline.plans import training as W
from tideline.session import shared_folder


@pytest.fixture(scope="module")
def cloud(spark):
    rnd = random.Random(9)
    rows = [(i, [rnd.gauss(0, 1), rnd.gauss(0, 3), rnd.random()], int(i % 9 == 0)) for i in range(180)]
    rows += [(1000 + i, [5.0, 5.0, 5.0], 0) for i in range(70)]  # a hot group of equal points
    return rows, spark.createDataFrame(rows, "id bigint, vec array<double>, label int").cache()


@pytest.mark.parametrize("chunk,pivots", [(16, 8), (2048, 64), (7, 1)])
def test_nearest_is_exact_with_copies(cloud, chunk, pivots):
    rows, df = cloud
    got = {}
    for r in N.nearest(df, df, 4, chunk, pivots).collect():
        got.setdefault(r["id"], {})[r["place"]] = r["neighbour"]
    v, ids = np.array([r[1] for r in rows]), np.array([r[0] for r in rows])
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for i, a in enumerate(ids):
        assert [got[a][p] for p in (1, 2, 3, 4)] == list(ids[np.lexsort((ids, d[i]))[:4]])


@pytest.mark.parametrize("job", [lambda df: N.nearest(df, df, 3), B.smote_tomek])
def test_vectors_are_written_a_few_times(spark, monkeypatch, job):
    """Points without any order: no cell can be left out, and yet no vector goes out once for each cell."""
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist(), int(i % 4 == 0)) for i, v in enumerate(rng.normal(size=(1500, 24)))]
    seen, write = [], N.cut_lineage

    def counted(df):
        out = write(df)
        if "vec" in out.columns:
            seen.append(out.count())
        return out
    monkeypatch.setattr(N, "cut_lineage", counted)
    assert job(spark.createDataFrame(rows, "id bigint, vec array<double>, label int")).count() > 0
    assert sum(seen) <= 8 * 2250                     # 750 rows are added by smote


@pytest.mark.parametrize("shift,scale", [(0.0, 1.0), (1e6, 1.0), (0.0, 1e-30), (0.0, 1e100)])
def test_nearest_with_ties_repeated_ids_and_odd_vectors(spark, shift, scale):
    rng = random.Random(5)
    grid = [[shift + scale * rng.randrange(4) for _ in range(3)] for _ in range(150)]
    points = [(f"p{i % 130}", v) for i, v in enumerate(grid)]
    asked = [(f"p{i}", v) for i, v in enumerate(grid[::7])] + [("q", [shift + scale * 0.5] * 3), ("q", grid[0]), ("r", grid[3])]
    odd = [("m", [1.0, None, 2.0]), ("o", [math.nan] * 3), ("i", [math.inf] * 3)]
    frames = [spark.createDataFrame(x + odd, "id string, vec array<double>") for x in (asked, points)]
    got = {}
    for r in N.nearest(*frames, 4, 20, 5).collect():
        got.setdefault(r["id"], {})[r["place"]] = (r["distance"], r["neighbour"])
    with pytest.raises(Exception, match="a vector is null"):
        N.nearest(*[x.union(spark.createDataFrame([("n", None)], x.schema)) for x in frames], 4)
    want = {}
    for name, v in asked:
        want.setdefault(name, []).extend((float(np.sqrt(((np.array(v) - np.array(u)) ** 2).sum())), p) for p, u in points if p != name)
    assert {n: [x[p] for p in sorted(x)] for n, x in got.items()} == {n: sorted(x)[:4] for n, x in want.items()}


def test_fewer_points_than_neighbours(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id bigint, vec array<double>")
    assert sorted((r["id"], r["neighbour"]) for r in N.nearest(df, df, 5).collect()) == [(1, 2), (2, 1)]


def test_synthetic_rows_lie_between_minority_rows(cloud):
    rows, df = cloud
    out = B.smote(df).collect()
    assert sum(r["label"] == 1 for r in out) == sum(r["label"] == 0 for r in out)
    few = np.array([r[1] for r in rows if r[2] == 1])
    low, high = few.min(axis=0) - 1e-12, few.max(axis=0) + 1e-12
    made = np.array([r["vec"] for r in out if "#" in r["id"]])
    assert ((made >= low) & (made <= high)).all()
    assert sorted(map(str, B.smote(df).collect())) == sorted(map(str, out))


def test_adasyn_without_majority_neighbours_raises(spark):
    rows = [(i, [float(i) / 1000], 1) for i in range(10)] + [(100 + i, [1e6 + i], 0) for i in range(30)]
    with pytest.raises(ValueError):
        B.adasyn(spark.createDataFrame(rows, "id bigint, vec array<double>, label int"))


def test_tomek_links_and_cleaning(spark):
    rows = [(1, [0.0], 0), (2, [0.1], 1), (3, [5.0], 0), (4, [5.2], 0), (5, [9.0], 1)]
    df = spark.createDataFrame(rows, "id bigint, vec array<double>, label int")
    assert [tuple(r) for r in B.tomek_links(df).collect()] == [("1", "2")]
    assert sorted(r["id"] for r in B.drop_tomek(df).collect()) == ["2", "3", "4", "5"]
    assert sorted(r["id"] for r in B.drop_tomek(df, both=True).collect()) == ["3", "4", "5"]


def test_copies_and_draws(spark, slots):
    x = slots([("A", n, int(n < 7)) for n in range(100)], ["is_flood"])
    n = {r["is_flood"]: r["count"] for r in B.over_sample(x).groupBy("is_flood").count().collect()}
    assert n == {0: 93, 1: 93}
    per = [r["count"] for r in B.over_sample(x).filter("is_flood = 1").groupBy("time_6h").count().collect()]
    assert len(per) == 7 and max(per) - min(per) <= 1
    n = {r["is_flood"]: r["count"] for r in B.under_sample(x).groupBy("is_flood").count().collect()}
    assert n == {0: 7, 1: 7}
    with pytest.raises(ValueError):
        B.over_sample(x.filter("is_flood = 0"))


def test_over_sampling_of_a_single_class(spark, slots, tmp_path):
    from tideline.plans.learning_queries import learn
    x = slots([("A", n, n % 2) for n in range(10)], ["is_flood"])
    for only in (0, 1):
        one = x.filter(F.col("is_flood") == only)
        assert sorted(B.over_sample(one, one_class="keep").collect()) == sorted(one.collect())
        with pytest.raises(B.TooFewMinorityRows):
            B.over_sample(one)
    assert B.over_sample(x.limit(0), one_class="keep").count() == 0
    rows = spark.range(400).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber", "CAST(id % 50 + 1 AS double) AS l_quantity",
        "52000D AS l_extendedprice", "0.05D AS l_discount", "0.02D AS l_tax", "'A' AS l_returnflag",
        "CAST('1996-01-01' AS timestamp_ntz) + make_dt_interval(CAST(id / 100 AS int)) AS l_shipdate")
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")     # a hundred rows a slot: each has a quantity of 49
    got = learn.queries["M23_over_sampling"](spark, str(tmp_path))
    assert [(r["is_flood"], r["n"]) for r in got.collect()] == [(1, 4)]


def test_a_row_repeated_very_often(spark):
    x = spark.createDataFrame([(1,)], "id int")
    r = B._repeat(x, F.lit(10_000)).agg(F.count(F.lit(1)).alias("n"), F.min("copy").alias("a"), F.max("copy").alias("z"),
                                        F.count_distinct("copy").alias("d")).first()
    assert tuple(r) == (10_000, 0, 9_999, 10_000)


@pytest.fixture(scope="module")
def gold(spark):
    import datetime as dt
    from tideline import settings as S
    rnd = random.Random(4)
    rows = []
    for n in range(260):
        for z in ("High Relief", "Low Relief", "Moderate Relief"):
            v = [rnd.random() for _ in S.GOLD_FEATURES]
            y = int(v[1] + v[2] > 1.55)
            ints = {S.GOLD_FEATURES.index(c) for c in ("frozen_ground_flag", "is_winter")}
            v = [int(x > 0.5) if i in ints else x for i, x in enumerate(v)]
            rows.append((z, dt.datetime(2020, 1, 1) + dt.timedelta(hours=6 * n), *v, 1.0, y))
    kinds = ", ".join(f"{c} {'int' if c in ('frozen_ground_flag', 'is_winter') else 'double'}" for c in S.GOLD_FEATURES)
    return spark.createDataFrame(rows, f"zone string, time_6h timestamp_ntz, {kinds}, dq_score double, is_flood int").cache()


def test_train_save_load_predict(spark, gold):
    bundle = W.train(gold, rounds=6, folds=2, cv=False)
    assert len(bundle.features) == 27 and 0 <= bundle.threshold <= 1 and bundle.metrics["auc_roc"] > 0.7
    assert {n for n, _ in bundle.importance[:3]} & {"relative_humidity_2m", "precipitation"}
    path = shared_folder(spark, "model")
    with pytest.raises(LookupError):
        W.Bundle.load(spark, path)
    bundle.save(spark, path)
    back = W.Bundle.load(spark, path)
    key = lambda df: sorted((r["zone"], r["time_6h"], r["risk_score"], r["flood_pred"]) for r in df.collect())
    got = W.predict(gold, back)
    assert key(got) == key(W.predict(gold, bundle)) and got.count() == gold.count()
    assert got.filter((F.col("risk_score") < 0) | (F.col("risk_score") > 1)).count() == 0
    doc = W.metrics_document(back, spark).first()
    assert doc["n_train"] + doc["n_test"] == gold.count() and len(doc["importance_top10"]) == 10


def test_scoring_a_frame_without_a_zone(spark, gold):
    bundle = W.train(gold, rounds=3, folds=2, cv=False)
    full = {(r["zone"], r["time_6h"]): r["risk_score"] for r in W.predict(gold, bundle).collect()}
    part = W.predict(gold.filter("zone = 'Moderate Relief'"), bundle).collect()
    assert all(full[(r["zone"], r["time_6h"])] == r["risk_score"] for r in part)


def test_isotonic_is_monotone_and_clipped(spark):
    rnd = random.Random(1)
    df = spark.createDataFrame([(s, int(rnd.random() < s)) for s in [i / 200 for i in range(40, 160)]],
                               "risk_score double, is_flood int")
    iso = L.isotonic(df)
    probe = spark.createDataFrame([(i / 50,) for i in range(51)], "risk_score double").withColumn("k", F.col("risk_score"))
    got = [r["risk_score"] for r in L.calibrated(iso, probe).orderBy("k").collect()]
    assert got == sorted(got) and got[0] == got[9] and got[-1] == got[-9] and 0 <= got[0] <= got[-1] <= 1


def test_folds_without_positives_are_skipped(spark, gold):
    x, _, _ = W.prepare(gold)
    late = x.withColumn("is_flood", F.lit(0.0))
    assert W.fold_scores(late, lambda: L.boosted(rounds=2), k=2) == [None, None]
    r = W.mean_std([None, 0.2, 0.4, math.nan])
    assert (r["mean"], r["std"], r["folds"]) == (pytest.approx(0.3), pytest.approx(0.1), 2)


def test_search_marks_new_bests(spark):
    t = spark.createDataFrame([(1, 0.2, "a"), (2, 0.1, "b"), (3, 0.5, "c"), (4, 0.5, "d")], "trial int, f2 double, settings string")
    got = [(r["best"], r["is_best"]) for r in W.best_so_far(t).orderBy("trial").collect()]
    assert got == [(0.2, True), (0.2, False), (0.5, True), (0.5, False)]
    a, b = W.draw_settings(5), W.draw_settings(5)
    assert a == b and all(100 <= p["rounds"] <= 900 and 0.005 <= p["step"] <= 0.3 for p in a)


def test_forecast_run_with_a_stored_history(spark, gold):
    import datetime as dt
    from tideline import settings as S
    from tideline.plans import flows
    from tideline.sources.lake import Lake
    lake = Lake(spark, shared_folder(spark, "lake"))
    start, zones = dt.datetime(2020, 1, 1), ["High Relief", "Low Relief"]
    schema = "zone string, {} timestamp_ntz, " + ", ".join(f"{m} double" for m in S.MEASURES)
    slots = [(z, start + dt.timedelta(hours=6 * n), *[n % 9 / 9] * 8, 0.0) for z in zones for n in range(200)]
    lake.replace(spark.createDataFrame(slots, schema.format("time_6h") + ", river_discharge double"), "silver",
                 "weather_flood_6h")
    live = [(z, start + dt.timedelta(days=50, hours=h), *[h % 5 / 5] * 8) for z in zones for h in range(360)]
    out = flows.forecast_run(lake, spark.createDataFrame(live, schema.format("time")),
                             spark.createDataFrame([(z,) for z in zones], "zone string"),
                             F.lit("2020-02-20").cast("timestamp_ntz"), W.train(gold, rounds=2, folds=2, cv=False), "demo")
    assert out["forecast"].count() == 2 * 121 and {r["zone"] for r in out["alerts"].collect()} == set(zones)
    meta = out["metadata"].first()
    assert meta["forecast_start"] == dt.datetime(2020, 2, 20) and meta["model_used"] == "demo" and meta["horizon_days"] == 30
