"""Queries around learning. Learners have no SQL twin; draws and neighbours do."""
from __future__ import annotations

from pyspark.sql import functions as F

from tideline import settings as S
from tideline.operators import attribution as V, features as X, isotonic as I, learning as L, neighbours as N, sampling as P, splits as T
from tideline.plans import oracle as O, training as W
from tideline.plans.core_queries import h_silver
from tideline.plans.registry import Registry
from tideline.session import cut_lineage, shared_folder
from tideline.sources import adapters as A
from tideline.sources.lake import Lake

learn = Registry()
SEARCH = {"trials": 6, "start": 2, "max_rounds": 100, "max_depth": 4}      # in a query; the library searches 60 wider trials (README)
PLAIN = ["none", "over_sample", "under_sample"]                # in a query, without the strategies that need neighbours
_stages: dict = {}


def h_gold(spark, d):
    """The gold table, written once for each session and folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _stages:
        _stages[key] = cut_lineage(X.gold(h_silver(spark, d)))
    return _stages[key]


def learned(spark, d):
    """(production model, fit rows, test rows, feature names, zone categories)."""
    x, names, categories = W.prepare(h_gold(spark, d))
    fit, test = T.chronological_split(x)
    return L.boosted().fit(L.weighted(fit)), fit, test, names, categories


def points(spark, d):
    return A.table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"),
        (F.col("label") == 0).cast("int").alias("label"))


# ---- learners -------------------------------------------------------------------------
@learn.add("M7_boosted_trees")
def _(spark, d):
    model, _, test, *_ = learned(spark, d)
    return L.probability(model, test).drop("features")


@learn.add("M8_forest_baseline")
def _(spark, d):
    return W.baseline_forest(h_gold(spark, d))["scored"].drop("features")


@learn.add("M8_forest_importance")
def _(spark, d):
    return W.baseline_forest(h_gold(spark, d))["importance"]


@learn.add("M9_cross_fitted_calibration")
def _(spark, d):
    x, _, _ = W.prepare(h_gold(spark, d))
    fit, test = T.chronological_split(x)
    model = L.cross_fitted(L.weighted(fit), L.boosted())
    return model.transform_score(test).drop("features")


@learn.add("M10_isotonic_calibration")
def _(spark, d):
    rows = A.scored(spark, d)
    held, test = T.chronological_split(rows, test_frac=0.5)
    return L.calibrated(L.isotonic(held), test.select("zone", "time_6h", "is_flood", "risk_score"))


@learn.add("M10_parallel_isotonic")
def _(spark, d):
    rows = A.scored(spark, d)
    return I.fit(rows).select("low", "high", "rate", "weight")


@learn.add("M10_isotonic_rates", O.sql(
    # the rate of a score is the greatest, over starts up to it, of the least mean up to an end behind it
    "SELECT s.risk_score, round(MAX(m.least), 9) AS rate FROM each s JOIN (SELECT e.risk_score AS till, a.risk_score AS "
    "since, MIN(e.mean) OVER (PARTITION BY a.risk_score ORDER BY e.risk_score DESC) AS least FROM each a JOIN means e ON "
    "e.since = a.risk_score) m ON m.since <= s.risk_score AND m.till = s.risk_score GROUP BY 1", "scored", extra={
        "each": "SELECT round(risk_score, 2) AS risk_score, SUM(is_flood) AS y, COUNT(*) AS w FROM scored GROUP BY 1",
        "means": "SELECT a.risk_score AS since, b.risk_score, SUM(b.y) OVER up / SUM(b.w) OVER up AS mean FROM each a JOIN "
                 "each b ON b.risk_score >= a.risk_score WINDOW up AS (PARTITION BY a.risk_score ORDER BY b.risk_score)"}))
def _(spark, d):
    rows = A.scored(spark, d).withColumn("risk_score", F.round("risk_score", 2))
    scores = rows.select("risk_score").distinct()
    return I.apply(I.fit(rows), scores).select("risk_score", F.round("rate", 9).alias("rate"))


@learn.add("C5_train_and_score")
def _(spark, d):
    gold = h_gold(spark, d)
    bundle = W.train(gold)
    path = shared_folder(spark, "model")
    bundle.save(spark, path)
    return W.predict(gold, W.Bundle.load(spark, path)).select(*S.PREDICTION_COLUMNS)


@learn.add("C6_stored_predictions")
def _(spark, d):
    gold = h_gold(spark, d)
    lake = Lake(spark, shared_folder(spark, "lake"))
    return W.store_predictions(lake, gold, W.train(gold))


@learn.add("C14_experiment_pack")
def _(spark, d):
    pack = W.optimise(h_gold(spark, d), PLAIN[2:], rounds=SEARCH["max_rounds"], trials=1)
    return pack["strategies"].select("strategy", "auc_roc", "auc_pr", "recall").unionByName(
        pack["calibration"].select("strategy", "auc_roc", "auc_pr", "recall")).unionByName(
        pack["tuned"].select("strategy", "auc_roc", "auc_pr", "recall"))


@learn.add("M11_batch_scoring")
def _(spark, d):
    plain, fit, _, names, categories = learned(spark, d)
    bundle = W.Bundle(L.FoldedModel([(plain, L.isotonic(L.probability(plain, fit)))]), names, categories, 0.4)
    return W.predict(X.gold(h_silver(spark, d)), bundle).select(
        "zone", "time_6h", "risk_score", "flood_pred", "risk_level")


@learn.add("S11_metrics_document")
def _(spark, d):
    return W.metrics_document(W.train(h_gold(spark, d)), spark)


@learn.add("M22_fold_average_precision")
def _(spark, d):
    x, _, _ = W.prepare(h_gold(spark, d))
    scores = W.fold_scores(x, L.boosted)
    return spark.createDataFrame(list(enumerate(scores, 1)), "fold int, auc_pr double")


@learn.add("M31_permutation_importance")
def _(spark, d):
    model, _, test, names, _ = learned(spark, d)
    return L.permutation_importance(model, test, names)


@learn.add("M31_tree_attribution")
def _(spark, d):
    model, fit, _, names, _ = learned(spark, d)
    return V.mean_attribution(V.attributions(model, fit, []), names)


@learn.add("M32_attribution_dependence")
def _(spark, d):
    model, _, test, names, _ = learned(spark, d)
    shares = cut_lineage(V.attributions(model, test, ["zone", "time_6h"]))
    top = [r["feature"] for r in V.mean_attribution(shares, names).limit(4).collect()]
    return V.dependence(shares, names, top, ["zone", "time_6h"])


@learn.add("M29_strategy_comparison")
def _(spark, d):
    return W.compare_strategies(h_gold(spark, d), PLAIN)


@learn.add("K7_J12_results_by_recall")
def _(spark, d):
    gold = h_gold(spark, d)
    return W.results_table(W.compare_strategies(gold, PLAIN), W.strategy_cv(gold, PLAIN))


@learn.add("M30_W7_search")
def _(spark, d):
    return W.search(h_gold(spark, d), **SEARCH)


@learn.add("U4_tuned_against_base")
def _(spark, d):
    gold = h_gold(spark, d)
    return W.compare_tuned(gold, W.best_settings(W.search(gold, **SEARCH)))


@learn.add("M33_U4_calibration_comparison")
def _(spark, d):
    return W.compare_calibration(h_gold(spark, d))


@learn.add("M8_forest_fold_scores")
def _(spark, d):
    scores = W.forest_folds(h_gold(spark, d))
    return spark.createDataFrame([tuple(r.values()) for r in scores],
                                 "fold int, auc_roc double, f1 double, precision double, recall double")


# ---- draws and neighbours ------------------------------------------------------------------
_BIG, _FEW = "COUNT(*) FILTER (is_flood = 0)", "COUNT(*) FILTER (is_flood = 1)"


@learn.add("M23_over_sampling", O.sql(
    f"SELECT b AS n, c AS is_flood FROM (SELECT greatest({_BIG}, {_FEW}) AS b FROM scored) q, (SELECT unnest([0, 1]) AS c) z", "scored"))
def _(spark, d):
    # where every slot is of one class there is nothing to repeat; the counts then show that class alone
    return P.over_sample(A.scored(spark, d), one_class="keep").groupBy("is_flood").agg(F.count(F.lit(1)).alias("n"))


@learn.add("M24_under_sampling", O.sql(
    f"SELECT b AS n, c AS is_flood FROM (SELECT least({_BIG}, {_FEW}) AS b FROM scored) q, (SELECT unnest([0, 1]) AS c) z", "scored"))
def _(spark, d):
    return P.under_sample(A.scored(spark, d)).groupBy("is_flood").agg(F.count(F.lit(1)).alias("n"))


_PTS = {
    "pt": "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, CASE WHEN label = 0 THEN 1 ELSE 0 END AS y FROM embeddings",
    "nb": "SELECT a.id, a.y, b.id AS neighbour, b.y AS yb, row_number() OVER (PARTITION BY a.id ORDER BY "
          "list_distance(a.v, b.v), b.id) AS place FROM pt a JOIN pt b ON a.id <> b.id",
}


@learn.add("M25_nearest_neighbours", O.sql("SELECT id, neighbour, place FROM nb WHERE place <= 5", extra=_PTS))
def _(spark, d):
    x = points(spark, d)
    return N.nearest(x, x, 5).select("id", "neighbour", "place")


@learn.add("M25_smote_counts", O.sql(
    "SELECT c AS label, (SELECT COUNT(*) FROM pt WHERE y = 0) AS n FROM (SELECT unnest([0, 1]) AS c) z", extra=_PTS))
def _(spark, d):
    return P.smote(points(spark, d)).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@learn.add("M26_adasyn_rows")
def _(spark, d):
    return P.adasyn(points(spark, d))


_LINKS = ("SELECT a.id, a.neighbour FROM nb a JOIN nb b ON b.id = a.neighbour AND b.neighbour = a.id WHERE a.place = 1 AND "
          "b.place = 1 AND a.y = 0 AND a.yb = 1")


@learn.add("M27_tomek_links", O.sql(f"SELECT CAST(id AS VARCHAR) AS id, CAST(neighbour AS VARCHAR) AS neighbour FROM ({_LINKS}) q",
                                    extra=_PTS))
def _(spark, d):
    return P.tomek_links(points(spark, d))


@learn.add("M27_without_tomek", O.sql(
    f"SELECT CAST(id AS VARCHAR) AS id, y AS label FROM pt WHERE id NOT IN (SELECT id FROM ({_LINKS}) q)", extra=_PTS))
def _(spark, d):
    return P.drop_tomek(points(spark, d)).select("id", "label")


@learn.add("M28_smote_tomek")
def _(spark, d):
    return P.smote_tomek(points(spark, d))
