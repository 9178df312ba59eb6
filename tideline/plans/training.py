"""Training, scoring, cross-validation, comparison and search flows."""
from __future__ import annotations

import json
import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline import settings as S
from tideline.functions import columns as C
from tideline.functions.columns import half_up
from tideline.operators import attribution as V, guided as G, learning as L, metrics as M, sampling as P, splits as T
from tideline.session import cut_lineage

KEYS = ["zone", "time_6h"]
MAX_ZONES = 1000   # each zone but one becomes a feature column


@dataclass
class Bundle:
    """A trained model with everything scoring needs."""
    model: L.FoldedModel
    features: list[str]
    categories: list[str]
    threshold: float
    metrics: dict = field(default_factory=dict)
    importance: list = field(default_factory=list)

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.save(spark, f"{path}/model")
        doc = {"features": self.features, "categories": self.categories, "threshold": self.threshold,
               "members": len(self.model.members), "metrics": self.metrics,
               "importance_top10": [n for n, _ in self.importance[:10]]}
        spark.createDataFrame([(json.dumps(doc),)], "value string").coalesce(1).write.mode(
            "overwrite").text(f"{path}/bundle")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Bundle":
        from tideline.sources.lake import Lake
        parent, _, name = path.rstrip("/").rpartition("/")
        if not Lake(spark, parent).exists(name, "bundle"):
            raise LookupError(f"no model at {path}")
        doc = json.loads(spark.read.text(f"{path}/bundle").first()[0])
        return cls(L.FoldedModel.load(spark, f"{path}/model", doc["members"]), doc["features"], doc["categories"],
                   doc["threshold"], doc["metrics"], [(n, None) for n in doc["importance_top10"]])


def metrics_document(bundle: Bundle, spark: SparkSession) -> DataFrame:
    """The metrics as one row, with the ten strongest features as an array."""
    doc = {**bundle.metrics, "threshold": bundle.threshold,
           "importance_top10": [n for n, _ in bundle.importance[:10]]}
    return spark.createDataFrame([tuple(doc.values())], ", ".join(
        f"{k} {'array<string>' if isinstance(v, list) else 'bigint' if isinstance(v, int) else 'double'}"
        for k, v in doc.items()))


def predict(features: DataFrame, bundle: Bundle) -> DataFrame:
    """Score, flag and right-closed level for every row, other columns kept."""
    x = L.vectors(features, bundle.features, bundle.categories, keep=features.columns, label=None)
    x = bundle.model.transform_score(x).drop("features")
    return (x.withColumn("flood_pred", C.flood_pred("risk_score", bundle.threshold))
            .withColumn("risk_level", C.risk_level_cut("risk_score")))


def store_predictions(lake, features: DataFrame, bundle: Bundle) -> DataFrame:
    out = predict(features, bundle).select(*S.PREDICTION_COLUMNS)
    return lake.replace(out, "gold", "predictions", ["zone"])


def prepare(gold: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
    """(vector frame, feature names, zone categories); rows without a label are left out."""
    if S.TARGET not in gold.columns:
        raise ValueError(f"column '{S.TARGET}' is missing")
    gold = gold.filter(F.col(S.TARGET).isNotNull())
    seen = gold.select("zone").distinct().limit(MAX_ZONES + 1).collect()
    if len(seen) > MAX_ZONES:
        raise ValueError(f"more than {MAX_ZONES} zones cannot be one-hot encoded")
    categories = sorted(r["zone"] for r in seen)
    names = L.feature_names(gold.columns, categories)
    return cut_lineage(L.vectors(gold, names, categories)), names, categories


def train(gold: DataFrame, rounds: int = S.MODEL_ROUNDS, folds: int = 5, calibrate: bool = True,
          cv: bool = True, **learner) -> Bundle:
    """Chronological 80/20 split, class weights, cross-fitted calibration, F2 threshold."""
    x, names, categories = prepare(gold)
    fit, test = T.chronological_split(x)
    fit = cut_lineage(L.weighted(fit))
    est = L.boosted(rounds=rounds, **learner)
    model = L.cross_fitted(fit, est, folds) if calibrate else None
    if model is None:
        plain = est.fit(fit)
        model = L.FoldedModel([(plain, L.isotonic(L.probability(plain, fit)))])
    scored = cut_lineage(model.transform_score(test).drop("features"))
    curve = M.curve(scored)
    best = M.best_threshold(curve).first()
    flagged = scored.withColumn("flood_pred", C.flood_pred("risk_score", best["threshold"]))
    areas, at = M.ranking_metrics(curve).first(), M.scores_at(flagged).first()
    sizes = {}
    for part, df in (("train", fit), ("test", test)):
        r = df.agg(F.count(F.lit(1)).alias("n"), F.avg(S.TARGET).alias("p")).first()
        sizes[f"n_{part}"], sizes[f"pos_rate_{part}"] = r["n"], r["p"]
    metrics = {"auc_roc": areas["auc_roc"], "auc_pr": areas["auc_pr"], "f1_score": at["f1"], **sizes}
    if cv:
        r = cross_validate(x, rounds=rounds, **learner)
        metrics["cv_auc_pr_mean"], metrics["cv_auc_pr_std"] = r["mean"], r["std"]
    first = model.members[0][0]
    ranked = [(r["feature"], r["importance"])
              for r in V.mean_attribution(V.attributions(first, fit, []), names).collect()]  # one row per feature
    return Bundle(model, names, categories, best["threshold"], metrics, ranked)


def fold_scores(x: DataFrame, est_of, k: int = 5, resample=None, score=None, workers: int = 2) -> list:
    """Score of every expanding-window fold; a fold without positives gives None."""
    folded = cut_lineage(T.expanding_folds(x, k))
    score = score or (lambda scored: M.average_precision(M.curve(scored)).first()["auc_pr"])
    sizes = {r["fold"]: r for r in T.fold_sizes(folded, k).collect()}

    def one(i):
        size = sizes.get(i)
        if size is None or size["train_pos"] < 2 or size["test_pos"] == 0:
            return None
        fit = folded.filter(F.col("fold") < i).drop("fold")
        fit = L.weighted(fit) if resample is None else resample(fit).withColumn("weight", F.lit(1.0))
        model = est_of().fit(fit)
        return score(L.probability(model, folded.filter(F.col("fold") == i)))

    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(one, range(1, k + 1)))


def mean_std(values: list) -> dict:
    seen = [v for v in values if v is not None and not math.isnan(v)]
    if not seen:
        return {"mean": float("nan"), "std": float("nan"), "folds": 0}
    m = sum(seen) / len(seen)
    return {"mean": m, "std": math.sqrt(sum((v - m) ** 2 for v in seen) / len(seen)), "folds": len(seen)}


def cross_validate(x: DataFrame, k: int = 5, rounds: int = S.MODEL_ROUNDS, resample=None, **learner) -> dict:
    return mean_std(fold_scores(x, lambda: L.boosted(rounds=rounds, **learner), k, resample))


def baseline_forest(gold: DataFrame, trees: int = 100, depth: int = 10, k: int = 5) -> dict[str, DataFrame]:
    """Balanced forest on a stratified holdout: scored test rows and importances."""
    x, names, _ = prepare(gold)
    parts = cut_lineage(T.stratified_holdout(x))
    fit = L.weighted(parts.filter(~F.col("is_test")).drop("is_test"))
    model = L.forest(trees, depth).fit(fit)
    test = L.probability(model, parts.filter("is_test").drop("is_test"))
    return {"scored": test, "importance": L.split_importance(model, names, gold.sparkSession)}


def forest_folds(gold: DataFrame, trees: int = 100, depth: int = 10, k: int = 5) -> list[dict]:
    """Stratified k-fold scores of the forest: ROC AUC and, at 0.5, F1, precision, recall."""
    x, _, _ = prepare(gold)
    folded = cut_lineage(T.stratified_folds(x, k))
    out = []
    for i in range(k):
        model = L.forest(trees, depth).fit(L.weighted(folded.filter(F.col("fold") != i)))
        scored = cut_lineage(L.probability(model, folded.filter(F.col("fold") == i)).drop("features"))
        at = M.scores_at(scored.withColumn("flood_pred", C.flood_pred("risk_score", 0.5))).first()
        out.append({"fold": i, "auc_roc": M.roc_auc(M.curve(scored)).first()["auc_roc"], "f1": at["f1"],
                    "precision": at["precision"], "recall": at["recall"]})
    return out


# ---- strategy comparison --------------------------------------------------------------
def _as_points(x: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    ident = F.concat_ws("|", "zone", F.col("time_6h").cast("string"))
    return x.select(ident.alias("id"), vector_to_array("features").alias("vec"),
                    F.col(S.TARGET).cast("int").alias("label"))


def _as_vectors(points: DataFrame) -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return points.select(F.col("id").alias("zone"), F.lit(None).cast("timestamp_ntz").alias("time_6h"),
                         F.col("label").cast("double").alias(S.TARGET), array_to_vector("vec").alias("features"))


STRATEGIES = {
    "none": lambda x: x,
    "over_sample": P.over_sample,
    "under_sample": P.under_sample,
    "smote": lambda x: _as_vectors(P.smote(_as_points(x))),
    "adasyn": lambda x: _as_vectors(P.adasyn(_as_points(x))),
    "tomek": lambda x: _as_vectors(P.drop_tomek(_as_points(x))),
    "smote_tomek": lambda x: _as_vectors(P.smote_tomek(_as_points(x))),
}


def evaluate(scored: DataFrame, threshold: float, name: str) -> DataFrame:
    """One result row: both areas and the flag scores, to four digits."""
    curve = M.curve(scored)
    areas = M.ranking_metrics(curve)
    at = M.scores_at(scored.withColumn("flood_pred", C.flood_pred("risk_score", threshold)))
    four = lambda c: half_up(c, 4).alias(c)
    return at.select(
        F.lit(name).alias("strategy"), half_up(areas.select("auc_roc").scalar(), 4).alias("auc_roc"),
        half_up(areas.select("auc_pr").scalar(), 4).alias("auc_pr"), four("f1"), four("f2"),
        four("precision"), four("recall"), half_up(F.lit(float(threshold)), 4).alias("threshold"))


def compare_strategies(gold: DataFrame, names: list[str] | None = None, rounds: int = 500, **learner) -> DataFrame:
    """Resample only the fit rows, tune the threshold on validation, score the test rows."""
    x, _, _ = prepare(gold)
    train_rows, test = T.chronological_split(x)
    parts = cut_lineage(T.fit_validation(cut_lineage(train_rows)))
    fit, val = parts.filter(F.col("segment") == 0).drop("segment"), parts.filter(F.col("segment") == 1)
    out = None
    for name in names or list(STRATEGIES):
        try:
            rows = cut_lineage(STRATEGIES[name](fit))
        except P.TooFewMinorityRows:
            if name == "adasyn":
                continue  # needs minority rows near the majority; left out without them
            raise
        model = L.boosted(rounds=rounds, weight=None, **learner).fit(rows)
        best = M.best_threshold(M.curve(L.probability(model, val)), floor=0.05).first()
        scored = cut_lineage(L.probability(model, test).drop("features"))
        row = evaluate(scored, best["threshold"], name)
        out = row if out is None else out.unionByName(row)
    return out.orderBy(F.col("recall").desc())


def strategy_cv(gold: DataFrame, names: list[str] | None = None, rounds: int = 500, k: int = 5, **learner) -> DataFrame:
    """Mean and deviation of average precision per strategy over expanding folds."""
    x, _, _ = prepare(gold)
    train_rows, _ = T.chronological_split(x)
    train_rows = cut_lineage(train_rows)
    rows = []
    for name in names or list(STRATEGIES):
        try:
            r = mean_std(fold_scores(train_rows, lambda: L.boosted(rounds=rounds, **learner), k,
                                     resample=STRATEGIES[name]))
        except P.TooFewMinorityRows:
            if name == "adasyn":
                continue
            raise
        rows.append((name, r["mean"], r["std"], r["folds"]))
    return gold.sparkSession.createDataFrame(rows, "strategy string, cv_mean double, cv_std double, folds int")


def results_table(strategies: DataFrame, cv: DataFrame) -> DataFrame:
    """Test results with the cross-validated value of the same strategy, by recall."""
    return (strategies.join(cv.select("strategy", half_up("cv_mean", 4).alias("cv_auc_pr")), "strategy", "left")
            .orderBy(F.col("recall").desc(), "strategy"))


# ---- search --------------------------------------------------------------------------------
def search_space(max_rounds: int = 900, max_depth: int = 10) -> dict[str, G.Range]:
    """The searched settings of the learner."""
    return {"rounds": G.Range("int", min(100, max_rounds), max_rounds), "step": G.Range("log", 0.005, 0.3),
            "depth": G.Range("int", min(3, max_depth), max_depth), "min_rows": G.Range("int", 1, 15),
            "row_share": G.Range("float", 0.4, 1.0), "column_share": G.Range("float", 0.4, 1.0),
            "l1": G.Range("log", 1e-8, 20.0), "l2": G.Range("log", 1e-8, 20.0), "gamma": G.Range("float", 0.0, 5.0)}


def draw_settings(trials: int, seed: int = 42, max_rounds: int = 900) -> list[dict]:
    """Seeded plain draws from the searched ranges."""
    rnd = random.Random(seed)
    return [{name: r.value(rnd.random()) for name, r in search_space(max_rounds).items()} for _ in range(trials)]


def best_fold_f2(scored: DataFrame) -> float:
    """F2 at the fold's own best threshold, with the precision floor."""
    scored = cut_lineage(scored.select("zone", "time_6h", S.TARGET, "risk_score"))
    best = M.best_threshold(M.curve(scored), floor=0.05).first()
    flagged = scored.withColumn("flood_pred", C.flood_pred("risk_score", best["threshold"]))
    return M.scores_at(flagged).first()["f2"]


def search(gold: DataFrame, trials: int = 60, k: int = 5, seed: int = 42, workers: int = 2,
           max_rounds: int = 900, max_depth: int = 10, start: int = 10, folder: str | None = None) -> DataFrame:
    """Guided trials with their mean fold F2 and the best value so far.

    Every trial over-samples the training part of each fold. Trials and folds are submitted side by side; Spark shares
    the cluster between them. With a ``folder`` a search that was stopped goes on after its finished trials.
    """
    x, _, _ = prepare(gold)
    train_rows, _ = T.chronological_split(x)
    train_rows = cut_lineage(train_rows)

    def run(settings: dict) -> float:
        scores = fold_scores(train_rows, lambda: L.boosted(**settings, weight=None), k, resample=P.over_sample,
                             score=best_fold_f2)
        seen = [s for s in scores if s is not None]
        return sum(seen) / len(seen) if seen else 0.0

    tried = G.guided_search(gold.sparkSession, search_space(max_rounds, max_depth), run, trials, seed, workers, start, folder)
    return best_so_far(tried.withColumnRenamed("value", "f2"))


def best_settings(trials: DataFrame) -> dict | None:
    """Settings of the best trial, the earliest of equals; None without a trial."""
    row = trials.orderBy(F.col("f2").desc_nulls_last(), "trial").first()
    return None if row is None else json.loads(row["settings"])


def compare_tuned(gold: DataFrame, settings: dict, rounds: int = 500, **learner) -> DataFrame:
    """Base and searched settings on the same over-sampled fit rows, and their difference.

    Thresholds are tuned on the validation rows, all scores are those of the test rows.
    """
    x, _, _ = prepare(gold)
    train_rows, test = T.chronological_split(x)
    parts = cut_lineage(T.fit_validation(cut_lineage(train_rows)))
    rows = cut_lineage(P.over_sample(parts.filter(F.col("segment") == 0).drop("segment")))
    val = parts.filter(F.col("segment") == 1)
    out = None
    for name, chosen in (("base", {"rounds": rounds, **learner}), ("tuned", settings)):
        model = L.boosted(**chosen, weight=None).fit(rows)
        best = M.best_threshold(M.curve(L.probability(model, val)), floor=0.05).first()
        row = evaluate(cut_lineage(L.probability(model, test).drop("features")), best["threshold"], name)
        out = row if out is None else out.unionByName(row)
    return M.with_delta(out, "strategy", "tuned", "base", "tuned - base")


def best_so_far(trials: DataFrame) -> DataFrame:
    """Running best over the trial number; a search has a few dozen rows."""
    from pyspark.sql import Window
    seen = Window.partitionBy(F.lit(0)).orderBy("trial").rowsBetween(Window.unboundedPreceding, 0)
    return trials.withColumn("best", F.max("f2").over(seen)).withColumn(
        "is_best", (F.col("f2") == F.col("best"))
        & (F.coalesce(F.max("f2").over(seen.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1.0)) < F.col("f2")))


# ---- calibration comparison -----------------------------------------------------------------
def compare_calibration(gold: DataFrame, rounds: int = 500, folds: int = 5, **learner) -> DataFrame:
    """A: cross-fitted on over-sampled rows; B: raw; C: isotonic on held-out real rows."""
    x, _, _ = prepare(gold)
    fit, held, test = (cut_lineage(p) for p in T.three_way_split(x))
    rows = cut_lineage(P.over_sample(fit))
    est = L.boosted(rounds=rounds, weight=None, **learner)
    a = L.cross_fitted(rows, est, folds)
    b = est.fit(rows)
    iso = L.isotonic(L.probability(b, held))
    ways = {"A cross-fitted": a.transform_score, "B raw": lambda d: L.probability(b, d),
            "C held-out isotonic": lambda d: L.calibrated(iso, L.probability(b, d))}
    out = None
    for name, way in ways.items():
        best = M.best_threshold(M.curve(way(held)), floor=0.05).first()
        scored = cut_lineage(way(test).drop("features"))
        row = evaluate(scored, best["threshold"], name).withColumn(
            "brier", half_up(M.brier(scored).scalar(), 4))
        counts = M.confusion(scored.withColumn("flood_pred", C.flood_pred("risk_score", best["threshold"])))
        row = row.select("*", *[counts.select(c).scalar().alias(c) for c in ("tp", "fp", "fn")])
        out = row if out is None else out.unionByName(row)
    return M.with_delta(out, "strategy", "C held-out isotonic", "A cross-fitted", "C - A")


def optimise(gold: DataFrame, strategies: list[str] | None = None, rounds: int = 500, trials: int = 60, k: int = 5,
             **learner) -> dict[str, DataFrame]:
    """The experiment pack: balancing strategies with folds, search, the tuned model against the base, calibration."""
    found = cut_lineage(search(gold, trials, k, max_rounds=max(rounds, 2)))
    pack = {
        "strategies": results_table(compare_strategies(gold, strategies, rounds, **learner),
                                    strategy_cv(gold, strategies, rounds, k, **learner)),
        "search": found,
        "calibration": compare_calibration(gold, rounds, k, **learner),
    }
    best = best_settings(found)
    if best is not None:
        pack["tuned"] = compare_tuned(gold, best, rounds, **learner)
    return pack
