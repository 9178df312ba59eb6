"""Feature vectors, weights, learners, calibration and scoring on Spark ML."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tideline import settings as S
from tideline.operators.boosting import BoostedTrees, Boosting


def encode_zone(df: DataFrame, categories: list[str]) -> DataFrame:
    """0/1 column per zone but the first in name order. Categories are fixed at fit time."""
    rest = sorted(categories)[1:]
    return df.select("*", *[F.when(F.col("zone") == z, 1).otherwise(0).cast("int").alias(f"zone_{z}")
                            for z in rest])


def feature_names(columns: list[str], categories: list[str]) -> list[str]:
    """What the learner sees: every signal that is no key, label, score or excluded name."""
    skip = {"zone", "time_6h", "dq_score", S.TARGET, *S.EXCLUDED_FROM_MODEL}
    return [c for c in columns if c not in skip] + [f"zone_{z}" for z in sorted(categories)[1:]]


def align(df: DataFrame, names: list[str], keep: list[str] = ()) -> DataFrame:
    """Exactly ``names`` in that order; an absent or null signal is 0."""
    return df.select(*keep, *[
        (F.coalesce(F.col(f"`{n}`"), F.lit(0)) if n in df.columns else F.lit(0)).alias(n)
        for n in names])


# ---- vectors and weights ------------------------------------------------------------
def vectors(df: DataFrame, names: list[str], categories: list[str],
            keep: list[str] = ("zone", "time_6h"), label: str | None = S.TARGET) -> DataFrame:
    """keys, ``label`` and the dense feature vector."""
    from pyspark.ml.feature import VectorAssembler
    x = encode_zone(df, categories)
    cols = list(keep) + ([label] if label else [])
    safe = [f"f{i}" for i in range(len(names))]
    x = align(x, names, cols).toDF(*cols, *safe)
    out = VectorAssembler(inputCols=safe, outputCol="features").transform(x).select(*cols, "features")
    return out.withColumn(label, F.col(label).cast("double")) if label else out


def weighted(train: DataFrame, label: str = S.TARGET) -> DataFrame:
    """Positive rows weigh negatives / positives."""
    from tideline.operators.splits import class_weight
    w = class_weight(train, label).scalar()
    return train.withColumn("weight", F.when(F.col(label) == 1, w).otherwise(F.lit(1.0)))


def boosted(rounds: int = S.MODEL_ROUNDS, step: float = S.MODEL_STEP, depth: int = S.MODEL_DEPTH,
            min_rows: float = S.MODEL_MIN_ROWS, row_share: float = S.MODEL_ROW_SHARE,
            column_share: float | str = S.MODEL_COLUMN_SHARE, label: str = S.TARGET, weight: str | None = "weight",
            seed: int = S.MODEL_SEED, **more) -> Boosting:
    """The production learner; ``more`` are further settings of ``Boosting`` (penalties, bins, fit_rows)."""
    return Boosting(rounds, step, depth, min_rows, row_share, float(column_share), label=label, weight=weight, seed=seed,
                    **more)


def forest(trees: int = 100, depth: int = 10, label: str = S.TARGET, weight: str | None = "weight",
           seed: int = S.MODEL_SEED):
    from pyspark.ml.classification import RandomForestClassifier
    est = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)
    return est.setWeightCol(weight) if weight else est


def probability(model, df: DataFrame, out: str = "risk_score") -> DataFrame:
    """``df`` with the model's probability of label 1: boosted trees or a Spark ML classifier."""
    if isinstance(model, BoostedTrees):
        return model.score(df.drop(out), out)
    from pyspark.ml.functions import vector_to_array
    keep = [c for c in df.columns if c != out]
    x = model.transform(df.select(*keep))
    return x.select(*keep, vector_to_array("probability")[1].alias(out))


# ---- calibration -----------------------------------------------------------------------
def isotonic(df: DataFrame, score: str = "risk_score", label: str = S.TARGET):
    """Monotone map from score to rate; outside the seen scores it stays at the ends."""
    from pyspark.ml.regression import IsotonicRegression
    rates = df.groupBy(score).agg(F.avg(F.col(label).cast("double")).alias("_rate"),
                                  F.count(F.lit(1)).cast("double").alias("_rows"))
    return IsotonicRegression(featuresCol=score, labelCol="_rate", weightCol="_rows",
                              predictionCol="_calibrated").fit(rates)


def calibrated(model, df: DataFrame, score: str = "risk_score") -> DataFrame:
    cols = df.columns
    return model.transform(df).select(*[c for c in cols if c != score], F.col("_calibrated").alias(score))


class FoldedModel:
    """Boosted models of the folds, each with its own isotonic map; scores are averaged."""

    def __init__(self, members: list):
        self.members = members

    def transform_score(self, df: DataFrame, out: str = "risk_score") -> DataFrame:
        names = []
        for i, (model, iso) in enumerate(self.members):
            df = calibrated(iso, probability(model, df, f"_s{i}").withColumnRenamed(f"_s{i}", iso.getFeaturesCol()),
                            iso.getFeaturesCol()).withColumnRenamed(iso.getFeaturesCol(), f"_s{i}")
            names.append(f"_s{i}")
        total = F.lit(0.0)
        for n in names:
            total = total + F.col(n)
        return df.withColumn(out, total / F.lit(float(len(names)))).drop(*names)

    def save(self, spark, path: str) -> None:
        for i, (model, iso) in enumerate(self.members):
            model.save(spark, f"{path}/member={i}/learner")
            iso.write().overwrite().save(f"{path}/member={i}/isotonic")

    @classmethod
    def load(cls, spark, path: str, members: int) -> "FoldedModel":
        from pyspark.ml.regression import IsotonicRegressionModel
        return cls([(BoostedTrees.load(spark, f"{path}/member={i}/learner"),
                     IsotonicRegressionModel.load(f"{path}/member={i}/isotonic")) for i in range(members)])


def cross_fitted(train: DataFrame, learner: Boosting, k: int = 5, label: str = S.TARGET) -> FoldedModel:
    """Fit on k-1 folds, calibrate on the fold left out, for every fold; the models grow side by side."""
    from tideline.operators.splits import stratified_folds
    from tideline.session import cut_lineage
    folded = cut_lineage(stratified_folds(train, k, label))
    models = learner.fit_members(folded, [F.col("fold") != i for i in range(k)])
    return FoldedModel([(model, isotonic(probability(model, folded.filter(F.col("fold") == i)), label=label))
                        for i, model in enumerate(models)])


# ---- importance ---------------------------------------------------------------------------
def permutation_importance(model, df: DataFrame, names: list[str], label: str = S.TARGET,
                           seed: int = 42) -> DataFrame:
    """Drop in average precision when one feature is taken from another row.

    All features are scored in one job: every row meets the row half a round
    away in a seeded order and is repeated once per feature with that value replaced.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from tideline.operators.metrics import average_precision, curve
    from tideline.operators.splits import shuffled
    from tideline.session import cut_lineage
    x = df.withColumn("_v", vector_to_array("features")).select("zone", "time_6h", label, "_v")
    x = cut_lineage(shuffled(x, [], ["zone", "time_6h"], seed))
    rows = x.count()
    donor = x.select(F.pmod(F.col("draw") + rows // 2 + 1, F.lit(rows)).alias("draw"), F.col("_v").alias("_d"))
    paired = x.join(donor, "draw")
    which = F.explode(F.sequence(F.lit(-1), F.lit(len(names) - 1))).alias("_f")
    swapped = paired.select(label, "_v", "_d", which).withColumn(
        "features", array_to_vector(F.transform("_v", lambda v, i: F.when(
            i == F.col("_f"), F.element_at("_d", F.col("_f") + 1)).otherwise(v))))
    scored = probability(model, swapped.select(label, "_f", "features")).select(label, "_f", "risk_score")
    ap = average_precision(curve(scored, label=label, keys=["_f"]), keys=["_f"])
    base = ap.filter(F.col("_f") == -1).select("auc_pr").scalar()
    named = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_f") + 1)
    return (ap.withColumn("importance", base - F.col("auc_pr")).filter(F.col("_f") >= 0)
            .select(named.alias("feature"), "importance").orderBy(F.col("importance").desc(), "feature"))


def split_importance(model, names: list[str], spark) -> DataFrame:
    weights = model.featureImportances.toArray()
    return spark.createDataFrame([(n, float(w)) for n, w in zip(names, weights)],
                                 "feature string, importance double").orderBy(F.col("importance").desc())
