"""Rank statistics of many signals against the label, from counts of equal values."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tideline import settings as S
from tideline.functions.sums import mean, settle, value
from tideline.functions.tails import correlation_p, normal_p
from tideline.operators.scale import quantile_columns, running, staged_blocks


def numeric_columns(df: DataFrame, target: str = S.TARGET) -> list[str]:
    kinds = ("double", "float", "int", "bigint", "smallint", "tinyint")
    return [c for c, t in df.dtypes if c != target and (t in kinds or t.startswith("decimal"))]


def long_form(df: DataFrame, features: list[str], target: str = S.TARGET) -> DataFrame:
    """(feature, value, y) for every row and feature where both are present."""
    values = [F.col(f"`{c}`").cast("double").alias(c) for c in features]
    x = df.select(F.col(target).cast("double").alias("y"), *values)
    return (x.unpivot(["y"], features, "feature", "value")
            .filter(F.col("value").isNotNull() & F.col("y").isNotNull()))


def rank_table(df: DataFrame, features: list[str] | None = None, target: str = S.TARGET,
               parts: int | None = None) -> DataFrame:
    """Per feature and distinct value: rows, positives, and both counts up to the value.

    The label is 0/1. Equal values are merged before the shuffle, and the
    running counts are taken over blocks, so neither a popular value nor a long
    feature lands in one task.
    """
    features = features or numeric_columns(df, target)
    counts = long_form(df, features, target).groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").cast("bigint").alias("pos"))
    counts, block = staged_blocks(counts, ["feature", "value"], parts)
    return running(counts.withColumn("neg", F.col("n") - F.col("pos")), ["feature"], ["value"], block,
                   {"cn": (F.col("n"), "sum"), "cp": (F.col("pos"), "sum"), "cg": (F.col("neg"), "sum")},
                   totals=["cn", "cp", "cg"])


def _doubled_rank_gap() -> Column:
    """Twice the average rank of a value minus (rows + 1)."""
    return (2 * F.col("cn") - F.col("n") - F.col("cn_total")).cast("double")


def spearman(ranks: DataFrame, min_pairs: int = 30) -> DataFrame:
    """Rank correlation of every feature with the label, with p, largest first.

    The label has two tie groups, so its ranks are two constants per feature.
    """
    gx = _doubled_rank_gap()
    negs, poss = F.col("cg_total").cast("double"), F.col("cp_total").cast("double")
    # doubled centred label ranks: negatives lie at -positives, positives at +negatives
    cov = F.sum(gx * (F.col("pos") * negs - F.col("neg") * poss))
    var_x = F.sum(F.col("n") * gx * gx)
    var_y = F.max(negs * poss * poss + poss * negs * negs)
    pairs = F.max("cn_total")
    x = ranks.groupBy("feature").agg(pairs.alias("pairs"), cov.alias("_c"), var_x.alias("_x"),
                                     var_y.alias("_y"))
    x = x.filter(F.col("pairs") >= min_pairs)
    rho = F.when((F.col("_x") > 0) & (F.col("_y") > 0),
                 F.col("_c") / (F.sqrt("_x") * F.sqrt("_y")))
    return with_p(x.select("feature", "pairs", rho.alias("correlation")))


def pearson(df: DataFrame, features: list[str] | None = None, target: str = S.TARGET,
            min_pairs: int = 30) -> DataFrame:
    features = features or numeric_columns(df, target)
    x = long_form(df, features, target).groupBy("feature").agg(
        F.count(F.lit(1)).alias("pairs"), F.corr("value", "y").alias("correlation"))
    return with_p(x.filter(F.col("pairs") >= min_pairs))


def with_p(x: DataFrame, alpha: float = 0.05) -> DataFrame:
    p = correlation_p(F.col("correlation"), F.col("pairs").cast("double"))
    return (x.withColumn("p_value", p).withColumn("significant", F.col("p_value") < alpha)
            .orderBy(F.abs("correlation").desc_nulls_last(), "feature"))


def rank_sum_test(ranks: DataFrame, min_class: int = 10, alpha: float = 0.05) -> DataFrame:
    """Mann-Whitney U per feature, with medians and direction, smallest p first.

    p is the two-sided normal approximation with tie and continuity correction.
    """
    n1, n2, n = F.col("n1"), F.col("n2"), F.col("n1") + F.col("n2")
    mid_rank = (2 * F.col("cn") - F.col("n") + 1) / F.lit(2.0)
    x = ranks.groupBy("feature").agg(
        F.max("cp_total").cast("double").alias("n1"), F.max("cg_total").cast("double").alias("n2"),
        F.sum(F.col("pos") * mid_rank).alias("r1"),
        F.sum(F.pow(F.col("n").cast("double"), 3.0) - F.col("n")).alias("ties"),
        F.sum(value("value") * F.col("pos")).alias("s1"), F.sum(value("value") * F.col("neg")).alias("s2"),
        *quantile_columns("cp", "pos", "cp_total", "value", {"flood_median": 0.5}),
        *quantile_columns("cg", "neg", "cg_total", "value", {"no_flood_median": 0.5}))
    x = x.filter((n1 >= min_class) & (n2 >= min_class))
    u = F.col("r1") - n1 * (n1 + 1) / 2
    x = x.withColumn("mw_statistic", u)
    spread = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    top = F.greatest(F.col("mw_statistic"), n1 * n2 - F.col("mw_statistic"))
    x = x.withColumn("z", F.when(spread > 0, (top - n1 * n2 / 2 - 0.5) / spread).otherwise(F.lit(0.0)))
    x = x.withColumn("p_value", normal_p("z"))
    return x.select(
        "feature", "flood_median", "no_flood_median",
        (F.col("flood_median") - F.col("no_flood_median")).alias("delta_median"), "mw_statistic", "z",
        "p_value", (F.col("p_value") < alpha).alias("significant"),
        F.when(settle(F.col("s1") / n1) > settle(F.col("s2") / n2), "higher_on_flood").otherwise("lower_on_flood")
        .alias("effect_direction")).orderBy("p_value", F.col("z").desc(), "feature")


def importance(corr: DataFrame, test: DataFrame, top: int | None = None) -> DataFrame:
    """Correlation and test side by side, by absolute correlation; ``top`` keeps the first of them."""
    right = test.select("feature", "flood_median", "no_flood_median", "delta_median",
                        F.col("p_value").alias("p_value_mw"), F.col("significant").alias("significant_mw"),
                        "effect_direction")
    left = corr.select("feature", "correlation", F.col("p_value").alias("p_value_corr"),
                       F.col("significant").alias("significant_corr"))
    both = (left.join(right, "feature").withColumn("abs_corr", F.abs("correlation"))
            .orderBy(F.col("abs_corr").desc(), "feature"))
    return both if top is None else both.limit(top)


def correlation_matrix(df: DataFrame, features: list[str], method: str = "spearman") -> DataFrame:
    """(feature_a, feature_b, rho) of every pair, by Spark ML's distributed ranking.

    Only the matrix, as wide as the feature list, is on the driver.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation
    x = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in features]).na.drop()
    vectors = VectorAssembler(inputCols=features, outputCol="v").transform(x).select("v")
    m = Correlation.corr(vectors, "v", method).first()[0].toArray()
    rows = [(a, b, i, j, float(m[i, j])) for i, a in enumerate(features) for j, b in enumerate(features)]
    return df.sparkSession.createDataFrame(
        rows, "feature_a string, feature_b string, i int, j int, rho double")


def redundant_pairs(matrix: DataFrame, limit: float = 0.90) -> DataFrame:
    """Pairs above ``limit`` (positive only), each once, strongest first."""
    return (matrix.filter((F.col("i") < F.col("j")) & (F.col("rho") > limit))
            .select("feature_a", "feature_b", "rho").orderBy(F.col("rho").desc()))


def select_features(candidates: list[str], redundant: list[str], test: DataFrame,
                    alpha: float = 0.05) -> list[str]:
    """Candidates without the redundant ones and without those the test does not support."""
    weak = {r["feature"] for r in test.filter(F.col("p_value") >= alpha).select("feature").collect()}
    return [c for c in candidates if c not in redundant and c not in weak]


def describe(df: DataFrame, features: list[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per column."""
    x = (df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in features])
         .unpivot([], features, "feature", "value").filter(F.col("value").isNotNull()))
    counts = x.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    counts, block = staged_blocks(counts, ["feature", "value"])
    ranked = running(counts, ["feature"], ["value"], block,
                     {"cn": (F.col("n"), "sum")}, totals=["cn"])
    quartiles = ranked.groupBy("feature").agg(*quantile_columns(
        "cn", "n", "cn_total", "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}))
    moments = x.groupBy("feature").agg(
        F.count(F.lit(1)).alias("count"), mean("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    return moments.join(quartiles, "feature")


def group_medians(ranks: DataFrame) -> DataFrame:
    return ranks.groupBy("feature").agg(
        *quantile_columns("cp", "pos", "cp_total", "value", {"flood_median": 0.5}),
        *quantile_columns("cg", "neg", "cg_total", "value", {"no_flood_median": 0.5}),
        settle(F.sum(value("value") * F.col("pos")) / F.max("cp_total")).alias("flood_mean"),
        settle(F.sum(value("value") * F.col("neg")) / F.max("cg_total")).alias("no_flood_mean"))
