"""Checked queries: correlations, rank tests, describe, selection."""
from __future__ import annotations

from pyspark.sql import functions as F

from tideline import settings as S
from tideline.functions import columns as C
from tideline.operators import features as X, quality as Q, report as P, stats as T
from tideline.plans import oracle as O
from tideline.plans.core_queries import h_silver
from tideline.plans.registry import Registry
from tideline.session import cut_lineage
from tideline.sources import adapters as A

stat = Registry()
FEATURES = S.MEASURES


def labelled(spark, d):
    return X.base(h_silver(spark, d))


_LONG = {"lf": " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, is_flood AS y FROM h_base" for c in FEATURES)}
_RANKED = {**_LONG,
           "rk": "SELECT *, rank() OVER (PARTITION BY feature ORDER BY v) + (COUNT(*) OVER (PARTITION BY feature, v) - 1) "
                 "/ 2e0 AS rx, rank() OVER (PARTITION BY feature ORDER BY y) + (COUNT(*) OVER (PARTITION BY feature, y) "
                 "- 1) / 2e0 AS ry FROM lf",
           "rho": "SELECT feature, COUNT(*) AS pairs, corr(rx, ry) AS r FROM rk GROUP BY 1"}


@stat.add("T1s_spearman_with_label", O.sql(
    "SELECT feature, pairs, round(r, 9) AS correlation FROM rho", "h_base", extra=_RANKED))
def _(spark, d):
    return T.spearman(T.rank_table(labelled(spark, d), FEATURES)).select(
        "feature", "pairs", F.round("correlation", 9).alias("correlation"))


@stat.add("T2s_pearson_with_label", O.sql(
    "SELECT feature, COUNT(*) AS pairs, round(corr(v, y), 9) AS correlation FROM lf GROUP BY 1", "h_base", extra=_LONG))
def _(spark, d):
    return T.pearson(labelled(spark, d), FEATURES).select(
        "feature", "pairs", F.round("correlation", 9).alias("correlation"))


@stat.add("T1s_p_values")
def _(spark, d):
    return T.spearman(T.rank_table(labelled(spark, d), FEATURES))


_U = {**_RANKED,
      "md": "SELECT feature, quantile_cont(v, 0.5) FILTER (y = 1) AS flood_median, quantile_cont(v, 0.5) FILTER (y = 0) AS "
            f"no_flood_median, {O.mean('CASE WHEN y = 1 THEN v END')} AS flood_mean, "
            f"{O.mean('CASE WHEN y = 0 THEN v END')} AS no_flood_mean FROM lf GROUP BY 1",
      "u": "SELECT feature, SUM(rx) FILTER (y = 1) - MAX(p) * (MAX(p) + 1) / 2e0 AS mw FROM (SELECT *, SUM(y) OVER "
           "(PARTITION BY feature) AS p FROM rk) q GROUP BY 1",
      "tie": "SELECT feature, SUM(c * c * c - c) AS ties FROM (SELECT feature, v, CAST(COUNT(*) AS DOUBLE) AS c FROM lf "
             "GROUP BY 1, 2) q GROUP BY 1",
      "rt": "SELECT u.feature, mw, CASE WHEN s > 0 THEN (greatest(mw, n1 * n2 - mw) - n1 * n2 / 2 - 0.5e0) / s ELSE 0e0 END "
            "AS z FROM u JOIN (SELECT c.feature, n1, n2, sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - "
            "1)))) AS s FROM (SELECT feature, CAST(COUNT(*) FILTER (y = 1) AS DOUBLE) AS n1, CAST(COUNT(*) FILTER (y = 0) AS "
            "DOUBLE) AS n2 FROM lf GROUP BY 1) c JOIN tie ON tie.feature = c.feature) w ON w.feature = u.feature"}


@stat.add("T5s_mann_whitney", O.sql(
    "SELECT u.feature, mw AS mw_statistic, round(flood_median, 9) AS flood_median, round(no_flood_median, 9) AS "
    "no_flood_median, round(flood_median - no_flood_median, 9) AS delta_median, CASE WHEN flood_mean > no_flood_mean THEN "
    "'higher_on_flood' ELSE 'lower_on_flood' END AS effect_direction FROM u JOIN md ON md.feature = u.feature",
    "h_base", extra=_U))
def _(spark, d):
    x = T.rank_sum_test(T.rank_table(labelled(spark, d), FEATURES))
    return x.select("feature", "mw_statistic", *[F.round(c, 9).alias(c) for c in (
        "flood_median", "no_flood_median", "delta_median")], "effect_direction")


@stat.add("T5s_p_values")
def _(spark, d):
    return T.rank_sum_test(T.rank_table(labelled(spark, d), FEATURES))


_SURE = 1.959963984540054e0   # two-sided 5 % point of the normal distribution


@stat.add("T5s_rank_test_significance", O.sql(
    f"SELECT feature, round(z, 6) AS z, z > {_SURE} AS significant FROM rt", "h_base", extra=_U))
def _(spark, d):
    return T.rank_sum_test(T.rank_table(labelled(spark, d), FEATURES)).select(
        "feature", F.round("z", 6).alias("z"), "significant")


@stat.add("T7s_kept_features", O.sql(
    f"SELECT feature FROM rt WHERE z > {_SURE} AND feature NOT IN ("
    + ", ".join(f"'{c}'" for c in S.EXCLUDED_FROM_MODEL) + ")", "h_base", extra=_U))
def _(spark, d):
    test = cut_lineage(T.rank_sum_test(T.rank_table(labelled(spark, d), FEATURES)))
    kept = T.select_features(FEATURES, S.EXCLUDED_FROM_MODEL, test)
    return test.filter(F.col("feature").isin(kept)).select("feature")


@stat.add("A17_group_medians", O.sql(
    "SELECT feature, round(flood_median, 9) AS flood_median, round(no_flood_median, 9) AS no_flood_median, "
    "round(flood_mean, 9) AS flood_mean, round(no_flood_mean, 9) AS no_flood_mean FROM md", "h_base", extra=_U))
def _(spark, d):
    x = T.group_medians(T.rank_table(labelled(spark, d), FEATURES))
    return x.select("feature", *[F.round(c, 9).alias(c) for c in x.columns if c != "feature"])


@stat.add("J10_importance_merge", O.sql(
    "SELECT r.feature, round(r, 9) AS correlation, round(abs(r), 9) AS abs_corr, round(flood_median, 9) AS flood_median FROM "
    "rho r JOIN md ON md.feature = r.feature", "h_base", extra=_U))
def _(spark, d):
    ranks = T.rank_table(labelled(spark, d), FEATURES)
    return T.importance(T.spearman(ranks), T.rank_sum_test(ranks)).select(
        "feature", *[F.round(c, 9).alias(c) for c in ("correlation", "abs_corr", "flood_median")])


@stat.add("T6s_top_importance", O.sql(
    "SELECT r.feature, round(abs(r), 9) AS abs_corr FROM rho r ORDER BY abs(r) DESC, r.feature LIMIT 20", "h_base", extra=_U))
def _(spark, d):
    ranks = T.rank_table(labelled(spark, d), FEATURES)
    return T.importance(T.spearman(ranks), T.rank_sum_test(ranks), top=20).select(
        "feature", F.round("abs_corr", 9).alias("abs_corr"))


@stat.add("K2_top_by_correlation", O.sql(
    "SELECT feature, round(r, 9) AS correlation FROM rho ORDER BY abs(r) DESC, feature LIMIT 3", "h_base", extra=_RANKED))
def _(spark, d):
    return (T.spearman(T.rank_table(labelled(spark, d), FEATURES))
            .orderBy(F.abs("correlation").desc(), "feature").limit(3)
            .select("feature", F.round("correlation", 9).alias("correlation")))


@stat.add("K3_sorted_by_rank_test", O.sql(
    "SELECT feature, mw AS mw_statistic FROM rt ORDER BY z DESC, feature LIMIT 4", "h_base", extra=_U))
def _(spark, d):
    return (T.rank_sum_test(T.rank_table(labelled(spark, d), FEATURES))
            .orderBy("p_value", F.col("z").desc(), "feature").limit(4).select("feature", "mw_statistic"))


_PAIR = ["temperature_2m", "soil_temperature_0_to_7cm", "relative_humidity_2m", "et0_fao_evapotranspiration"]
_CELLS = {"rr": "SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2e0 AS {c}" for c in _PAIR) + " FROM h_base"}
_PAIRS = [(a, b) for i, a in enumerate(_PAIR) for b in _PAIR[i + 1:]]


@stat.add("T3s_spearman_matrix", O.sql(" UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS rho FROM rr" for a, b in _PAIRS),
    "h_base", extra=_CELLS))
def _(spark, d):
    m = T.correlation_matrix(labelled(spark, d), _PAIR)
    return m.filter(F.col("i") < F.col("j")).select("feature_a", "feature_b", F.round("rho", 6).alias("rho"))


@stat.add("T2s_pearson_matrix", O.sql(" UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS r FROM h_base" for a, b in _PAIRS),
    "h_base"))
def _(spark, d):
    m = T.correlation_matrix(labelled(spark, d), _PAIR, "pearson")
    return m.filter(F.col("i") < F.col("j")).select("feature_a", "feature_b", F.round("rho", 6).alias("r"))


@stat.add("T4s_redundant_pairs", O.sql("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS rho FROM rr" for a, b in _PAIRS)
    + ") q WHERE rho > 0.6", "h_base", extra=_CELLS))
def _(spark, d):
    m = T.correlation_matrix(labelled(spark, d), _PAIR)
    return T.redundant_pairs(m, 0.6).withColumn("rho", F.round("rho", 6))


@stat.add("T7s_feature_selection")
def _(spark, d):
    ranks = T.rank_table(labelled(spark, d), FEATURES)
    test = cut_lineage(T.rank_sum_test(ranks))
    kept = T.select_features(FEATURES, S.EXCLUDED_FROM_MODEL, test)
    return test.withColumn("kept", F.col("feature").isin(kept))


@stat.add("T8s_neg_log10", O.sql(
    "SELECT zone, time_6h, round(-log10(risk_score + 1e-300), 9) AS strength FROM scored", "scored"))
def _(spark, d):
    return A.scored(spark, d).select("zone", "time_6h", F.round(C.neg_log10("risk_score"), 9).alias("strength"))


_WX = ["temperature_2m", "relative_humidity_2m", "wind_speed_10m"]


@stat.add("A16_describe", O.sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, COUNT({c}) AS count, {O.mean(c)} AS mean, round(stddev_samp({c}), 6) AS std, MIN({c}) AS min, "
    f"MAX({c}) AS max, round(quantile_cont({c}, 0.25), 9) AS q25, round(quantile_cont({c}, 0.5), 9) AS q50, "
    f"round(quantile_cont({c}, 0.75), 9) AS q75 FROM h_slots" for c in _WX), "h_slots"))
def _(spark, d):
    from tideline.operators import resample as R
    x = T.describe(R.resample(A.history_weather(spark, d)), _WX)
    return x.select("feature", "count", "mean", F.round("std", 6).alias("std"), "min", "max",
                    *[F.round(c, 9).alias(c) for c in ("q25", "q50", "q75")])


@stat.add("U5_pairs_without_nulls", O.sql(
    "SELECT COUNT(*) AS pairs FROM weather WHERE temperature_2m IS NOT NULL AND relative_humidity_2m IS NOT NULL", "weather"))
def _(spark, d):
    x = A.weather_hourly(spark, d)
    both = F.col("temperature_2m").isNotNull() & F.col("relative_humidity_2m").isNotNull()
    return x.filter(both).agg(F.count(F.lit(1)).alias("pairs"))


@stat.add("Q6_minimum_samples", O.sql(
    "SELECT zone, COUNT(wind_speed_10m) AS pairs FROM slots GROUP BY 1 HAVING COUNT(wind_speed_10m) >= 30", "slots"))
def _(spark, d):
    from tideline.operators import resample as R
    return (R.resample(A.weather_hourly(spark, d)).groupBy("zone").agg(F.count("wind_speed_10m").alias("pairs"))
            .filter(F.col("pairs") >= 30))


@stat.add("J11_feature_list_filter", O.sql(
    "SELECT feature, COUNT(*) AS n FROM lf WHERE feature IN ('precipitation', 'temperature_2m') GROUP BY 1", "h_base",
    extra=_LONG))
def _(spark, d):
    wanted = spark.createDataFrame([("precipitation",), ("temperature_2m",), ("not_there",)], "feature string")
    long = T.long_form(labelled(spark, d), FEATURES)
    return long.join(F.broadcast(wanted), "feature", "left_semi").groupBy("feature").agg(F.count(F.lit(1)).alias("n"))


@stat.add("C13_explore", O.sql(
    "SELECT r.feature, pairs, round(r, 9) AS correlation, mw AS mw_statistic, CAST(0 AS BIGINT) AS missing FROM rho r JOIN u "
    "ON u.feature = r.feature", "h_base", extra=_U))
def _(spark, d):
    x = labelled(spark, d)
    ranks = T.rank_table(x, FEATURES)
    nulls = Q.null_rates(x, FEATURES).select(F.col("column").alias("feature"), "missing")
    return (T.spearman(ranks).select("feature", "pairs", F.round("correlation", 9).alias("correlation"))
            .join(T.rank_sum_test(ranks).select("feature", "mw_statistic"), "feature").join(nulls, "feature"))
