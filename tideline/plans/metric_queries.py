"""Checked queries: splits, folds, curves, thresholds, calibration tables."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tideline.operators import metrics as M, sketches as K, splits as L
from tideline.plans import oracle as O
from tideline.plans.registry import Registry
from tideline.session import cut_lineage
from tideline.sources import adapters as A

metric = Registry()
_N = "(SELECT COUNT(*) FROM scored)"
_IX = {"ix": "SELECT *, row_number() OVER (ORDER BY time_6h, zone) - 1 AS i FROM scored"}


def nine(df):
    """Mean scores to nine digits, as the check SQL rounds them; a plain sum's last digit depends on task order."""
    return df.withColumn("mean_score", F.round("mean_score", 9))


def cut(share):
    return f"(SELECT time_6h FROM ix WHERE i = CAST(floor({_N} * {share}e0) AS BIGINT))"


@metric.add("M1_chronological_split", O.sql(
    "SELECT zone, time_6h, CASE WHEN time_6h < " + cut(0.8) + " THEN 'train' ELSE 'test' END AS part FROM ix",
    "scored", extra=_IX))
def _(spark, d):
    train, test = L.chronological_split(A.scored(spark, d))
    keep = lambda x, p: x.select("zone", "time_6h", F.lit(p).alias("part"))
    return keep(train, "train").unionByName(keep(test, "test"))


@metric.add("M2_three_way_split", O.sql(
    "SELECT part, COUNT(*) AS n, SUM(is_flood)::BIGINT AS positives, MIN(time_6h) AS first_time, MAX(time_6h) AS "
    "last_time FROM (SELECT *, CASE WHEN time_6h < " + cut(0.7) + " THEN 'train' WHEN time_6h < " + cut(0.85)
    + " THEN 'calibration' ELSE 'test' END AS part FROM ix) q GROUP BY 1", "scored", extra=_IX))
def _(spark, d):
    parts = zip(("train", "calibration", "test"), L.three_way_split(A.scored(spark, d)))
    out = None
    for name, x in parts:
        row = x.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"),
                    F.sum("is_flood").cast("bigint").alias("positives"),
                    F.min("time_6h").alias("first_time"), F.max("time_6h").alias("last_time"))
        out = row if out is None else out.unionByName(row)
    return out


_TRAIN = {**_IX, "tr": "SELECT zone, time_6h FROM ix WHERE time_6h < " + cut(0.8),
          "tix": "SELECT *, row_number() OVER (ORDER BY time_6h, zone) - 1 AS i FROM tr"}


@metric.add("M3_fit_validation_cut", O.sql(
    "SELECT zone, time_6h, CASE WHEN i < CAST(floor((SELECT COUNT(*) FROM tr) * 0.85e0) AS BIGINT) THEN 0 ELSE 1 END "
    "AS segment FROM tix", "scored", extra=_TRAIN))
def _(spark, d):
    train, _ = L.chronological_split(A.scored(spark, d).select("zone", "time_6h"))
    return L.fit_validation(train)


_FOLDS = {**_IX, "fo": "SELECT *, " + " + ".join(
    f"CASE WHEN i >= {_N} - {5 - k} * ({_N} // 6) THEN 1 ELSE 0 END" for k in range(5)) + " AS fold FROM ix"}


@metric.add("M4_expanding_folds", O.sql("SELECT zone, time_6h, fold FROM fo", "scored", extra=_FOLDS))
def _(spark, d):
    return L.expanding_folds(A.scored(spark, d)).select("zone", "time_6h", "fold")


@metric.add("M4_fold_sizes", O.sql(
    "SELECT k AS fold, COUNT(*) FILTER (fold < k) AS train_rows, coalesce(SUM(is_flood) FILTER (fold < k), 0)::BIGINT "
    "AS train_pos, COUNT(*) FILTER (fold = k) AS test_rows, coalesce(SUM(is_flood) FILTER (fold = k), 0)::BIGINT "
    "AS test_pos FROM fo, (SELECT unnest([1, 2, 3, 4, 5]) AS k) ks GROUP BY 1", "scored", extra=_FOLDS))
def _(spark, d):
    return L.fold_sizes(L.expanding_folds(A.scored(spark, d)))


@metric.add("M5_stratified_folds", O.sql(
    "SELECT is_flood, fold, n // 5 + CASE WHEN fold < n % 5 THEN 1 ELSE 0 END AS rows_in_fold FROM (SELECT is_flood, "
    "COUNT(*) AS n FROM scored GROUP BY 1) c, (SELECT unnest([0, 1, 2, 3, 4]) AS fold) f", "scored"))
def _(spark, d):
    return (L.stratified_folds(A.scored(spark, d)).groupBy("is_flood", "fold")
            .agg(F.count(F.lit(1)).alias("rows_in_fold")))


@metric.add("M5_stratified_holdout", O.sql(
    "SELECT is_flood, CAST(ceil(COUNT(*) * 0.2e0) AS BIGINT) AS test_rows, COUNT(*) - CAST(ceil(COUNT(*) * 0.2e0) AS "
    "BIGINT) AS train_rows FROM scored GROUP BY 1", "scored"))
def _(spark, d):
    return L.stratified_holdout(A.scored(spark, d)).groupBy("is_flood").agg(
        F.count_if("is_test").alias("test_rows"), F.count_if(~F.col("is_test")).alias("train_rows"))


@metric.add("M6_class_weight", O.sql(
    "SELECT CAST(COUNT(*) FILTER (is_flood = 0) AS DOUBLE) / greatest(COUNT(*) FILTER (is_flood = 1), 1) AS pos_weight "
    "FROM scored", "scored"))
def _(spark, d):
    return L.class_weight(A.scored(spark, d))


# ---- curves -------------------------------------------------------------------------
@metric.add("W8_cumulative_by_score", O.sql("SELECT threshold, flagged, tp FROM curve", "curve"))
def _(spark, d):
    return M.curve(A.scored(spark, d)).select("threshold", "flagged", "tp")


@metric.add("W9_average_ranks", O.sql(
    "SELECT risk_score AS threshold, COUNT(*) AS n, MIN(r) + (COUNT(*) - 1) / 2e0 AS average_rank FROM (SELECT "
    "risk_score, rank() OVER (ORDER BY risk_score) AS r FROM scored) q GROUP BY 1", "scored"))
def _(spark, d):
    c = M.curve(A.scored(spark, d))
    return c.select("threshold", "n", (F.col("cn") - F.col("n") + (F.col("n") + 1) / F.lit(2.0)).alias("average_rank"))


@metric.add("M12_precision_recall_table", O.sql(
    "SELECT threshold, p AS \"precision\", r AS recall FROM pr", "pr"))
def _(spark, d):
    return M.pr_table(M.curve(A.scored(spark, d)))


_F2 = "5e0 * p * r / (4e0 * p + r + 1e-9)"


@metric.add("M13_best_threshold", O.sql(
    f"SELECT threshold, p AS \"precision\", r AS recall, {_F2} AS fbeta FROM pr ORDER BY {_F2} DESC, threshold LIMIT 1",
    "pr"))
def _(spark, d):
    return M.best_threshold(M.curve(A.scored(spark, d)))


@metric.add("M13_best_threshold_floor", O.sql(
    f"SELECT threshold, p AS \"precision\", r AS recall, {_F2} AS fbeta FROM pr ORDER BY p >= 0.1 DESC, {_F2} DESC, "
    "threshold LIMIT 1", "pr"))
def _(spark, d):
    return M.best_threshold(M.curve(A.scored(spark, d)), floor=0.1)


_H4 = "floor(({0}) * 10000e0 + 0.5e0) / 10000e0"


def _at(name, t):
    return (f"SELECT '{name}' AS name, {t}e0 AS threshold, " + _H4.format("p") + " AS \"precision\", "
            + _H4.format("r") + " AS recall, " + _H4.format("2 * p * r / (p + r + 1e-9)") + " AS f1, "
            + _H4.format(_F2) + " AS f2, (SELECT SUM(pos) FROM pc WHERE threshold >= " + f"{t}e0)::BIGINT AS tp, "
            f"(SELECT SUM(n - pos) FROM pc WHERE threshold >= {t}e0)::BIGINT AS fp, (SELECT SUM(pos) FROM pc WHERE "
            f"threshold < {t}e0)::BIGINT AS fn FROM (SELECT * FROM pr ORDER BY abs(threshold - {t}e0), threshold LIMIT 1) q")


_TWO = {"pc": "SELECT risk_score AS threshold, COUNT(*) AS n, SUM(is_flood) AS pos FROM scored GROUP BY 1",
        "two": f"SELECT * FROM ({_at('high', 0.6)}) a UNION ALL SELECT * FROM ({_at('low', 0.35)}) b"}


@metric.add("M14_two_thresholds", O.sql(
    "SELECT * FROM two UNION ALL SELECT 'low - high', " + ", ".join(
        f"MAX(CASE WHEN name = 'low' THEN {c} END) - MAX(CASE WHEN name = 'high' THEN {c} END)"
        for c in ("threshold", '"precision"', "recall", "f1", "f2", "tp", "fp", "fn")) + " FROM two",
    "pr", extra=_TWO))
def _(spark, d):
    rows = M.compare_thresholds(M.curve(A.scored(spark, d)), {"high": 0.6, "low": 0.35})
    return M.with_delta(rows, "name", "low", "high", "low - high")


@metric.add("M15_roc_auc", O.sql(
    "SELECT round((SUM(r) FILTER (is_flood = 1) - p * (p + 1) / 2e0) / (p * n), 9) AS auc_roc FROM (SELECT is_flood, "
    "rank() OVER (ORDER BY risk_score) + (COUNT(*) OVER (PARTITION BY risk_score) - 1) / 2e0 AS r, SUM(is_flood) OVER () "
    "AS p, COUNT(*) OVER () - SUM(is_flood) OVER () AS n FROM scored) q GROUP BY p, n", "scored"))
def _(spark, d):
    return M.roc_auc(M.curve(A.scored(spark, d))).select(F.round("auc_roc", 9).alias("auc_roc"))


@metric.add("M16_average_precision", O.sql(
    "SELECT round(SUM(CAST(pos AS DOUBLE) / total_pos * (CAST(tp AS DOUBLE) / flagged)), 9) AS auc_pr FROM curve", "curve"))
def _(spark, d):
    return M.average_precision(M.curve(A.scored(spark, d))).select(F.round("auc_pr", 9).alias("auc_pr"))


_CM = {"cm": "SELECT COUNT(*) FILTER (is_flood = 1 AND flood_pred = 1) AS tp, COUNT(*) FILTER (is_flood = 0 AND "
             "flood_pred = 1) AS fp, COUNT(*) FILTER (is_flood = 1 AND flood_pred = 0) AS fn, COUNT(*) FILTER "
             "(is_flood = 0 AND flood_pred = 0) AS tn FROM scored"}


def _r(a, b):
    return f"CASE WHEN {b} = 0 THEN 0e0 ELSE CAST({a} AS DOUBLE) / ({b}) END"


@metric.add("M17_scores_at_flag", O.sql(
    f"SELECT *, {_r('tp', 'tp + fp')} AS \"precision\", {_r('tp', 'tp + fn')} AS recall, "
    f"{_r('2 * tp', '2 * tp + fp + fn')} AS f1, {_r('5 * tp', '5 * tp + 4 * fn + fp')} AS f2, "
    f"{_r('(tp + tn)', 'tp + fp + fn + tn')} AS accuracy FROM cm", "scored", extra=_CM))
def _(spark, d):
    return M.scores_at(A.scored(spark, d))


def _class(name, t, f, m):
    return (f"SELECT '{name}' AS class, {_r(t, f'{t} + {f}')} AS \"precision\", {_r(t, f'{t} + {m}')} AS recall, "
            f"{_r(f'2 * {t}', f'2 * {t} + {f} + {m}')} AS f1, {t} + {m} AS support FROM cm")


_REP = {**_CM, "c0": _class("0", "tn", "fn", "fp"), "c1": _class("1", "tp", "fp", "fn")}
_ACC = _r("(tp + tn)", "tp + fp + fn + tn")


def _avg(name, wa, wb):
    return (f"SELECT '{name}', " + ", ".join(f"a.{c} * {wa} + b.{c} * {wb}" for c in ('"precision"', "recall", "f1"))
            + ", a.support + b.support FROM c0 a, c1 b")


@metric.add("M18_classification_report", O.sql(
    f"SELECT * FROM c0 UNION ALL SELECT * FROM c1 UNION ALL SELECT 'accuracy', {_ACC}, {_ACC}, {_ACC}, tp + fp + fn + tn "
    "FROM cm UNION ALL " + _avg("macro avg", "0.5e0", "0.5e0") + " UNION ALL "
    + _avg("weighted avg", "(CAST(a.support AS DOUBLE) / (a.support + b.support))",
           "(CAST(b.support AS DOUBLE) / (a.support + b.support))"), "scored", extra=_REP))
def _(spark, d):
    return M.classification_report(A.scored(spark, d))


@metric.add("M19_confusion_matrix", O.sql(
    "SELECT is_flood, COUNT(*) FILTER (flood_pred = 0) AS pred_0, COUNT(*) FILTER (flood_pred = 1) AS pred_1 "
    "FROM scored GROUP BY 1", "scored"))
def _(spark, d):
    return M.confusion_table(A.scored(spark, d))


@metric.add("M20_brier", O.sql(
    "SELECT round(AVG((risk_score - is_flood) * (risk_score - is_flood)), 12) AS brier FROM scored", "scored"))
def _(spark, d):
    return M.brier(A.scored(spark, d)).select(F.round("brier", 12).alias("brier"))


_SORTED = {
    "so": "SELECT risk_score AS v, row_number() OVER (ORDER BY risk_score) - 1 AS i FROM scored",
    "spots": f"SELECT k, ({_N} - 1) * (k / 10e0) AS h FROM (SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8, 9]) AS k) z",
    "edge": "SELECT k, a.v + (b.v - a.v) * (h - floor(h)) AS e FROM spots JOIN so a ON a.i = floor(h) "
            f"JOIN so b ON b.i = least(floor(h) + 1, {_N} - 1)",
}


@metric.add("M21_reliability_curve", O.sql(
    f"SELECT bin, COUNT(*) AS \"rows\", round(AVG(risk_score), 9) AS mean_score, CAST(SUM(is_flood) AS DOUBLE) / COUNT(*) AS "
    "observed_rate FROM (SELECT s.*, (SELECT COUNT(*) FROM edge WHERE e < s.risk_score) AS bin FROM scored s) q GROUP BY 1",
    "scored", extra=_SORTED))
def _(spark, d):
    return nine(M.reliability(M.curve(A.scored(spark, d))))


@metric.add("A18_score_percentiles", O.sql(
    f"SELECT round(AVG(risk_score), 9) AS mean_score, (SELECT e FROM edge WHERE k = 1) AS p10, "
    "(SELECT e FROM edge WHERE k = 9) AS p90 FROM scored", "scored", extra=_SORTED))
def _(spark, d):
    return nine(M.score_percentiles(M.curve(A.scored(spark, d))))


_SPAN = {"w": "SELECT MIN(risk_score) AS a, (MAX(risk_score) - MIN(risk_score)) / 60e0 AS w FROM scored"}
_BINNED = ("SELECT s.is_flood, CAST(least(floor((risk_score - (SELECT a FROM w)) / (SELECT w FROM w)), 59) AS INT) AS bin, "
           "COUNT(*) AS n FROM scored s GROUP BY 1, 2")


@metric.add("A21_score_histogram", O.sql(
    f"SELECT b.is_flood, bin, n, n / (c * (SELECT w FROM w)) AS density FROM ({_BINNED}) b JOIN (SELECT is_flood, "
    "COUNT(*) AS c FROM scored GROUP BY 1) t ON t.is_flood = b.is_flood", "scored", extra=_SPAN))
def _(spark, d):
    return M.histogram(A.scored(spark, d))


@metric.add("T9s_density_coarse", O.sql(
    "SELECT is_flood, bin // 3 AS band, SUM(n)::BIGINT AS n FROM (" + _BINNED + ") b GROUP BY 1, 2", "scored", extra=_SPAN))
def _(spark, d):
    h = M.histogram(A.scored(spark, d))
    return (h.groupBy("is_flood", F.floor(F.col("bin") / 3).cast("int").alias("band"))
            .agg(F.sum("n").alias("n")))


_SCOTT = {
    "shape": "SELECT is_flood, COUNT(*) AS n, MIN(risk_score) AS a, MAX(risk_score) AS z, stddev_samp(risk_score) * "
             "pow(COUNT(*), -0.2e0) AS h FROM scored GROUP BY 1 HAVING MIN(risk_score) < MAX(risk_score)",
    "spot": "SELECT s.*, CAST(p AS INT) AS point, a - 3 * h + (z - a + 6 * h) / 199 * p AS place FROM shape s, range(200) r(p)"}


@metric.add("T9s_kernel_density", O.sql(
    "SELECT p.is_flood, p.point, round(p.place, 7) AS place, round(SUM(exp(-pow((p.place - s.risk_score) / h, 2) / 2)) / "
    "(any_value(n) * any_value(h) * sqrt(2 * pi())), 7) AS density FROM spot p JOIN scored s ON s.is_flood = p.is_flood "
    "GROUP BY p.is_flood, p.point, p.place", "scored", extra=_SCOTT))
def _(spark, d):
    return M.kernel_density(A.scored(spark, d)).select(
        "is_flood", "point", *[F.round(c, 7).alias(c) for c in ("place", "density")])


_TOP = ["precipitation", "relative_humidity_2m", "temperature_2m", "wind_speed_10m"]


def _dependence_sql(feature, table):
    edges = ", ".join(f"{k} AS ({v})" for k, v in _SORTED.items()).replace("risk_score", feature).replace("scored", "seen")
    edges = f"seen AS (SELECT * FROM {table} WHERE {feature} IS NOT NULL), {edges}"
    return (f"SELECT * FROM (WITH {edges} SELECT bin, '{feature}' AS feature, MIN({feature}) AS low, MAX({feature}) AS high, "
            f"COUNT(*) AS \"rows\", round(AVG(risk_score), 9) AS mean_score FROM (SELECT s.*, (SELECT COUNT(*) FROM edge "
            f"WHERE e < s.{feature}) AS bin FROM seen s) q GROUP BY bin) t_{feature}")


@metric.add("M32_dependence_table", O.sql(_dependence_sql("precipitation", "scored"), "scored"))
def _(spark, d):
    return nine(M.dependence(A.scored(spark, d), "precipitation"))


@metric.add("M32_dependence_four_features", O.sql(
    " UNION ALL ".join(_dependence_sql(f, "predictions") for f in _TOP), "predictions"))
def _(spark, d):
    stored = cut_lineage(A.predictions(spark, d))
    return nine(reduce(DataFrame.unionByName, [M.dependence(stored, f) for f in _TOP]))


_POINTS = {"p10": 0.10, "p50": 0.50, "p90": 0.90}


@metric.add("A18_sketch_percentiles", O.sql(
    "SELECT zone, COUNT(*) AS n, true AS p10_in_bound, true AS p50_in_bound, true AS p90_in_bound, true AS distinct_in_bound FROM "
    "h_weather WHERE temperature_2m IS NOT NULL GROUP BY 1", "h_weather"))
def _(spark, d):
    """Merged daily sketches. Each quantile's exact rank is held against twice the error stated with 99 % confidence, as the
    sketch draws at random; the distinct count against 5 %, six standard errors."""
    rows = A.history_weather(spark, d).select("zone", "time", F.col("temperature_2m").cast("double").alias("v"))
    got = K.estimates(K.merged(K.daily_sketches(rows, "v")), _POINTS)
    values = rows.filter(F.col("v").isNotNull()).groupBy("zone", "v").agg(F.count(F.lit(1)).alias("c"))
    ranks = values.join(got, "zone").groupBy("zone", "n", "distinct_values").agg(
        F.count(F.lit(1)).alias("_distinct"),
        *[F.sum(F.when(F.col("v") < F.col(p), F.col("c")).otherwise(0)).alias(f"{p}_below") for p in _POINTS],
        *[F.sum(F.when(F.col("v") <= F.col(p), F.col("c")).otherwise(0)).alias(f"{p}_upto") for p in _POINTS])
    within = lambda p: ((F.col(f"{p}_below") / F.col("n") <= _POINTS[p] + 2 * K.RANK_ERROR)
                        & (F.col(f"{p}_upto") / F.col("n") >= _POINTS[p] - 2 * K.RANK_ERROR)).alias(f"{p}_in_bound")
    near = F.abs(F.col("distinct_values") - F.col("_distinct")) <= F.greatest(F.lit(1.0), F.col("_distinct") * 0.05)
    return ranks.select("zone", "n", *[within(p) for p in _POINTS], near.alias("distinct_in_bound"))
