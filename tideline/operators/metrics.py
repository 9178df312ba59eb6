"""Exact ranking and threshold metrics from one table of distinct scores."""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tideline import settings as S
from tideline.functions.columns import half_up
from tideline.operators.scale import quantile_columns, running, staged_blocks
from tideline.session import cut_lineage

TINY = 1e-9


def score_counts(df: DataFrame, score="risk_score", label=S.TARGET, keys: list[str] = ()) -> DataFrame:
    """Rows and positives per distinct score; equal scores are one step."""
    return (df.groupBy(*keys, F.col(score).alias("threshold"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(label).cast("bigint").alias("pos")))


def curve(df: DataFrame, score="risk_score", label=S.TARGET, parts: int | None = None,
          keys: list[str] = ()) -> DataFrame:
    """Per distinct score: rows and positives at or above it, below it, and in all."""
    keys = list(keys)
    counts = score_counts(df, score, label, keys)
    counts, block = staged_blocks(counts, keys + ["threshold"], parts)
    x = running(counts, keys, ["threshold"], block,
                {"cn": (F.col("n"), "sum"), "cp": (F.col("pos"), "sum")}, totals=["cn", "cp"])
    return x.select(
        *keys, "threshold", "n", "pos", "cn", "cp",
        (F.col("cn_total") - F.col("cn") + F.col("n")).alias("flagged"),
        (F.col("cp_total") - F.col("cp") + F.col("pos")).alias("tp"),
        F.col("cn_total").alias("total_n"), F.col("cp_total").alias("total_pos"))


def precision() -> Column:
    return F.col("tp") / F.col("flagged")


def recall() -> Column:
    return F.when(F.col("total_pos") == 0, F.lit(1.0)).otherwise(F.col("tp") / F.col("total_pos"))


def fbeta(p: Column, r: Column, beta: float = 2.0) -> Column:
    b = beta * beta
    return F.lit(1 + b) * p * r / (F.lit(b) * p + r + F.lit(TINY))


def pr_table(c: DataFrame) -> DataFrame:
    return c.select("threshold", precision().alias("precision"), recall().alias("recall"))


def best_threshold(c: DataFrame, beta: float = 2.0, floor: float | None = None) -> DataFrame:
    """The lowest threshold with the best F-beta.

    With a precision ``floor`` only thresholds that reach it compete, unless
    none does.
    """
    p, r = precision(), recall()
    x = c.select("threshold", p.alias("precision"), r.alias("recall"), fbeta(p, r, beta).alias("fbeta"))
    ok = F.lit(True) if floor is None else F.col("precision") >= floor
    order = F.struct(ok.cast("int").alias("a"), F.col("fbeta").alias("b"), (-F.col("threshold")).alias("c"))
    best = F.max_by(F.struct("threshold", "precision", "recall", "fbeta"), order).alias("b")
    return x.agg(best).select("b.*")


def roc_auc(c: DataFrame) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties half; exact integers inside.

    Null without positives or without negatives.
    """
    big = "decimal(38,0)"
    neg = F.col("n") - F.col("pos")
    below = F.col("cn") - F.col("cp") - neg
    # counts of one step times counts below: each factor stays below 2^63
    pairs = F.sum(F.col("pos").cast("decimal(19,0)") * (2 * below + neg).cast("decimal(19,0)"))
    total_pos, total_neg = F.max("total_pos"), F.max("total_n") - F.max("total_pos")
    return c.agg(F.try_divide(pairs.cast("double") / 2, total_pos.cast("double") * total_neg.cast("double"))
                 .alias("auc_roc"))


def average_precision(c: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Sum over thresholds of the recall step times the precision (no interpolation); 0 without positives."""
    return c.groupBy(*keys).agg(_step_sum().alias("auc_pr"))


def _step_sum():
    return F.coalesce(F.sum(F.try_divide(F.col("pos"), F.col("total_pos")) * precision()), F.lit(0.0))


def ranking_metrics(c: DataFrame) -> DataFrame:
    """Both areas in one pass over the curve."""
    neg = F.col("n") - F.col("pos")
    below = F.col("cn") - F.col("cp") - neg
    pairs = F.sum(F.col("pos").cast("decimal(19,0)") * (2 * below + neg).cast("decimal(19,0)"))
    P, N = F.max("total_pos").cast("double"), (F.max("total_n") - F.max("total_pos")).cast("double")
    return c.agg(F.try_divide(pairs.cast("double") / 2, P * N).alias("auc_roc"), _step_sum().alias("auc_pr"))


# ---- at a threshold ------------------------------------------------------------------
def confusion(df: DataFrame, label=S.TARGET, pred="flood_pred") -> DataFrame:
    y, f = F.col(label) == 1, F.col(pred) == 1
    return df.agg(F.count_if(y & f).alias("tp"), F.count_if(~y & f).alias("fp"),
                  F.count_if(y & ~f).alias("fn"), F.count_if(~y & ~f).alias("tn"))


def confusion_table(df: DataFrame, label=S.TARGET, pred="flood_pred") -> DataFrame:
    return df.groupBy(label).pivot(pred, [0, 1]).count().na.fill(0).withColumnsRenamed(
        {"0": "pred_0", "1": "pred_1"})


def ratio(a, b) -> Column:
    """a / b, 0 where b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def scores_at(df: DataFrame, label=S.TARGET, pred="flood_pred") -> DataFrame:
    """Precision, recall, F1, F2 and accuracy of a flag; a zero denominator gives 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion(df, label, pred).select(
        "tp", "fp", "fn", "tn", ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), ratio(5 * tp, 5 * tp + 4 * fn + fp).alias("f2"),
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"))


def compare_thresholds(c: DataFrame, named: dict[str, float]) -> DataFrame:
    """Curve values at the nearest score and counts at the exact threshold, per name."""
    x = c.select("*", precision().alias("p"), recall().alias("r"))
    out = None
    for name, t in named.items():
        near = F.min_by(F.struct("p", "r"), F.struct(F.abs(F.col("threshold") - t), "threshold"))
        over = F.col("threshold") >= t
        row = x.agg(near.alias("m"), F.sum(F.when(over, F.col("pos")).otherwise(0)).alias("tp"),
                    F.sum(F.when(over, F.col("n") - F.col("pos")).otherwise(0)).alias("fp"),
                    F.sum(F.when(~over, F.col("pos")).otherwise(0)).alias("fn"))
        p, r = F.col("m.p"), F.col("m.r")
        row = row.select(
            F.lit(name).alias("name"), F.lit(float(t)).alias("threshold"), half_up(p, 4).alias("precision"),
            half_up(r, 4).alias("recall"), half_up(2 * p * r / (p + r + F.lit(TINY)), 4).alias("f1"),
            half_up(fbeta(p, r), 4).alias("f2"), "tp", "fp", "fn")
        out = row if out is None else out.unionByName(row)
    return out


def with_delta(rows: DataFrame, key: str, minuend: str, subtrahend: str, name: str) -> DataFrame:
    """Append the difference of two named rows."""
    numbers = [c for c in rows.columns if c != key]

    def pick(c, who):
        return F.max(F.when(F.col(key) == who, F.col(c)))

    delta = rows.agg(*[(pick(c, minuend) - pick(c, subtrahend)).alias(c) for c in numbers])
    return rows.unionByName(delta.select(F.lit(name).alias(key), *numbers))


def classification_report(df: DataFrame, label=S.TARGET, pred="flood_pred") -> DataFrame:
    """Per class, accuracy, macro and weighted averages."""
    x = confusion(df, label, pred)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def one(t, f, m, name):
        return F.struct(F.lit(name).alias("class"), ratio(t, t + f).alias("precision"),
                        ratio(t, t + m).alias("recall"), ratio(2 * t, 2 * t + f + m).alias("f1"),
                        (t + m).cast("bigint").alias("support"))

    x = x.select("*", one(tn, fn, fp, "0").alias("a"), one(tp, fp, fn, "1").alias("b"))
    total = F.col("a.support") + F.col("b.support")

    def average(name, wa, wb):
        return F.struct(F.lit(name).alias("class"), *[
            (F.col(f"a.{m}") * wa + F.col(f"b.{m}") * wb).alias(m) for m in ("precision", "recall", "f1")],
            total.alias("support"))

    acc = ratio(tp + tn, total)
    rows = F.array(
        F.col("a"), F.col("b"),
        F.struct(F.lit("accuracy").alias("class"), acc.alias("precision"), acc.alias("recall"),
                 acc.alias("f1"), total.alias("support")),
        average("macro avg", F.lit(0.5), F.lit(0.5)),
        average("weighted avg", F.col("a.support") / total, F.col("b.support") / total))
    return x.select(F.explode(rows).alias("r")).select("r.*")


def brier(df: DataFrame, score="risk_score", label=S.TARGET) -> DataFrame:
    gap = F.col(score) - F.col(label)
    return df.agg(F.avg(gap * gap).alias("brier"))


# ---- distribution of scores -----------------------------------------------------------
def quantile_edges(c: DataFrame, bins: int = 10) -> DataFrame:
    """One row, one array: the inner quantile edges of the scores."""
    points = {f"q{i}": i / bins for i in range(1, bins)}
    return c.agg(*quantile_columns("cn", "n", "total_n", "threshold", points)).select(
        F.array(*points).alias("edges"))


def in_bins(c: DataFrame, bins: int) -> DataFrame:
    """Add ``bin``: the number of inner quantile edges below the value."""
    x = c.withColumn("_edges", quantile_edges(c, bins).scalar())
    below = [(F.col("_edges")[i] < F.col("threshold")).cast("int") for i in range(bins - 1)]
    return x.withColumn("bin", reduce(lambda a, b: a + b, below, F.lit(0))).drop("_edges")


def reliability(c: DataFrame, bins: int = 10) -> DataFrame:
    """Mean score and observed rate per quantile bin; empty bins give no row."""
    x = in_bins(c, bins)
    return x.groupBy("bin").agg(
        F.sum("n").alias("rows"),
        (F.sum(F.col("threshold") * F.col("n")) / F.sum("n")).alias("mean_score"),
        (F.sum("pos") / F.sum("n")).alias("observed_rate"))


def score_percentiles(c: DataFrame, points=None) -> DataFrame:
    points = points or {"p10": 0.10, "p90": 0.90}
    average = F.sum(F.col("threshold") * F.col("n")) / F.sum("n")
    return c.agg(average.alias("mean_score"), *quantile_columns("cn", "n", "total_n", "threshold", points))


def histogram(df: DataFrame, bins: int = 60, score="risk_score", label=S.TARGET) -> DataFrame:
    """Density per class over equal-width bins between the smallest and largest score.

    Equal scores are spread over half a unit on either side.
    """
    same = F.when(F.min(score) == F.max(score), F.lit(0.5)).otherwise(F.lit(0.0))
    span = df.agg((F.min(score) - same).alias("a"), (F.max(score) + same).alias("z"))
    lo, hi = span.select("a").scalar(), span.select("z").scalar()
    width = (hi - lo) / F.lit(float(bins))
    place = F.least(F.floor((F.col(score) - lo) / width), F.lit(bins - 1)).cast("int")
    cells = df.groupBy(label, place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_all"))
    return (cells.join(F.broadcast(sizes), label)  # one row per class
            .select(label, "bin", "n", (F.col("n") / (F.col("_all") * width)).alias("density")))


DENSITY_CELLS = 16     # cells to a bandwidth
DENSITY_TERMS = 8      # moments kept of a cell: the cut series errs by less than 1e-14 of the kernel's peak
DENSITY_REACH = 8.5    # bandwidths beyond which a normal is below 1e-15


def kernel_density(df: DataFrame, value: str = "risk_score", label: str = S.TARGET, points: int = 200) -> DataFrame:
    """Gaussian kernel density per class at ``points`` places from three bandwidths below the least value to three above the largest.

    The bandwidth is Scott's: sample deviation times n to the power -1/5. Values are summed up in cells of a sixteenth
    of it, each with the moments of its values about its middle, so the kernel's Taylor series about the middle gives
    their share of the density without the values. Two aggregations read the data; the rest has ``points`` times a
    fixed number of cells. Null and not-a-number values and rows without a class are left out; a class of fewer than
    two different values has no density and gives no row.
    """
    if points < 2:
        raise ValueError("a density needs two points or more")
    x = df.select(F.col(label).alias("_c"), F.col(value).cast("double").alias("_v")).filter(
        F.col("_c").isNotNull() & F.col("_v").isNotNull() & ~F.isnan("_v"))
    classes = (x.groupBy("_c").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_a"), F.max("_v").alias("_z"),
                                   F.stddev_samp("_v").alias("_sd"))
               .filter(F.col("_a") < F.col("_z"))
               .withColumn("_h", F.col("_sd") * F.pow("_n", F.lit(-0.2))))
    classes = cut_lineage(classes)
    cell = F.floor((F.col("_v") - F.col("_a")) / F.col("_h") * DENSITY_CELLS)
    middle = (F.col("_cell") + 0.5) / DENSITY_CELLS       # in bandwidths from the least value
    off = (F.col("_v") - F.col("_a")) / F.col("_h") - middle
    cells = (x.join(classes, "_c").withColumn("_cell", cell).withColumn("_off", off).groupBy("_c", "_cell")
             .agg(*[F.sum(F.pow("_off", F.lit(float(k))) / math.factorial(k)).alias(f"_m{k}") for k in range(DENSITY_TERMS)]))
    place = (F.col("_z") - F.col("_a") + 6 * F.col("_h")) / (points - 1) * F.col("point") - 3 * F.col("_h")
    reach = int(DENSITY_REACH * DENSITY_CELLS)
    at = (classes.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
          .withColumn("_at", place / F.col("_h")))
    own = F.floor(F.col("_at") * DENSITY_CELLS)
    seen = at.withColumn("_cell", F.explode(F.sequence(own - reach, own + reach))).join(cells, ["_c", "_cell"])
    u = F.col("_at") - middle
    hermite = [F.lit(1.0), u]                             # derivatives of the normal are these times the normal
    for k in range(1, DENSITY_TERMS - 1):
        hermite.append(u * hermite[k] - F.lit(float(k)) * hermite[k - 1])
    share = F.exp(-u * u / 2) * sum((hermite[k] * F.col(f"_m{k}") for k in range(1, DENSITY_TERMS)), F.col("_m0"))
    sums = seen.groupBy("_c", "point").agg(F.sum(share).alias("_s"))
    return (at.join(sums, ["_c", "point"], "left")
            .select(F.col("_c").alias(label), "point", (F.col("_a") + F.col("_at") * F.col("_h")).alias("place"),
                    (F.coalesce("_s", F.lit(0.0)) / (F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi))).alias("density")))


def dependence(df: DataFrame, feature: str, bins: int = 10, score="risk_score") -> DataFrame:
    """Mean score per quantile bin of a feature."""
    counts = (df.filter(F.col(feature).isNotNull()).groupBy(F.col(feature).alias("threshold"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum(score).alias("s")))
    counts, block = staged_blocks(counts, ["threshold"])
    c = running(counts, [], ["threshold"], block,
                {"cn": (F.col("n"), "sum")}, totals=["cn"]).withColumnRenamed("cn_total", "total_n")
    x = in_bins(c, bins)
    return x.groupBy("bin").agg(
        F.lit(feature).alias("feature"), F.min("threshold").alias("low"), F.max("threshold").alias("high"),
        F.sum("n").alias("rows"), (F.sum("s") / F.sum("n")).alias("mean_score"))
