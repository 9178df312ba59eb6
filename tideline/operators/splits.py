"""Chronological cuts, folds and class-wise draws without a global sort."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideline import settings as S
from tideline.operators.scale import row_index, running, staged_blocks, time_block
from tideline.session import cut_lineage

TIME = "time_6h"


def time_counts(df: DataFrame, time: str = TIME) -> DataFrame:
    """Rows per time, with rows up to and including it and rows in all.

    The counts are staged: the block totals and the rows both read them.
    """
    counts = cut_lineage(df.groupBy(time).agg(F.count(F.lit(1)).alias("n")))
    return running(counts, [], [time], time_block(time), {"upto": (F.col("n"), "sum")}, totals=["upto"])


def cut_times(df: DataFrame, shares: list[float], time: str = TIME) -> DataFrame:
    """One row: the time of row number int(rows * share) for every share."""
    t = time_counts(df, time)
    return t.agg(*[
        F.min(F.when(F.col("upto") > F.floor(F.col("upto_total") * F.lit(float(s))), F.col(time)))
        .alias(f"cut_{i}") for i, s in enumerate(shares)])


def chronological_split(df: DataFrame, test_frac: float = 0.20, time: str = TIME):
    """(train, test); all rows at the cut time are test rows."""
    cut = cut_times(df, [1 - test_frac], time).scalar()
    return df.filter(F.col(time) < cut), df.filter(F.col(time) >= cut)


def three_way_split(df: DataFrame, first: float = 0.70, second: float = 0.85, time: str = TIME):
    cuts = cut_times(df, [first, second], time)
    a, b = cuts.select("cut_0").scalar(), cuts.select("cut_1").scalar()
    return (df.filter(F.col(time) < a), df.filter((F.col(time) >= a) & (F.col(time) < b)),
            df.filter(F.col(time) >= b))


def segments(df: DataFrame, boundaries, time: str = TIME, ties: list[str] = ("zone",),
             out: str = "segment") -> DataFrame:
    """Number of row boundaries at or before each row, rows ordered by time then ``ties``.

    ``boundaries(total)`` gives the row numbers as columns. Only the few times
    that a boundary falls into need their rows ranked; for all other times the
    counts per time already tell the segment.
    """
    t = time_counts(df, time)
    edges = boundaries(F.col("upto_total"))

    def passed(position: Column) -> Column:
        out = F.lit(0)
        for e in edges:
            out = out + (e <= position).cast("int")
        return out

    t = t.select(F.col(time).alias("_t"), "upto_total", (F.col("upto") - F.col("n")).alias("_from"),
                 (F.col("upto") - 1).alias("_to"))
    x = df.join(t, F.col(time) == F.col("_t"))
    x = x.withColumn("_lo", passed(F.col("_from"))).withColumn("_hi", passed(F.col("_to")))
    clear = x.filter(F.col("_lo") == F.col("_hi")).withColumn(out, F.col("_lo"))
    split = x.filter(F.col("_lo") != F.col("_hi"))
    place = F.row_number().over(Window.partitionBy(time).orderBy(*ties)) - 1
    split = split.withColumn("_at", F.col("_from") + place).withColumn(out, passed(F.col("_at")))
    return clear.select(*df.columns, out).unionByName(split.select(*df.columns, out))


def fit_validation(df: DataFrame, share: float = 0.85, **kw) -> DataFrame:
    """``segment`` 0 for the first int(rows * share) rows, else 1."""
    return segments(df, lambda n: [F.floor(n * F.lit(float(share)))], **kw)


def expanding_folds(df: DataFrame, k: int = 5, out: str = "fold", **kw) -> DataFrame:
    """``fold`` i (1..k) is the test block of fold i; its training rows have a smaller number.

    Each test block has rows // (k + 1) rows, the last one ends at the last row.
    """
    def edges(n):
        size = F.floor(n / F.lit(k + 1))
        return [n - (k - i) * size for i in range(k)]

    return segments(df, edges, out=out, **kw)


def fold_sizes(folded: DataFrame, k: int = 5, label: str = S.TARGET) -> DataFrame:
    """Training and test rows and positives of every fold."""
    per = folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("p"))
    cells = F.explode(F.array(*[F.lit(i) for i in range(1, k + 1)])).alias("i")
    x = per.select("fold", "n", "p", cells)
    test, train = F.col("fold") == F.col("i"), F.col("fold") < F.col("i")
    return x.groupBy(F.col("i").alias("fold")).agg(
        F.sum(F.when(train, F.col("n")).otherwise(0)).alias("train_rows"),
        F.sum(F.when(train, F.col("p")).otherwise(0)).alias("train_pos"),
        F.sum(F.when(test, F.col("n")).otherwise(0)).alias("test_rows"),
        F.sum(F.when(test, F.col("p")).otherwise(0)).alias("test_pos"))


def class_weight(df: DataFrame, label: str = S.TARGET) -> DataFrame:
    """One row: negatives per positive."""
    neg, pos = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    return df.agg((neg / F.greatest(pos, F.lit(1))).cast("double").alias("pos_weight"))


# ---- draws -----------------------------------------------------------------------
def shuffled(df: DataFrame, keys: list[str], identity: list[str], seed: int,
             name: str = "draw") -> DataFrame:
    """Position of each row in a seeded random order inside its key.

    The order is that of a hash of the identity columns, taken over the parts of
    a range shuffle, so no key is sorted in one task.
    """
    order = ["_h", *identity]
    x, block = staged_blocks(df.withColumn("_h", F.xxhash64(F.lit(seed), *identity)), [*keys, *order])
    return row_index(x, keys, order, block, name).drop("_h")


def stratified_folds(df: DataFrame, k: int = 5, label: str = S.TARGET,
                     identity: list[str] = ("zone", TIME), seed: int = 42) -> DataFrame:
    """``fold`` 0..k-1; every class is spread evenly to within one row."""
    x = shuffled(df, [label], list(identity), seed)
    return x.withColumn("fold", (F.col("draw") % k).cast("int")).drop("draw")


def stratified_holdout(df: DataFrame, test_frac: float = 0.2, label: str = S.TARGET,
                       identity: list[str] = ("zone", TIME), seed: int = 42) -> DataFrame:
    """``is_test`` for the given share of every class."""
    sizes = df.groupBy(label).agg(F.ceil(F.count(F.lit(1)) * F.lit(test_frac)).alias("_take"))
    x = shuffled(df, [label], list(identity), seed).join(F.broadcast(sizes), label)  # one row per class
    return x.withColumn("is_test", F.col("draw") < F.col("_take")).drop("draw", "_take").select(
        *df.columns, "is_test")
