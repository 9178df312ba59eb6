"""Shapley values of boosted trees, path dependent.

A tree's expectation without some features follows both children of a split on
such a feature, by their covers. For one leaf only the features on its path
count: with o = 1 where a row meets all conditions on a feature (else 0) and z
the product of the cover shares along them, the leaf's share for a feature is
value * (o - z) times the sum over subsets of the other path features of
|S|! (d - |S| - 1)! / d! * prod(o in S) * prod(z outside). The subset sums are
the coefficients of prod(z + o t), so a leaf costs the square of its depth and
all rows of an Arrow batch are handled together.

For every row the values and ``base`` add up to the margin.
"""
from __future__ import annotations

from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tideline.operators.boosting import BoostedTrees, Tree, matrix


def paths(tree: Tree) -> list[tuple[float, dict[int, tuple[float, float, float]]]]:
    """(value, feature -> (above, up to, share of the cover)) of every leaf."""
    out, stack = [], [(0, {})]
    while stack:
        node, path = stack.pop()
        if tree.feature[node] < 0:
            out.append((tree.value[node], path))
            continue
        feature, cut = tree.feature[node], tree.threshold[node]
        low, high, share = path.get(feature, (-np.inf, np.inf, 1.0))
        for child, bounds in ((tree.left[node], (low, min(high, cut))), (tree.right[node], (max(low, cut), high))):
            part = tree.cover[child] / tree.cover[node] if tree.cover[node] else 0.5
            stack.append((child, {**path, feature: (*bounds, share * part)}))
    return out


def expected(tree: Tree) -> float:
    """The tree's value without any feature."""
    return sum(value * np.prod([share for *_, share in path.values()]) for value, path in paths(tree))


def shapley(model: BoostedTrees, x: np.ndarray) -> np.ndarray:
    """(rows, features): the share of each feature in a row's margin."""
    phi = np.zeros((len(x), model.features))
    for tree in model.trees:
        for value, path in paths(tree):
            d = len(path)
            met = [((x[:, f] > low) & (x[:, f] <= high)).astype(float) for f, (low, high, _) in path.items()]
            shares = [share for *_, share in path.values()]
            for i, f in enumerate(path):
                sums = np.zeros((d, len(x)))         # by size of the subset
                sums[0] = 1.0
                for j in range(d):
                    if j != i:
                        grown = sums * shares[j]
                        grown[1:] += sums[:-1] * met[j]
                        sums = grown
                weight = [factorial(s) * factorial(d - s - 1) / factorial(d) for s in range(d)]
                phi[:, f] += value * (met[i] - shares[i]) * (np.array(weight) @ sums)
    return phi


def attributions(model: BoostedTrees, df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, x (the feature values), phi (their shares), base and margin of every row; needs ``features``."""
    from pyspark.ml.functions import vector_to_array
    base = model.base + float(sum(map(expected, model.trees)))
    x = df.select(*keep, vector_to_array("features").alias("x"))
    schema = StructType([*x.schema, StructField("phi", ArrayType(DoubleType())), StructField("base", DoubleType()),
                         StructField("margin", DoubleType())])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                values = matrix(batch.column(len(keep)))
                more = [pa.array(list(shapley(model, values)), pa.list_(pa.float64())),
                        pa.array(np.full(len(values), base)), pa.array(model.margins(values))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more],
                                                 names=[*batch.schema.names, "phi", "base", "margin"])
    return x.mapInArrow(run, schema)


def _by_feature(attributed: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
    each = F.posexplode(F.arrays_zip("x", "phi")).alias("_f", "_z")
    named = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_f") + 1)
    return attributed.select(*keep, each).select(*keep, named.alias("feature"), F.col("_z.x").alias("value"),
                                                 F.col("_z.phi").alias("phi"))


def mean_attribution(attributed: DataFrame, names: list[str]) -> DataFrame:
    """feature and importance, the mean size of its share, greatest first."""
    return (_by_feature(attributed, names, []).groupBy("feature").agg(F.avg(F.abs("phi")).alias("importance"))
            .orderBy(F.col("importance").desc(), "feature"))


def dependence(attributed: DataFrame, names: list[str], features: list[str], keep: list[str]) -> DataFrame:
    """A row's value of each of ``features`` against its share: ``keep``, feature, value, phi."""
    return _by_feature(attributed, names, keep).filter(F.col("feature").isin(features))
