"""Second-order boosting against a plain grower, and attribution against all subsets."""
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.operators import attribution as A, boosting as B
from tideline.session import shared_folder


@pytest.fixture(scope="module")
def points(spark):
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, (700, 5)).astype(float)
    y = ((x[:, 0] > 5) ^ (x[:, 1] > 8) | (rng.random(700) < 0.1)).astype(float)
    w = np.where(y == 1, 2.5, 1.0)
    df = spark.createDataFrame([(i, a.tolist(), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x, y, w))],
                               "id int, v array<double>, is_flood double, weight double").withColumn(
        "features", array_to_vector("v")).repartition(5).cache()
    return x, y, w, df


EXACT = dict(step=0.3, row_share=1.0, column_share=1.0, min_weight=4.0, l1=0.7, l2=2.0, gamma=1.5)


def plain(x, y, w, rounds, depth, step, min_weight, l1, l2, gamma, **_):
    """(gains of all kept splits, margins) by trying every threshold on the rows themselves."""
    margin, gains = np.zeros(len(x)), []

    def soft(g):
        return np.sign(g) * max(abs(g) - l1, 0)

    def grow(rows, g, h, level):
        G, H = g[rows].sum(), h[rows].sum()
        leaf = ("leaf", -step * soft(G) / (H + l2))
        best = (1e-6, None)
        for f in range(x.shape[1]) if level < depth else ():
            for cut in np.unique(x[:, f])[:-1]:
                left = rows[x[rows, f] <= cut]
                a, b = g[left].sum(), h[left].sum()
                if b < min_weight or H - b < min_weight:
                    continue
                gain = soft(a) ** 2 / (b + l2) + soft(G - a) ** 2 / (H - b + l2) - soft(G) ** 2 / (H + l2)
                if gain > best[0] + 1e-9:
                    best = (gain, (f, cut))
        if best[1] is None:
            return leaf
        f, cut = best[1]
        left, right = (grow(r, g, h, level + 1) for r in (rows[x[rows, f] <= cut], rows[x[rows, f] > cut]))
        if left[0] == right[0] == "leaf" and best[0] < gamma:
            return leaf
        return ("split", best[0], f, cut, left, right)

    def walk(tree, rows, out):
        if tree[0] == "leaf":
            out[rows] += tree[1]
            return
        gains.append(tree[1])
        _, _, f, cut, left, right = tree
        walk(left, rows[x[rows, f] <= cut], out)
        walk(right, rows[x[rows, f] > cut], out)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        walk(grow(np.arange(len(x)), w * (p - y), w * p * (1 - p), 0), np.arange(len(x)), margin)
    return sorted(gains), margin


@pytest.mark.parametrize("fit_rows", [None, 10 ** 6])
def test_gains_and_margins_of_a_plain_grower(points, monkeypatch, fit_rows):
    x, y, w, df = points
    monkeypatch.setattr(B, "EVERY", 3)               # margins are written twice on the way
    model = B.Boosting(rounds=7, depth=3, fit_rows=fit_rows, **EXACT).fit(df)
    gains, margin = plain(x, y, w, 7, 3, **EXACT)
    got = sorted(g for t in model.trees for g, f in zip(t.gain, t.feature) if f >= 0 and g > 0)
    kept = sorted(t.gain[n] for t in model.trees for n in _reached(t) if t.feature[n] >= 0)
    assert np.allclose(kept, gains) and len(got) >= len(kept)
    assert np.allclose(model.margins(x), margin)
    scored = {r.id: r.risk_score for r in model.score(df).collect()}
    assert np.allclose([scored[i] for i in range(len(x))], 1 / (1 + np.exp(-margin)))


def _reached(tree):
    out, stack = [], [0]
    while stack:
        n = stack.pop()
        out.append(n)
        if tree.feature[n] >= 0:
            stack += [tree.left[n], tree.right[n]]
    return out


@pytest.mark.parametrize("fit_rows", [None, 10 ** 6])
def test_members_are_models_of_their_rows(points, fit_rows):
    x, y, w, df = points
    halves = [F.col("id") % 2 == 0, F.col("id") % 2 == 1]
    both = B.Boosting(rounds=3, depth=2, fit_rows=fit_rows, **EXACT).fit_members(df, halves)
    for half, model in zip((0, 1), both):
        own = np.arange(len(x)) % 2 == half
        _, margin = plain(x[own], y[own], w[own], 3, 2, **EXACT)
        assert np.allclose(model.margins(x[own]), margin)


def test_shares_are_seeded_and_bound(points):
    _, _, _, df = points
    one, two, jobs = (B.Boosting(rounds=4, depth=3, min_weight=2, l1=0, l2=1, gamma=0, fit_rows=n).fit(
        df.orderBy("id").coalesce(1)) for n in (10 ** 6, 10 ** 6, None))
    assert [t.value for t in one.trees] == [t.value for t in two.trees]
    assert all(np.allclose(a.value, b.value) for a, b in zip(one.trees, jobs.trees))
    few = B.Boosting(rounds=1, fit_rows=100, row_share=1.0).fit(df)
    assert 20 < few.trees[0].cover[0] / 0.25 < 260   # about a hundred rows, weights of 1 and 2.5
    assert all(len({f for f in t.feature if f >= 0}) <= 2 for t in one.trees)      # 0.44 of five columns
    draws = B._draw(np.arange(20000), 42, 3)
    assert abs(draws.mean() - 0.5) < 0.01 and abs(np.corrcoef(draws, B._draw(np.arange(20000), 42, 4))[0, 1]) < 0.03


def test_save_load_and_nodes(spark, points):
    x, _, _, df = points
    model = B.Boosting(rounds=2, depth=2, **EXACT).fit(df)
    path = shared_folder(spark, "trees")
    model.save(spark, path)
    assert np.array_equal(B.BoostedTrees.load(spark, path).margins(x), model.margins(x))
    nodes = model.nodes(spark)
    assert nodes.count() == sum(len(t.feature) for t in model.trees)
    assert nodes.filter("feature >= 0 AND left <= node").count() == 0


def test_nothing_to_learn(spark, points):
    _, _, _, df = points
    with pytest.raises(ValueError):
        B.Boosting(rounds=1).fit(df.limit(0))
    flat = B.Boosting(rounds=2, **EXACT).fit(df.withColumn("features", F.first("features").over(
        __import__("pyspark.sql").sql.Window.partitionBy(F.lit(1)))))
    assert all(t.feature == [-1] for t in flat.trees)


def subsets(tree, row, n):
    """Shapley values of one row by enumerating all feature subsets."""
    def value(known, node=0):
        f = tree.feature[node]
        if f < 0:
            return tree.value[node]
        low, high = tree.left[node], tree.right[node]
        if f in known:
            return value(known, low if row[f] <= tree.threshold[node] else high)
        return (tree.cover[low] * value(known, low) + tree.cover[high] * value(known, high)) / tree.cover[node]
    out = np.zeros(n)
    for i in range(n):
        rest = [j for j in range(n) if j != i]
        for k in range(n):
            for s in combinations(rest, k):
                out[i] += factorial(k) * factorial(n - k - 1) / factorial(n) * (value({*s, i}) - value(set(s)))
    return out, value(set())


def test_attribution_is_the_sum_over_subsets(points):
    x, _, _, df = points
    model = B.Boosting(rounds=5, depth=3, **EXACT).fit(df)
    got = A.shapley(model, x[:25])
    for row, phi in zip(x[:25], got):
        want = [subsets(t, row, 5) for t in model.trees]
        assert np.allclose(phi, sum(w for w, _ in want))
    rows = A.attributions(model, df, ["id"]).collect()
    assert len(rows) == len(x) and all(abs(sum(r.phi) + r.base - r.margin) < 1e-9 for r in rows)
    names = ["a", "b", "c", "d", "e"]
    ranked = A.mean_attribution(A.attributions(model, df, []), names).collect()
    assert {r.feature for r in ranked[:2]} == {"a", "b"}
    want = np.abs(A.shapley(model, x)).mean(axis=0)
    assert np.allclose([r.importance for r in ranked], sorted(want, reverse=True))
    some = A.dependence(A.attributions(model, df, ["id"]), names, ["b"], ["id"]).collect()
    assert sorted((r.id, r.value) for r in some) == [(i, v) for i, v in enumerate(x[:, 1])]


def test_a_feature_twice_on_a_path():
    t = B.Tree()
    for _ in range(7):
        t.add(0.0, 0.0)
    t.feature, t.threshold = [0, 0, 1, -1, -1, -1, -1], [5.0, 2.0, 1.0, 0, 0, 0, 0]
    t.left, t.right = [1, 3, 5, -1, -1, -1, -1], [2, 4, 6, -1, -1, -1, -1]
    t.value, t.cover = [0, 0, 0, 1.0, -2.0, 4.0, 0.5], [10.0, 6.0, 4.0, 2.5, 3.5, 1.0, 3.0]
    rows = np.array([[a, b] for a in (1.0, 2.0, 3.0, 6.0) for b in (0.0, 2.0)])
    got = A.shapley(B.BoostedTrees([t], 2), rows)
    for row, phi in zip(rows, got):
        want, base = subsets(t, row, 2)
        assert np.allclose(phi, want) and np.isclose(base, A.expected(t))
