"""Isotonic regression in groups against plain pooling."""
import random

import numpy as np
import pytest

from tideline.operators import isotonic as I


def plain(points):
    """score -> rate by pooling one list."""
    by = {}
    for s, y in points:
        w, t = by.get(s, (0, 0))
        by[s] = (w + 1, t + y)
    blocks = []
    for s in sorted(by):
        blocks.append([*by[s], [s]])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][0] >= blocks[-1][1] / blocks[-1][0]:
            w, t, own = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w, blocks[-1][1] + t, blocks[-1][2] + own]
    return {s: t / w for w, t, own in blocks for s in own}


def case(kind):
    rng = random.Random(kind)
    if kind == "constant":
        return [(0.5, i % 3 == 0) for i in range(30)]
    if kind == "falling":
        return [(i / 100, i < 50) for i in range(100)]
    if kind == "rising":
        return [(i / 100, i > 50) for i in range(100)]
    return [(round(rng.random(), 2), rng.random() < 0.3 + 0.4 * rng.random()) for _ in range(400)]


@pytest.mark.parametrize("rows", [4, 7, I.ROWS])
@pytest.mark.parametrize("kind", ["constant", "falling", "rising", "random"])
def test_groups_give_plain_pooling(spark, kind, rows):
    points = [(s, int(y)) for s, y in case(kind)]
    df = spark.createDataFrame(points, "risk_score double, is_flood int").repartition(3)
    blocks = I.fit(df, rows=rows).toPandas().sort_values("low")
    want = plain(points)
    got = {s: b.rate for s in want for b in blocks.itertuples() if b.low <= s <= b.high}
    assert got == pytest.approx(want) and blocks.weight.sum() == len(points)
    assert (np.diff(blocks.rate) > 0).all() and (blocks.low.to_numpy()[1:] > blocks.high.to_numpy()[:-1]).all()


def test_apply_between_and_beyond(spark):
    points = [(0.1, 0), (0.2, 0), (0.4, 1), (0.6, 0), (0.8, 1), (None, 1), (0.9, None)]
    df = spark.createDataFrame(points, "risk_score double, is_flood int")
    blocks = I.fit(df)
    ask = [0.0, 0.1, 0.15, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 2.0, None]
    got = I.apply(blocks, spark.createDataFrame([(i, s, "x") for i, s in enumerate(ask)], "id int, risk_score double, s string"))
    assert got.columns == ["id", "risk_score", "s", "rate"]
    rate = {r.id: r.rate for r in got.collect()}
    want = np.interp([s for s in ask if s is not None], [0.1, 0.2, 0.4, 0.6, 0.8], [0, 0, 0.5, 0.5, 1])
    assert [rate[i] for i in range(len(ask) - 1)] == pytest.approx(list(want)) and rate[len(ask) - 1] is None
    assert I.fit(df.limit(0)).count() == 0
