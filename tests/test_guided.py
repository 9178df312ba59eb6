"""Guided search: ranges, densities, the same table for the same seed, restarts, better than plain draws."""
import json
import math
import random

import pytest

from tideline.operators import guided as G
from tideline.plans import training as W
from tideline.session import shared_folder

SPACE = {"a": G.Range("float", -5.0, 5.0), "b": G.Range("log", 1e-4, 1.0), "n": G.Range("int", 1, 20)}


def peak(s):
    """One best place: a = 2, b = 0.01, n = 7."""
    return -((s["a"] - 2) ** 2) / 4 - (math.log10(s["b"]) + 2) ** 2 - (s["n"] - 7) ** 2 / 20


def test_ranges_go_there_and_back():
    assert [SPACE["n"].value(p) for p in (0.0, 0.999999, 1.0)] == [1, 20, 20]
    assert SPACE["b"].value(0.0) == pytest.approx(1e-4) and SPACE["b"].value(1.0) == pytest.approx(1.0)
    for r, v in ((SPACE["a"], 1.25), (SPACE["b"], 0.03), (SPACE["n"], 7)):
        assert r.value(r.place(v)) == pytest.approx(v)
    one = G.Range("int", 4, 4)
    assert {one.value(p / 10) for p in range(11)} == {4} and G.Range("float", 2.0, 2.0).place(2.0) == 0.5
    for bad in (("int", 3, 2), ("log", 0.0, 1.0), ("steps", 1, 2)):
        with pytest.raises(ValueError):
            G.Range(*bad)


@pytest.mark.parametrize("places", [[], [0.5], [0.0, 1.0], [0.2, 0.2, 0.21, 0.9]])
def test_a_density_holds_one_and_draws_follow_it(places):
    p, rnd, n = G.Parzen(places), random.Random(1), 4000
    assert sum(p.density((i + 0.5) / n) for i in range(n)) / n == pytest.approx(1.0, abs=1e-3)
    drawn = [p.draw(rnd) for _ in range(n)]
    low = sum(p.density((i + 0.5) / n) for i in range(n // 4)) / n
    assert all(0 <= x <= 1 for x in drawn) and sum(x < 0.25 for x in drawn) / n == pytest.approx(low, abs=0.03)


def test_ranking_of_ties_and_of_values_that_are_no_numbers():
    s = [{"k": i} for i in range(5)]
    good, rest = G.rank(list(zip([0.5, math.nan, 0.7, None, 0.5], s)))
    assert good == [s[2], s[0]] and rest == [s[4], s[1], s[3]]


def test_same_seed_same_table_in_any_order_of_ends(spark):
    import time

    def slow(s):
        time.sleep(random.random() / 20)
        return peak(s)

    a, b = ([tuple(r) for r in G.guided_search(spark, SPACE, f, 14, 3, 3, 4).orderBy("trial").collect()]
            for f in (peak, slow))
    assert a == b and [r[0] for r in a] == list(range(1, 15))


def test_a_stopped_search_goes_on(spark):
    whole = [tuple(r) for r in G.guided_search(spark, SPACE, peak, 12, 5, 2, 4).orderBy("trial").collect()]
    folder, runs = shared_folder(spark, "search"), []

    def breaks(s):
        runs.append(s)
        if len(runs) == 7:
            raise RuntimeError("lost")
        return peak(s)

    with pytest.raises(RuntimeError):
        G.guided_search(spark, SPACE, breaks, 12, 5, 2, 4, folder)
    before = len(runs)
    again = [tuple(r) for r in G.guided_search(spark, SPACE, breaks, 12, 5, 2, 4, folder).orderBy("trial").collect()]
    assert again == whole and len(runs) - before < 12
    kept = len(runs)
    G.guided_search(spark, SPACE, breaks, 12, 5, 2, 4, folder)
    assert len(runs) == kept
    assert G.guided_search(spark, SPACE, breaks, 0).count() == 0


def test_better_than_plain_draws_on_one_peak():
    """Mean best value of 40 trials over 20 seeds; no Spark, proposals alone."""
    def best(start, seed):
        done = []
        for t in range(1, 41):
            s = G.propose(SPACE, done, [], t, seed, start)
            done.append((peak(s), s))
        return max(v for v, _ in done)

    guided = sum(best(10, seed) for seed in range(20)) / 20
    plain = sum(best(99, seed) for seed in range(20)) / 20
    assert guided > plain / 2          # values are below zero: at most half as far from the peak


def test_best_settings(spark):
    t = spark.createDataFrame([(2, 0.5, json.dumps({"depth": 4})), (1, 0.5, json.dumps({"depth": 3})), (3, None, "{}")],
                              G.TRIAL_SCHEMA.replace("value", "f2"))
    assert W.best_settings(t) == {"depth": 3} and W.best_settings(t.limit(0)) is None
