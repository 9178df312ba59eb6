"""Guided search over learner settings by tree-structured Parzen estimates.

Past trials are split into a good share and the rest. Each setting gets two densities, one over the good values and one
over the others, and the next value is the candidate of the good density with the largest ratio. Trials run side by
side as Spark jobs; a trial is a row of a stored table, so a search that was stopped goes on where it ended.
"""
from __future__ import annotations

import json
import math
import random
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tideline.session import shared_folder

TRIAL_SCHEMA = "trial int, value double, settings string"
GOOD_SHARE = 0.2      # of the finished trials, at least two
CANDIDATES = 24       # drawn from the good density for each setting


class Range:
    """One searched setting: whole numbers, plain numbers, or numbers on a log scale, ends included."""

    def __init__(self, kind: str, low: float, high: float):
        if kind not in ("int", "float", "log"):
            raise ValueError(f"unknown kind of range {kind}")
        if low > high or (kind == "log" and low <= 0):
            raise ValueError(f"no range from {low} to {high}")
        self.kind, self.low, self.high = kind, low, high
        # a whole number owns the half unit on either side of it
        self._a, self._z = {"int": (low - 0.5, high + 0.5), "float": (low, high),
                            "log": (math.log(low) if low > 0 else 0.0, math.log(high) if high > 0 else 0.0)}[kind]

    def place(self, value: float) -> float:
        """The value as a share of the range."""
        if self._a == self._z:
            return 0.5
        return ((math.log(value) if self.kind == "log" else value) - self._a) / (self._z - self._a)

    def value(self, place: float):
        at = self._a + place * (self._z - self._a)
        if self.kind == "int":
            return int(min(self.high, max(self.low, round(at))))
        return min(self.high, max(self.low, math.exp(at) if self.kind == "log" else at))


class Parzen:
    """Equal mixture of a flat part and one normal, cut to 0..1, for each seen place.

    A normal is as wide as the larger gap to its neighbours (the ends of the range count as such), within limits that
    shrink with the number of places.
    """

    def __init__(self, places: list[float]):
        self.places = sorted(places)
        edges = [0.0, *self.places, 1.0]
        least = 1.0 / min(100, len(self.places) + 2)
        self.widths = [min(1.0, max(least, edges[i] - edges[i - 1], edges[i + 1] - edges[i]))
                       for i in range(1, len(edges) - 1)]
        self.inside = [_below((1 - p) / w) - _below(-p / w) for p, w in zip(self.places, self.widths)]

    def density(self, x: float) -> float:
        parts = [math.exp(-0.5 * ((x - p) / w) ** 2) / (w * math.sqrt(2 * math.pi) * i)
                 for p, w, i in zip(self.places, self.widths, self.inside)]
        return (1.0 + sum(parts)) / (1 + len(parts))

    def draw(self, rnd: random.Random) -> float:
        i = rnd.randrange(len(self.places) + 1)
        if i == len(self.places):
            return rnd.random()
        while True:
            x = rnd.gauss(self.places[i], self.widths[i])
            if 0 <= x <= 1:
                return x


def _below(z: float) -> float:
    return 0.5 * (1 + math.erf(z / math.sqrt(2)))


def rank(finished: list[tuple[float, dict]]) -> tuple[list[dict], list[dict]]:
    """Settings of the good trials and of the others; a value that is no number counts as the worst."""
    worth = lambda v: -math.inf if v is None or math.isnan(v) else v
    best = sorted(finished, key=lambda t: -worth(t[0]))    # stable: the earlier trial of two equals is the better
    n = max(2, math.ceil(GOOD_SHARE * len(best)))
    return [s for _, s in best[:n]], [s for _, s in best[n:]]


def propose(space: dict[str, Range], finished: list[tuple[float, dict]], running: list[dict], number: int, seed: int,
            start: int) -> dict:
    """Settings of a trial: a plain draw while fewer than ``start`` trials are finished, guided after that.

    Trials still running count as not good, which keeps side-by-side trials apart.
    """
    rnd = random.Random(f"{seed}/{number}")
    if len(finished) < max(start, 2):
        return {name: r.value(rnd.random()) for name, r in space.items()}
    good, rest = rank(finished)
    out = {}
    for name, r in space.items():
        near, far = (Parzen([r.place(s[name]) for s in part]) for part in (good, rest + running))
        tried = [near.draw(rnd) for _ in range(CANDIDATES)]
        out[name] = r.value(max(tried, key=lambda x: near.density(x) / far.density(x)))
    return out


def guided_search(spark: SparkSession, space: dict[str, Range], run, trials: int = 60, seed: int = 42, workers: int = 2,
                  start: int = 10, folder: str | None = None) -> DataFrame:
    """Table of trials (trial, value, settings as JSON); ``run(settings)`` gives the value to make large.

    Trial t may begin when all trials up to t - workers are finished and is drawn from exactly these, so the table
    depends on the seed and the number of workers only, not on which trial ends first. Each finished trial is written
    to ``folder`` at once; called again with the same folder, only the missing ones are run. No trials: an empty table.
    """
    folder = folder or shared_folder(spark, "search")
    done = {r["trial"]: (r["value"], json.loads(r["settings"])) for r in _stored(spark, folder, trials)}

    def one(number: int, settings: dict) -> tuple[float, dict]:
        value = run(dict(settings))
        row = (number, None if value is None else float(value), json.dumps(settings))
        (spark.createDataFrame([row], TRIAL_SCHEMA).coalesce(1).write.mode("overwrite")
         .parquet(f"{folder}/part={number:05d}"))
        return row[1], settings

    begun: dict[int, tuple[dict, Future | None]] = {}
    with ThreadPoolExecutor(workers) as pool:
        try:
            for t in range(1, trials + 1):
                if t in done:
                    begun[t] = (done[t][1], None)
                    continue
                finished = []
                for u in range(1, t - workers + 1):
                    task = begun[u][1]
                    finished.append(done[u] if task is None else task.result())
                running = [begun[u][0] for u in range(max(1, t - workers + 1), t)]
                settings = propose(space, finished, running, t, seed, start)
                begun[t] = (settings, pool.submit(one, t, settings))
            for _, task in begun.values():
                if task is not None:
                    task.result()
        except BaseException:
            pool.shutdown(wait=True, cancel_futures=True)
            raise
    rows = [(r["trial"], r["value"], r["settings"]) for r in _stored(spark, folder, trials)]
    return spark.createDataFrame(rows, TRIAL_SCHEMA)


def _stored(spark: SparkSession, folder: str, trials: int) -> list:
    """Finished trials up to the wanted number; a part without its success mark was cut short and is run again."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/part=*/_SUCCESS")
    marks = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    parts = [m.getPath().getParent().toString() for m in marks]
    if not parts:
        return []
    rows = spark.read.schema(TRIAL_SCHEMA).parquet(*parts).collect()
    return sorted((r for r in rows if r["trial"] <= trials), key=lambda r: r["trial"])
