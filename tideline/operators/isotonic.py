"""Isotonic regression over ordered blocks, without one task that sees all scores.

Equal scores are one block of weight and sum first. Pool-adjacent-violators then
runs inside groups of ``ROWS`` neighbouring blocks and leaves blocks with rising
rates. The cuts between groups move by half a group from round to round, so any
two neighbours meet in one of two rounds; when two rounds in a row pool nothing
there is no violator left. Pooling is associative, so the result does not depend
on the groups.

The fit is a table of blocks. Applying it puts scores and blocks in one order by
a range shuffle and carries the last block along, with straight lines between
the end of a block and the start of the next one; beyond the ends it is flat.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tideline import settings as S
from tideline.operators.scale import row_index, running, staged_blocks

ROWS = 100_000             # blocks pooled by one task
BLOCKS = "low double, high double, weight double, total double"


def pooled(weight: np.ndarray, total: np.ndarray) -> np.ndarray:
    """First row of every block once neighbours that do not rise are pooled."""
    first, w, t = [], [], []
    for i, (a, b) in enumerate(zip(weight.tolist(), total.tolist())):
        at = i
        while w and t[-1] * a >= b * w[-1]:          # the mean before is not below this one
            a, b, at = a + w.pop(), b + t.pop(), first.pop()
        first.append(at)
        w.append(a)
        t.append(b)
    return np.array(first, np.int64)


def _pool(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("low")
    first = pooled(part["weight"].to_numpy(), part["total"].to_numpy())
    last = np.r_[first[1:] - 1, len(part) - 1]
    return pd.DataFrame({"low": part["low"].to_numpy()[first], "high": part["high"].to_numpy()[last],
                         "weight": np.add.reduceat(part["weight"].to_numpy(), first),
                         "total": np.add.reduceat(part["total"].to_numpy(), first)})


def fit(df: DataFrame, score: str = "risk_score", label: str = S.TARGET, weight: str | None = None,
        rows: int = ROWS) -> DataFrame:
    """low, high, weight, rate: the blocks of the best rising rate, in no order; rows without score or label are left out."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    blocks = (df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).cast("double").alias("low"))
                .agg(F.sum(w).alias("weight"), F.sum(w * F.col(label)).alias("total"))
                .filter("weight > 0").select("low", F.col("low").alias("high"), "weight", "total"))
    turn = still = 0
    while True:
        stored, block = staged_blocks(blocks, ["low"])
        count = stored.count()
        if turn and count == before:
            still += 1
        else:
            still = 0
        if still == 2 or turn and before <= rows and turn % 2 == 1:      # a round whose only group held all blocks
            return stored.select("low", "high", "weight", (F.col("total") / F.col("weight")).alias("rate"))
        placed = row_index(stored, [], ["low"], block, "at")
        group = F.floor((F.col("at") + (rows // 2 if turn % 2 else 0)) / rows)
        blocks = placed.groupBy(group.alias("group")).applyInPandas(_pool, BLOCKS)
        before, turn = count, turn + 1


def apply(blocks: DataFrame, df: DataFrame, score: str = "risk_score", out: str = "rate") -> DataFrame:
    """``df`` with the rate of its score; null scores have none."""
    knots = (blocks.select(F.explode(F.array(F.struct(F.col("low").alias("s"), "rate"),
                                             F.struct(F.col("high").alias("s"), "rate"))).alias("k"))
                   .select("k.s", "k.rate").distinct())
    cols = df.columns
    rows = df.select(F.struct(*cols).alias("row"), F.col(score).cast("double").alias("s")).filter("s IS NOT NULL")
    both = rows.select("s", F.lit(1).alias("kind"), F.lit(None).cast("double").alias("rate"), "row").unionAll(
        knots.select("s", F.lit(0).alias("kind"), "rate", F.lit(None).cast(rows.schema["row"].dataType)))
    order = ["s", "kind"]
    stored, block = staged_blocks(both, order)
    knot = F.when(F.col("kind") == 0, F.struct("s", "rate"))
    upto = running(stored, [], order, block, {"last": (knot, "max")})
    down = upto.withColumns({"_down": -F.col("s"), "_kind": -F.col("kind")})
    again, back = staged_blocks(down, ["_down", "_kind"])
    found = running(again, [], ["_down", "_kind"], back, {"next": (knot, "min")}).filter("kind = 1")
    share = (F.col("s") - F.col("last.s")) / (F.col("next.s") - F.col("last.s"))
    between = F.col("last.rate") + (F.col("next.rate") - F.col("last.rate")) * share
    rate = (F.when(F.col("last").isNull(), F.col("next.rate")).when(F.col("next").isNull(), F.col("last.rate"))
             .when(F.col("last.s") == F.col("s"), F.col("last.rate")).otherwise(between))
    scored = found.select(*[F.col(f"row.`{c}`") for c in cols], rate.alias(out))
    missing = df.filter(F.col(score).cast("double").isNull()).select(*cols, F.lit(None).cast("double").alias(out))
    return scored.unionAll(missing)
