"""Ordered computations that do not put a whole key into one task.

A zone may hold a third of the history, and a score table has no key at all, so
``Window.partitionBy("zone")`` or ``Window.orderBy("score")`` would be one huge
task. Here every ordered key is cut into contiguous blocks: a running value is
the value inside the block plus the total of the earlier blocks, and a bounded
frame is computed on blocks that carry the last rows of the block before them.
Both give exactly what the plain window gives.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideline.session import cut_lineage

BLOCK_DAYS = 1024          # 4,096 six-hour slots
ROWS_PER_BLOCK = 4096
BLOCK = "_block"           # stored part number of a staged frame

_MERGE = {"sum": F.sum, "max": F.max, "min": F.min}


def time_block(time, days: int = BLOCK_DAYS) -> Column:
    """Number of the ``days``-long block a timestamp falls in."""
    col = F.col(time) if isinstance(time, str) else time
    return F.floor(F.datediff(F.to_date(col), F.lit("1970-01-01").cast("date")) / F.lit(days))


def staged_blocks(df: DataFrame, cols: list[str], parts: int | None = None) -> tuple[DataFrame, Column]:
    """``df`` written in the order of ``cols``, and the block of each row.

    A block is one part of a range shuffle; its number is stored with the rows,
    so every later read cuts at the same places. Spark picks the number of parts
    from its shuffle settings unless ``parts`` does. Staging also runs what lies
    below the block totals and the rows once.
    """
    ranged = df.repartitionByRange(*cols) if parts is None else df.repartitionByRange(parts, *cols)
    return cut_lineage(ranged.withColumn(BLOCK, F.spark_partition_id())), F.col(BLOCK)


def running(df: DataFrame, keys: list[str], order: list, block: Column,
            values: dict[str, tuple[Column, str]], totals: list[str] = (),
            before: list[str] = ()) -> DataFrame:
    """Add running values per ``keys`` in ``order``, the current row included.

    ``values`` maps an output name to (column, "sum" | "max" | "min"). ``block``
    must follow ``order``. Names in ``totals`` also get ``<name>_total`` over
    the whole key; names in ``before`` get the value without the current row.
    The block table has one row per key and block; only it sees a whole key.
    Key values must not be null. The join finds the rows where the local window
    left them, so the data is shuffled once.
    """
    x = df.withColumn("_b", block)
    for name, (col, _) in values.items():
        x = x.withColumn(f"_v_{name}", col)
    local = Window.partitionBy(*keys, "_b").orderBy(*order)
    upto, prior = local.rowsBetween(Window.unboundedPreceding, 0), local.rowsBetween(
        Window.unboundedPreceding, -1)
    summary = x.groupBy(*keys, "_b").agg(
        *[_MERGE[how](f"_v_{n}").alias(f"_t_{n}") for n, (_, how) in values.items()])
    whole = Window.partitionBy(*[F.col(k) for k in keys] or [F.lit(0)])
    ahead = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = summary.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_b").alias("_k_b"),
        *[_MERGE[how](f"_t_{n}").over(ahead).alias(f"_o_{n}") for n, (_, how) in values.items()],
        *[_MERGE[values[n][1]](f"_t_{n}").over(whole).alias(f"{n}_total") for n in totals])

    def combine(how, a, b):
        if how == "sum":
            return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
        return (F.greatest if how == "max" else F.least)(a, b)

    inside = x.select(
        "*",
        *[_MERGE[how](f"_v_{n}").over(upto).alias(f"_w_{n}") for n, (_, how) in values.items()],
        *[_MERGE[values[n][1]](f"_v_{n}").over(prior).alias(f"_p_{n}") for n in before])
    on = reduce(lambda a, b: a & b,
                [F.col(k) == F.col(f"_k_{k}") for k in keys]
                + [F.col("_b") == F.col("_k_b")])
    joined = inside.join(offsets, on, "left")
    return joined.select(
        *[F.col(c) for c in df.columns if c != BLOCK],
        *[combine(how, F.col(f"_o_{n}"), F.col(f"_w_{n}")).alias(n) for n, (_, how) in values.items()],
        *[combine(values[n][1], F.col(f"_o_{n}"), F.col(f"_p_{n}")).alias(f"{n}_before")
          for n in before],
        *[F.col(f"{n}_total") for n in totals])


def row_index(df: DataFrame, keys: list[str], order: list, block: Column,
              name: str = "row_index") -> DataFrame:
    """0-based position of each row inside its key."""
    out = running(df, keys, order, block, {"_seen": (F.lit(1).cast("bigint"), "sum")})
    return out.withColumn(name, F.col("_seen") - 1).drop("_seen")


def halo_windows(df: DataFrame, keys: list[str], order: str, back: int, build,
                 block: Column | None = None, rows: int = ROWS_PER_BLOCK) -> DataFrame:
    """Evaluate row-based window columns that look at most ``back`` rows back.

    ``build(window)`` returns the columns to add for a window without a frame.
    Rows are counted per key, grouped in blocks of ``rows``, and the last
    ``back`` rows of a block are also sent to the next one, where they are used
    and then dropped. A missing slot shifts the frame, as with a plain window.
    """
    if rows <= back:
        raise ValueError("a block must be longer than the frame")
    x = row_index(df, keys, [order], time_block(order) if block is None else block, "_ix")
    home = F.floor(F.col("_ix") / rows)
    near_end = F.pmod(F.col("_ix"), F.lit(rows)) >= rows - back
    x = (x.withColumn("_home", home)
          .withColumn("_at", F.explode(F.when(near_end, F.array("_home", F.col("_home") + 1))
                                       .otherwise(F.array("_home")))))
    window = Window.partitionBy(*keys, "_at").orderBy("_ix")
    return (x.select("*", *build(window))
             .filter(F.col("_at") == F.col("_home"))
             .drop("_ix", "_home", "_at"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, points: dict[str, float],
                    parts: int | None = None) -> DataFrame:
    """Interpolated quantiles per key, without a per-key buffer.

    Equal values are counted first; a running count then tells which value
    holds the two ranks around each quantile.
    """
    counts = (df.filter(F.col(value).isNotNull()).groupBy(*keys, value)
                .agg(F.count(F.lit(1)).alias("_n")))
    counts, block = staged_blocks(counts, keys + [value], parts)
    ranked = running(counts, keys, [value], block, {"_c": (F.col("_n"), "sum")},
                     totals=["_c"])
    return ranked.groupBy(*keys).agg(*quantile_columns("_c", "_n", "_c_total", value, points))


def quantile_columns(cum, n, total, value, points: dict[str, float]) -> list[Column]:
    """Aggregates that pick and interpolate quantiles from a running count."""
    first, last = F.col(cum) - F.col(n), F.col(cum) - 1
    out = []
    for name, q in points.items():
        spot = (F.col(total) - 1) * F.lit(float(q))
        lo = F.floor(spot)
        hi = F.least(lo + 1, F.col(total) - 1)
        low = F.max(F.when((first <= lo) & (lo <= last), F.col(value)))
        high = F.max(F.when((first <= hi) & (hi <= last), F.col(value)))
        share = F.max(spot - lo)
        out.append((low + (high - low) * share).alias(name))
    return out
