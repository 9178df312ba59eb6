"""Class balancing: copies, draws, synthetic rows, boundary cleaning."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tideline import settings as S
from tideline.operators.neighbours import nearest
from tideline.operators.splits import shuffled
from tideline.session import cut_lineage

ID = ("zone", "time_6h")


def class_sizes(df: DataFrame, label: str = S.TARGET) -> tuple[int, int, int]:
    """(rows of the larger class, rows of the smaller class, label of the smaller class)."""
    r = df.agg(F.count_if(F.col(label) == 0).alias("a"), F.count_if(F.col(label) == 1).alias("b")).first()
    return max(r["a"], r["b"]), min(r["a"], r["b"]), int(r["b"] <= r["a"])


def _repeat(df: DataFrame, times: Column, name: str = "copy") -> DataFrame:
    """``times`` copies of a row, numbered from 0; built in chunks, so a row that is
    copied very often is not one long array."""
    step = 4096
    x = df.withColumn("_times", times).filter(F.col("_times") > 0)
    x = x.withColumn("_c", F.explode(F.sequence(F.lit(0), F.floor((F.col("_times") - 1) / step).cast("int"))))
    last = F.least(F.col("_times") - 1, (F.col("_c") + 1) * step - 1).cast("int")
    return x.withColumn(name, F.explode(F.sequence((F.col("_c") * step).cast("int"), last))).drop("_times", "_c")


class TooFewMinorityRows(ValueError):
    """A class has too few rows, or too few near the other class, to draw or synthesise from."""


def over_sample(df: DataFrame, label: str = S.TARGET, identity=ID, seed: int = 42, one_class: str = "raise") -> DataFrame:
    """Repeat minority rows until both classes have the same size.

    Every row is repeated equally often; the remainder goes to rows drawn by hash.
    Without a minority row nothing can be repeated: ``one_class`` "raise" says so,
    "keep" returns the rows of the only class as they are.
    """
    if one_class not in ("raise", "keep"):
        raise ValueError(f"unknown choice {one_class!r}")
    many, few, rare = class_sizes(df, label)
    if few == 0 and one_class == "keep":
        return df.filter(F.col(label) == 1 - rare)
    if few == 0:
        raise TooFewMinorityRows("there is no minority row to repeat")
    small = shuffled(df.filter(F.col(label) == rare), [], list(identity), seed)
    times = F.lit(many // few) + (F.col("draw") < many % few).cast("int")
    return df.filter(F.col(label) == 1 - rare).unionByName(_repeat(small, times).drop("draw", "copy"))


def under_sample(df: DataFrame, label: str = S.TARGET, identity=ID, seed: int = 42) -> DataFrame:
    """Keep as many majority rows as there are minority rows, drawn by hash."""
    _, few, rare = class_sizes(df, label)
    big = shuffled(df.filter(F.col(label) == 1 - rare), [], list(identity), seed)
    return big.filter(F.col("draw") < few).drop("draw").unionByName(df.filter(F.col(label) == rare))


def _blend(rows: DataFrame, times: Column, near: DataFrame, minority: DataFrame, rare: int, seed: int) -> DataFrame:
    """Synthetic rows on the line from a minority row to one of its neighbours."""
    copies = _repeat(rows, times)
    pick = F.pmod(F.xxhash64(F.lit(seed), "id", "copy"), F.col("_have")) + 1
    have = near.groupBy("id").agg(F.max("place").alias("_have"))
    copies = copies.join(have, "id").withColumn("place", pick.cast("int"))
    other = near.select("id", "place", "neighbour").join(
        minority.select(F.col("id").alias("neighbour"), F.col("vec").alias("_to")), "neighbour")
    share = F.pmod(F.xxhash64(F.lit(seed + 1), "id", "copy"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    vec = F.zip_with("vec", "_to", lambda a, b: a + (b - a) * F.col("_share"))
    return (copies.join(other, ["id", "place"]).withColumn("_share", share)
            .select(F.concat_ws("#", F.col("id").cast("string"), F.col("copy").cast("string")).alias("id"),
                    vec.alias("vec"), F.lit(rare).alias("label")))


def _as_text_id(df: DataFrame) -> DataFrame:
    return df.select(F.col("id").cast("string").alias("id"), F.col("vec").cast("array<double>").alias("vec"),
                     F.col("label").cast("int").alias("label"))


def smote(df: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """(id, vec, label) plus synthetic minority rows up to equal class sizes."""
    x = _as_text_id(df)
    many, few, rare = class_sizes(x, "label")
    if few < 2:
        raise TooFewMinorityRows("synthesis needs at least two minority rows")
    minority = x.filter(F.col("label") == rare)
    near = nearest(minority, minority, min(k, few - 1))
    missing = many - few
    rows = shuffled(minority, [], ["id"], seed)
    times = F.lit(missing // few) + (F.col("draw") < missing % few).cast("int")
    return x.unionByName(_blend(rows, times, near, minority, rare, seed))


def adasyn(df: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """Like ``smote``, with more synthetic rows where the majority is close.

    Raises when no minority row has a majority neighbour.
    """
    x = _as_text_id(df)
    many, few, rare = class_sizes(x, "label")
    if few < 2:
        raise TooFewMinorityRows("synthesis needs at least two minority rows")
    minority = x.filter(F.col("label") == rare)
    around = nearest(minority, x, k).join(
        x.select(F.col("id").alias("neighbour"), F.col("label").alias("_l")), "neighbour")
    share = around.groupBy("id").agg((F.sum(F.when(F.col("_l") != rare, 1).otherwise(0)) / F.lit(k)).alias("_r"))
    whole = share.agg(F.sum("_r")).first()[0]
    if not whole:
        raise TooFewMinorityRows("no minority row has a majority neighbour")
    rows = minority.join(share, "id")
    times = F.rint(F.col("_r") / F.lit(float(whole)) * F.lit(float(many - few))).cast("int")
    near = nearest(minority, minority, min(k, few - 1))
    return x.unionByName(_blend(rows, times, near, minority, rare, seed))


def tomek_links(df: DataFrame) -> DataFrame:
    """(id, neighbour) pairs of opposite class that are each other's nearest, majority first."""
    x = _as_text_id(df)
    rare = class_sizes(x, "label")[2]
    one = nearest(x, x, 1).select("id", "neighbour")
    back = one.select(F.col("id").alias("neighbour"), F.col("neighbour").alias("id"))
    labels = x.select("id", F.col("label").alias("_a"))
    return (one.join(back, ["id", "neighbour"]).join(labels, "id")
            .join(labels.select(F.col("id").alias("neighbour"), F.col("_a").alias("_b")), "neighbour")
            .filter((F.col("_a") == 1 - rare) & (F.col("_b") == rare)).select("id", "neighbour"))


def drop_tomek(df: DataFrame, both: bool = False) -> DataFrame:
    """Remove the majority end of every link, or both ends."""
    x = _as_text_id(df)
    links = cut_lineage(tomek_links(x)) if both else tomek_links(x)
    gone = links.select("id")
    if both:
        gone = gone.unionByName(links.select(F.col("neighbour").alias("id")))
    return x.join(gone.distinct(), "id", "left_anti")


def smote_tomek(df: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """``smote``, then both ends of every link removed; the synthetic rows are written once, as several steps read them."""
    return drop_tomek(cut_lineage(smote(df, k, seed)), both=True)
