"""Host-level quality rules, with DataFrame functions only.

Rules are evaluated on each whole text, failures are counted per host, a beta
prior is fitted to the hosts' rates by moments, and every host's rate is drawn
towards the prior mean before the verdict is joined back to its documents.

Defined cases: a null text has no words and fails; a null host is a host of its
own; an empty table gives no rows; repeated rows count and return as often as
they come; further columns of the input are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tideline.llm.common import SPACES, whole
from tideline.session import cut_lineage

MIN_WORDS = 50
MAX_REPEATED = 50          # percent of words in repeated three-word windows
HOST_LIMIT = 0.5           # a host goes if its shrunk failure rate is above this


def rule_counts(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the counts of each text.

    Windows are compared by a 64-bit hash inside one text. Sorting them with
    their positions keeps the work at n log n however often a window returns.
    """
    x = docs.select(*keep, whole(text).alias("_t"))
    x = x.select(*keep, "_t", F.array_remove(F.split("_t", f"{SPACES}+"), "").alias("_w"))
    x = x.select(
        *keep, "_t", "_w",
        F.expr("""sort_array(if(size(_w) < 3, array(),
                  transform(sequence(0, size(_w) - 3),
                            i -> struct(xxhash64(get(_w, i), get(_w, i + 1), get(_w, i + 2)) AS h, i AS i))))""")
        .alias("_s"),
        F.filter(F.split("_t", "\n"), lambda line: line.rlike(r"[^ \x09-\x0D]")).alias("_l"))
    x = x.select(
        *keep, "_t", "_w", "_l",
        F.expr("""sort_array(transform(
                    filter(_s, (x, j) -> coalesce(x.h = get(_s, j - 1).h, false)
                                      OR coalesce(x.h = get(_s, j + 1).h, false)),
                    x -> x.i))""").alias("_r"))
    return x.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.expr("""aggregate(transform(_r, (x, j) -> least(3, coalesce(get(_r, j + 1), x + 3) - x)),
                            0L, (a, b) -> a + b)""").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """(mean, strength) of the beta prior by moments of ``hosts`` (n, failed); one row reaches the driver.

    Between-host variance that sampling alone explains gives an infinite strength.
    """
    p = F.col("failed") / F.col("n")
    m = hosts.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("failed").alias("f"),
                  F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
                  F.sum(F.col("failed") * p).alias("fp")).first()
    if not m["n"]:
        return 0.0, float("inf")
    mean = m["f"] / m["n"]
    spread = m["fp"] - m["f"] * mean
    within = mean * (1 - mean)
    room = m["n"] - m["nn"] / m["n"] - (m["k"] - 1)
    rho = (spread - within * (m["k"] - 1)) / (within * room) if within > 0 and room > 0 else 0.0
    return mean, float("inf") if rho <= 0 else max(0.0, 1 / rho - 1)


def shrunk_rate(mean: float, strength: float) -> Column:
    if strength == float("inf"):
        return F.lit(mean)
    return (F.col("failed") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))


def host_quality(docs: DataFrame, doc_id: str = "doc_id", host: str = "source", text: str = "text",
                 limit: float = HOST_LIMIT) -> DataFrame:
    """One row per document: counts, ``base_failed``, the host's shrunk ``host_rate`` and ``kept``.

    The counts are written once, without texts; the corpus is read a single
    time. The host table is joined by key, so Spark broadcasts it only when its
    measured size allows and splits a hot host otherwise.
    """
    x = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text"))
    rules = cut_lineage(rule_counts(x, ["doc_id", "host"]).withColumn("base_failed", base_failed()))
    hosts = rules.groupBy("host").agg(F.count(F.lit(1)).alias("n"),
                                      F.sum(F.col("base_failed").cast("long")).alias("failed"))
    mean, strength = beta_prior(hosts)
    verdicts = hosts.select(F.col("host").alias("_host"), shrunk_rate(mean, strength).alias("_rate"))
    joined = rules.join(verdicts, F.col("host").eqNullSafe(F.col("_host")), "left")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("_rate") <= limit)).alias("kept"),
        F.col("host"), F.round("_rate", 6).alias("host_rate"))
