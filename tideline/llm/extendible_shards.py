"""Shards of bounded size by extendible hashing, with DataFrame functions only.

A document's hash decides its place. A bucket is a prefix of the hash; it splits
on the next bit only while it holds more than the byte limit, and the directory
has one slot per prefix of the deepest bucket.

All prefixes are sized in one aggregation: hashes are counted at a fine depth,
and the counts are added up for every shorter prefix. Prefixes that are still
too large at the fine depth are the only ones counted again, some bits deeper.

Defined cases: a null text has 0 bytes; a null doc_id has a hash of its own; an
empty table gives no rows; repeated rows share a hash and stay together; a
bucket whose hashes are all equal cannot split and is flagged ``oversized``
when it is above the limit, as one long document can be; further columns are
ignored.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tideline.llm.common import fresh, whole
from tideline.session import cut_lineage

LIMIT = 64 << 20
BITS = 60                  # of the hash
SPARE = 6                  # bits counted beyond those an even spread would need


def place(doc_id: str = "doc_id") -> Column:
    """60 bits of the identity's MD5, which every engine computes alike."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))), 1, 15),
                  16, 10).cast("long")


def _prefix(depth) -> Column:
    return F.expr(f"shiftright(h, {BITS} - {depth})")


def _level(rows: DataFrame, top: int, bottom: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(leaves, still too large at ``bottom``) among the prefixes of ``top`` .. ``bottom`` bits.

    A leaf is within the limit, or has one hash only, while its parent was not.
    """
    fine = rows.groupBy(_prefix(bottom).alias("p")).agg(
        F.sum("bytes").alias("bytes"), F.min("h").alias("lo"), F.max("h").alias("hi"))
    sizes = (fine.withColumn("depth", F.explode(F.sequence(F.lit(top), F.lit(bottom))))
                 .groupBy("depth", F.expr(f"shiftright(p, {bottom} - depth)").alias("prefix"))
                 .agg(F.sum("bytes").alias("shard_bytes"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    sizes = sizes.withColumn("done", (F.col("shard_bytes") <= limit) | (F.col("lo") == F.col("hi")))
    parent = sizes.filter(~F.col("done")).select((F.col("depth") + 1).alias("_d"), F.col("prefix").alias("_p"))
    under = sizes.join(parent, (F.col("depth") == F.col("_d")) & (F.expr("shiftright(prefix, 1)") == F.col("_p")),
                       "left")
    reached = under.filter((F.col("depth") == top) | F.col("_p").isNotNull())
    return reached.filter("done"), reached.filter(~F.col("done") & (F.col("depth") == bottom))


def shard_directory(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """depth, prefix, shard_bytes, oversized of every bucket of ``rows`` (h, bytes)."""
    total = rows.agg(F.sum("bytes").alias("b")).first()["b"] or 0
    top, bottom = 0, min(BITS, max(1, math.ceil(math.log2(max(total, 1) / limit)) if total > limit else 0) + SPARE)
    left, parts = rows, []
    while True:
        leaves, large = (cut_lineage(x) for x in _level(left, top, bottom, limit))
        parts.append(leaves)
        if bottom == BITS or large.isEmpty():
            break
        left = left.join(large.select("prefix"), _prefix(bottom) == F.col("prefix"), "left_semi")
        top, bottom = bottom + 1, min(BITS, bottom + SPARE)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out.select("depth", "prefix", "shard_bytes", (F.col("shard_bytes") > limit).alias("oversized"))


def shard_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, depth, prefix, shard (the prefix as bits), shard_bytes, oversized per document."""
    rows = cut_lineage(docs.select(F.col(doc_id).alias("doc_id"), place(doc_id).alias("h"),
                                   F.octet_length(whole(text)).cast("long").alias("bytes")))
    directory = cut_lineage(shard_directory(rows, limit))
    depths = sorted(r["depth"] for r in directory.select("depth").distinct().collect())      # at most BITS + 1
    looked = rows.withColumn("_at", F.explode(F.array(*[
        F.struct(F.lit(d).alias("depth"), _prefix(d).alias("prefix")) for d in depths or [0]])))
    own = directory.withColumns({"_depth": F.col("depth"), "_prefix": F.col("prefix")}).drop("depth", "prefix")
    found = looked.join(own, (F.col("_at.depth") == F.col("_depth")) & (F.col("_at.prefix") == F.col("_prefix")))
    return found.withColumns({"depth": F.col("_depth"), "prefix": F.col("_prefix")}).select(
        "doc_id", F.col("bytes").alias("n_bytes"), F.col("depth").cast("int").alias("depth"), "prefix",
        F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.bin("prefix"), F.col("depth"), "0")).alias("shard"),
        "shard_bytes", "oversized")


def write_shards(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> None:
    """Whole rows of ``docs`` in one Parquet folder per shard; ``doc_id`` identifies a row."""
    of, shard = fresh(docs, "shard_of"), fresh(docs, "shard")
    where = shard_documents(docs, doc_id, text, limit).select(F.col("doc_id").alias(of), F.col("shard").alias(shard))
    named = docs.join(where.distinct(), F.col(doc_id).eqNullSafe(F.col(of)), "left").drop(of)
    named.repartition(shard).write.partitionBy(shard).parquet(path)
