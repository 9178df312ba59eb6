"""Importance resampling towards a target, over distinct lines.

A document's features are its runs of one to three words, hashed into buckets.
A separator newline never lies inside a word, so a text is cut there: equal
lines (their words joined by one space) have equal features. One aggregation
finds the distinct lines and how often each occurs; a line's buckets are then
counted once and multiplied by its occurrences. Runs of words that span lines
are counted apart, from the last two words before and the first two words
behind each line break.

The gain of a bucket compares its smoothed share in the target with that in the
documents. A line's weight, too, is summed once and joined back by a 128-bit
key of the line. Lines that make up a ten-thousandth of all lines or more (at
most ten thousand of them) are looked up in a table in each task instead, so no
key of the join is hot. Scores add a draw that depends on the doc_id only, and
a range shuffle ranks them.

Defined cases: a null text has no words, no features and weight zero; empty
lines and lines without words vanish (words of both neighbours are
consecutive); a null doc_id draws like the empty string; rows that share a
doc_id are separate documents, ranked by a hash of their texts, and repeated
rows follow each other; an empty table gives no rows, an empty target has
shares of smoothing alone; further columns are ignored.
"""
from __future__ import annotations

import math
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tideline.llm.common import whole
from tideline.operators.scale import row_index, staged_blocks
from tideline.session import cut_lineage

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 5
SEED = 42
HOT = 10_000               # a line with this share of all lines, or more, is looked up and not joined
PORTION = 1 << 18          # bytes of lines hashed together


def _plain(byte: int) -> int:
    """Lower-case letters, digits, bytes of other scripts and newlines stay; all else is a blank."""
    if 65 <= byte <= 90:
        return byte + 32
    return byte if byte == 10 or 48 <= byte <= 57 or 97 <= byte <= 122 or byte >= 128 else 32


_PLAIN = bytes(map(_plain, range(256)))


def lines_of(text: bytes) -> list[list[bytes]]:
    """The words of every line that has words."""
    return [words for line in text.translate(_PLAIN).split(b"\n") if (words := line.split())]


def crossing(lines: list[list[bytes]]) -> list[int]:
    """crc32 of every run of two or three words that spans lines."""
    out, tail = [], []
    for words in lines:
        if tail:
            two = crc32(b" " + words[0], crc32(tail[-1]))
            out.append(two)
            if len(tail) > 1:
                out.append(crc32(b" ".join([tail[0], tail[1], words[0]])))
            if len(words) > 1:
                out.append(crc32(b" " + words[1], two))
        tail = words[-2:] if len(words) > 1 else [*tail[-1:], words[0]]
    return out


def inside(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the line, crc32) of every run of one to three words of joined, non-empty lines."""
    text = b" ".join(lines)
    words, spaced = text.split(b" "), text.replace(b" ", b"\n ").split(b"\n")
    size = np.fromiter((line.count(b" ") + 1 for line in lines), np.int64, len(lines))
    of = np.repeat(np.arange(len(lines)), size)
    ones = list(map(crc32, words))
    twos = list(map(crc32, spaced[1:], ones))
    threes = np.fromiter(map(crc32, spaced[2:], twos), np.uint32)
    two, three = of[1:] == of[:-1], of[2:] == of[:-2]
    return (np.concatenate([of, of[1:][two], of[2:][three]]),
            np.concatenate([np.array(ones, np.uint32), np.array(twos, np.uint32)[two], threes[three]]))


def _in_portions(lines: list[bytes]):
    """(first, lines) in runs of about ``PORTION`` bytes."""
    first, size = 0, 0
    for i, line in enumerate(lines):
        size += len(line) + 1
        if size >= PORTION:
            yield first, lines[first:i + 1]
            first, size = i + 1, 0
    if first < len(lines):
        yield first, lines[first:]


def segments(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Distinct lines (line, times), and how often a bucket occurs across lines (bucket, times), stored."""
    def run(batches):
        spanning = np.zeros(buckets, np.int64)
        for batch in batches:
            found = Counter()
            for t in batch.column(0).to_pylist():
                lines = lines_of(t)
                found.update(map(b" ".join, lines))
                if len(lines) > 1:
                    spanning += np.bincount(np.array(crossing(lines), np.int64) % buckets, minlength=buckets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.binary()), pa.nulls(len(found), pa.int32()),
                 pa.array(found.values(), pa.int64())], names=["line", "bucket", "times"])
        at = np.flatnonzero(spanning)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.binary()), pa.array(at, pa.int32()),
                                          pa.array(spanning[at], pa.int64())], names=["line", "bucket", "times"])

    texts = df.select(whole(text).cast("binary").alias("text"))
    return cut_lineage(texts.mapInArrow(run, "line binary, bucket int, times long")
                            .groupBy("line", "bucket").agg(F.sum("times").alias("times")))


def bucket_counts(parts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences of every bucket, from ``segments``: one number a bucket comes to the driver."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            lines, times = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for first, some in _in_portions(lines):
                of, crc = inside(some)
                np.add.at(total, crc % np.uint32(buckets), times[first + of])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                                         names=["bucket", "times"])

    lines = parts.filter("line IS NOT NULL").select("line", "times").mapInArrow(run, "bucket int, times long")
    across = parts.filter("line IS NULL").select("bucket", "times")
    out = np.zeros(buckets, np.int64)
    for bucket, times in lines.unionAll(across).groupBy("bucket").agg(F.sum("times")).collect():
        out[bucket] = times
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of target share over source share, each bucket smoothed by one, rounded down."""
    n, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def line_weights(parts: DataFrame, gain: np.ndarray) -> DataFrame:
    """high, low (key of a line), times, n (its features), w (their gains) of every distinct line."""
    def run(batches):
        import xxhash
        for batch in batches:
            lines = batch.column(0).to_pylist()
            n, w = np.zeros(len(lines), np.int64), np.zeros(len(lines), np.int64)
            for first, some in _in_portions(lines):
                of, crc = inside(some)
                each = np.bincount(of, minlength=len(some))
                order = np.argsort(of, kind="stable")
                sums = np.add.reduceat(gain[crc[order] % np.uint32(len(gain))], np.cumsum(each) - each)
                n[first:first + len(some)], w[first:first + len(some)] = each, sums
            keys = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines)), ">i8").astype(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[:, 0]), pa.array(keys[:, 1]), batch.column(1), pa.array(n), pa.array(w)],
                names=["high", "low", "times", "n", "w"])

    return (parts.filter("line IS NOT NULL").select("line", "times")
                 .mapInArrow(run, "high long, low long, times long, n long, w long"))


def _document_lines(docs: DataFrame, gain: np.ndarray, hot: dict[tuple[int, int], tuple[int, int]]) -> DataFrame:
    """Per document a row without key (rows, words, n, w across lines and of hot lines) and one for each other line."""
    names = ["doc_id", "text_key", "high", "low", "times", "rows", "words", "n", "w"]

    def run(batches):
        import xxhash
        for batch in batches:
            out = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                lines = lines_of(text)
                key = xxhash.xxh64_intdigest(text, SEED) - (1 << 63)
                span = crossing(lines) if len(lines) > 1 else []
                n, w = len(span), int(gain[np.array(span, np.int64) % len(gain)].sum())
                for line, times in Counter(map(b" ".join, lines)).items():
                    digest = xxhash.xxh3_128_digest(line)
                    place = (int.from_bytes(digest[:8], signed=True), int.from_bytes(digest[8:], signed=True))
                    if place in hot:
                        n, w = n + times * hot[place][0], w + times * hot[place][1]
                    else:
                        out.append((doc_id, key, *place, times, 0, 0, 0, 0))
                out.append((doc_id, key, None, None, None, 1, sum(map(len, lines)), n, w))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

    return docs.mapInArrow(lambda batches: run(b for b in batches if b.num_rows),
                           ", ".join(f"{c} long" for c in names))


def weighted(docs: DataFrame, gain: np.ndarray, parts: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, n_features, weight of every row of ``docs`` (doc_id, text as bytes)."""
    lines = cut_lineage(line_weights(parts, gain))
    total = lines.agg(F.sum("times")).first()[0] or 0
    common = lines.filter(F.col("times") * HOT >= F.lit(total))          # at most HOT rows
    hot = {(r.high, r.low): (r.n, r.w) for r in common.collect()}
    rows = _document_lines(docs, gain, hot)
    of_line = lines.select("high", "low", F.col("n").alias("_n"), F.col("w").alias("_w"))
    joined = rows.join(of_line, ["high", "low"], "left")
    per = joined.groupBy("doc_id", "text_key").agg(
        F.sum("rows").alias("rows"), F.sum("words").alias("words"),
        F.sum(F.coalesce(F.col("times") * F.col("_n"), "n")).alias("n"),
        F.sum(F.coalesce(F.col("times") * F.col("_w"), "w")).alias("w"))
    return (per.select("doc_id", "text_key", F.expr("words div rows").alias("n_words"),
                       F.expr("n div rows").alias("n_features"), F.expr("w div rows").alias("weight"), "rows")
               .withColumn("_copy", F.explode(F.expr("sequence(1L, rows)"))).drop("rows"))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
             target_text: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null: not drawn) of every document."""
    parts = segments(docs, text, buckets)
    gain = gains(bucket_counts(parts, buckets), bucket_counts(segments(target, target_text, buckets), buckets))
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).cast("binary").alias("text"))
    drawn = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"),
                                                                                      F.lit(""))), 256), 1, 8), 16, 10)
    chance = F.floor(-1000 * F.log(-F.log((drawn.cast("long") + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = (weighted(plain, gain, parts)
              .withColumn("score", F.col("weight") + chance.cast("long"))
              .withColumn("_short", F.col("n_words") < min_words)
              .withColumn("_down", -F.col("score")))
    order = ["_short", "_down", "doc_id", "text_key", "_copy"]
    stored, block = staged_blocks(scored, order)
    most = (stored.filter(~F.col("_short")).count() * percent) // 100
    ranked = row_index(stored, [], order, block, "_at")
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score",
                         F.when(~F.col("_short") & (F.col("_at") < most), F.col("_at") + 1).alias("rank"))
