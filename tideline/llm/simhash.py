"""SimHash near-duplicates by covering a half fingerprint with code words.

Two fingerprints at most three bits apart have a half in which they differ by
at most one bit. Each 32-bit half is covered by the anchors of a fixed code:
the perfect Hamming code on 31 bits, with the last bit free. Its covering
radius is one, so a fingerprint has a home anchor within distance one, and
every fingerprint linked to it through that half lies within radius plus
threshold, two, of the same anchor. A fingerprint is therefore sent to all
anchors within distance two (at most 17 a half) and compared per anchor.

Exact copies are one fingerprint before anything is replicated. Inside an
anchor, members are captured by breadth-first search over those not captured
yet and leave as a star to the smallest document: a dense group costs close to
its size, not its square, and emits no pairs. Stars are closed to components
by minimum labels and pointer jumping on written tables.

Defined cases: null and wordless texts have fingerprint zero, which links like
any other; a null doc_id gets its fingerprint and the component of its links,
but never names a component (null if no document with an id is reachable); an
empty table gives no rows; repeated rows return as often as they come and share
a component; further columns of the input are ignored.
"""
from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tideline.llm.common import per_batch, whole
from tideline.session import cut_lineage

SHINGLE = 3
DISTANCE = 3
SEED = 42                  # of XXH64

_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint of a whole text; ``bytes.split`` cuts at exactly the six ASCII spaces."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    else:
        grams = zip(*(words[i:] for i in range(shingle)))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, grams), repeat(SEED)),
                             np.uint64, len(words) - shingle + 1)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """Bits set in more than half of ``hashes``; bytes count up to 255 rows at a time."""
    n, starts = len(hashes), np.arange(0, len(hashes), 255)
    out = 0
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, starts)
        counts = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte in np.flatnonzero(2 * counts > n):
            out |= 1 << (8 * int(byte) + bit)
    return out


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)."""
    def run(batch):
        fps = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], names=["doc_id", "fp"])
    x = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).cast("binary").alias("text"))
    return per_batch(run, x, "doc_id long, fp long")


def _syndromes(half: np.ndarray) -> np.ndarray:
    """Hamming syndrome of the low 31 bits: the xor of the 1-based positions of set bits."""
    out = np.zeros(len(half), np.uint32)
    for place in range(5):
        mask = np.uint32(sum(1 << (p - 1) for p in range(1, 32) if p >> place & 1))
        out |= (np.bitwise_count(half & mask) & 1).astype(np.uint32) << np.uint32(place)
    return out


def _flip(position: np.ndarray) -> np.ndarray:
    """The bit at a 1-based position; 0 flips nothing."""
    return np.where(position > 0, np.uint32(1) << (np.maximum(position, 1) - np.uint32(1)).astype(np.uint32),
                    np.uint32(0)).astype(np.uint32)


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, anchors) of every code word within two bits of each 32-bit half; the home anchor comes first.

    With syndrome s, the word's code neighbours are: flip s (home); the same
    with the free bit flipped; and, if s is not 0, flip a and b with a xor b = s.
    """
    half = half.astype(np.uint32)
    s = _syndromes(half)
    home = half ^ _flip(s)
    rows, out = [np.arange(len(half))] * 2, [home, home ^ np.uint32(1 << 31)]
    for a in range(1, 32):
        b = s ^ np.uint32(a)
        ok = (s > 0) & (b > a)
        rows.append(np.flatnonzero(ok))
        out.append(half[ok] ^ np.uint32(1 << (a - 1)) ^ _flip(b[ok]))
    return np.concatenate(rows), np.concatenate(out)


def stars(fps: np.ndarray, ids: np.ndarray, distance: int = DISTANCE, chunk: int = 64) -> list[tuple[int, int]]:
    """(member id, smallest id) of each component of two or more among distinct ``fps``."""
    left, left_ids, out = fps, ids, []
    while len(left) > 1:
        front, member = left[:1], [left_ids[:1]]
        left, left_ids = left[1:], left_ids[1:]
        while len(front) and len(left):
            near = (np.bitwise_count(left[None, :] ^ front[:chunk, None]) <= distance).any(axis=0)
            front = np.concatenate([front[chunk:], left[near]])
            member.append(left_ids[near])
            left, left_ids = left[~near], left_ids[~near]
        found = np.concatenate(member)
        if len(found) > 1:
            low = int(found.min())
            out.extend((int(i), low) for i in found if i != low)
    return out


def anchor_links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): star links between the ids of distinct fingerprints (``fp``, ``node``)."""
    if distance > 3:
        raise ValueError("two halves with one differing bit cover distances up to 3")

    def spread(batch):
        fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        node = batch.column(1).to_numpy(zero_copy_only=False)
        parts = []
        for side, half in enumerate((fp & np.uint64(0xFFFFFFFF), fp >> np.uint64(32))):
            rows, anchor = anchors(half)
            parts.append((anchor.astype(np.int64) | (side << 32), rows, np.arange(len(rows)) < len(fp)))
        cell, rows, home = (np.concatenate(x) for x in zip(*parts))
        return pa.RecordBatch.from_arrays(
            [pa.array(cell * 2 + home), pa.array(fp[rows].view(np.int64)), pa.array(node[rows])],
            names=["cell", "fp", "node"])

    def compare(batches):
        """Cells arrive in order; the last of a batch may go on in the next one."""
        held = None
        for batch in batches:
            x = batch.to_pandas()
            x = x if held is None else pd.concat([held, x], ignore_index=True)
            cell = x["cell"].to_numpy() >> 1
            done = cell != cell[-1]
            yield from emit(x[done])
            held = x[~done]
        if held is not None:
            yield from emit(held)

    def emit(x):
        cell = x["cell"].to_numpy()
        edges = []
        if len(x):
            fp, node = x["fp"].to_numpy().view(np.uint64), x["node"].to_numpy()
            cuts = np.flatnonzero(np.diff(cell >> 1)) + 1
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(x)]
            homes = np.add.reduceat(cell & 1, starts)
            for i in np.flatnonzero((ends - starts > 1) & (homes > 0)):
                part = slice(starts[i], ends[i])
                edges.extend(stars(fp[part], node[part], distance))
        if edges:
            yield pa.RecordBatch.from_pandas(pd.DataFrame(edges, columns=["a", "b"]), preserve_index=False)

    cells = per_batch(spread, nodes.select("fp", "node"), "cell long, fp long, node long")
    key = F.shiftright("cell", 1)
    return (cells.repartition(key).sortWithinPartitions("cell")
                 .mapInArrow(compare, "a long, b long").distinct())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every end of ``links``: the smallest node reachable.

    Each round takes the smallest label among the neighbours, then the label of
    that label, so path lengths at least halve; rounds are written tables.
    """
    both = cut_lineage(links.select(F.col(a).alias("node"), F.col(b).alias("other"))
                       .unionAll(links.select(F.col(b).alias("node"), F.col(a).alias("other"))).distinct())
    label = cut_lineage(both.groupBy("node").agg(F.min("other").alias("m"))
                        .select("node", F.least("node", "m").alias("component")))
    while True:
        near = (both.join(label.select(F.col("node").alias("other"), F.col("component").alias("c")), "other")
                    .groupBy("node").agg(F.min("c").alias("c")))
        low = label.join(near, "node").select("node", F.col("component").alias("was"),
                                              F.least("component", "c").alias("component"))
        jump = low.select(F.col("node").alias("_n"), F.col("component").alias("_up"))
        new = cut_lineage(low.join(jump, F.col("component") == F.col("_n"), "left")
                             .select("node", "was", F.least("component", F.coalesce("_up", "component"))
                                     .alias("component")))
        label = new.select("node", "component")
        if new.filter("component <> was").isEmpty():
            return label


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fp (signed long), fingerprint (16 hex digits) and component_id of every document."""
    each = cut_lineage(fingerprints(docs, doc_id, text, shingle))
    # a fingerprint without any id still links others; its own node is negative and outside the id range
    nodes = cut_lineage(each.groupBy("fp").agg(F.min("doc_id").alias("id"))
                        .withColumn("node", F.coalesce("id", _nameless())))
    label = components(anchor_links(nodes, distance))
    named = label.join(nodes.select("node", "id"), "node")
    least = named.groupBy("component").agg(F.min("id").alias("low"))
    of_fp = (nodes.join(label.join(least, "component").select("node", "low"), "node", "left")
                  .select(F.col("fp").alias("_fp"), F.coalesce("low", "id").alias("component_id")))
    return each.join(of_fp, F.col("fp") == F.col("_fp"), "left").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _nameless() -> Column:
    return F.lit(np.iinfo(np.int64).max) - F.pmod(F.xxhash64("fp"), F.lit(1 << 40))
