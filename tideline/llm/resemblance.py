"""Near copies by the share of five-word shingles two texts have in common.

Two documents are linked if the Jaccard similarity of their shingle sets is at
least four fifths; documents reachable over links are one component.

Candidates come from the SimHash operator first: the documents that its anchor
covering puts into one component share a cell. Three bits are stricter than the
similarity, so MinHash adds the pairs further apart: 200 minima of a set in 40
bands of five. Two sets at similarity s miss each other there with probability
(1 - s^5)^40, one in eight million at 0.8 and less above. Every candidate is then
settled by its two texts, so no document is linked by an estimate.

Equal sets are one node before anything is replicated. A pivot round tests every
node of a cell against one pivot of the cell, which links a dense group at a
cost close to its size. The pivot is the node that meets most others over all
its cells and so lies near the middle of its group. Rounds go on, with other
pivots, for cells that still hold several components, as long as a round joins
a good part of them.

What is left are nodes that differ from the middle of their groups in too many
shingles, and comparing them with each other would grow with the square of a
group. They are met by an exact prefix join instead: shingles are ordered from
rare to common, and two sets of a and b shingles that share m or more have a
common one among the first a - m + 1 and b - m + 1. A node far from the middle
begins with shingles of its own, which no other node has, so it meets nobody
but nodes that share its changes. Pairs within a component need no test.

Defined cases: words are cut and lower-cased as in ``simhash``; a text of fewer
than five words is one shingle; wordless texts have equal, empty sets; a null
doc_id gets no row and links nothing; repeated rows share a component; an empty
table gives no rows; further columns of the input are ignored.
"""
from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tideline.llm.common import per_batch, whole
from tideline.llm.simhash import components, near_duplicates
from tideline.session import cut_lineage

SHINGLE = 5
PARTS, OF = 4, 5           # similarity of at least four fifths, in whole numbers
BANDS, ROWS = 40, 5
GOOD = 8                   # another pivot round follows if one in so many unresolved nodes was joined
SEED = 42                  # of XXH64

_ODD = np.random.default_rng(SEED).integers(0, 1 << 31, BANDS * ROWS, np.uint32) * np.uint32(2) + np.uint32(1)
_STEP = 512                # shingles hashed together; small arrays stay in the cache


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words."""
    import xxhash

    words = text.lower().split()
    if len(words) <= size:
        grams = [b" ".join(words)] if words else []
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(size))))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64))


def bands(hashes: np.ndarray) -> np.ndarray:
    """One 64-bit value of the minima of each band."""
    import xxhash

    least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    low, high = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    half = len(least) // 2
    for at in range(0, len(hashes), _STEP):
        for part, x in ((slice(0, half), low), (slice(half, None), high)):
            np.minimum(least[part], (_ODD[part, None] * x[None, at:at + _STEP]).min(axis=1), out=least[part])
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(least.reshape(BANDS, ROWS))],
                    np.uint64).view(np.int64)


def alike(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return OF * both >= PARTS * (len(x) + len(y) - both)


def _key(hashes: np.ndarray) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED) - (1 << 63)


def _signed(texts: DataFrame) -> DataFrame:
    """doc_id, key of the shingle set, its size and its bands."""
    def run(batch):
        sets = [shingles(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([_key(s) for s in sets], pa.int64()), pa.array(map(len, sets), pa.int64()),
             pa.array([bands(s) for s in sets], pa.list_(pa.int64()))], names=["doc_id", "key", "n", "bands"])
    return per_batch(run, texts, "doc_id long, key long, n long, bands array<long>")


def _texts_of(texts: DataFrame, nodes: DataFrame, keys: DataFrame) -> DataFrame:
    """key, z: one text of every node in ``keys`` as a zstd frame."""
    import zstandard

    def run(batch):
        press = zstandard.ZstdCompressor(level=1)
        rows = [(k, press.compress(t)) for t, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                if _key(shingles(t)) == k]           # a doc_id may come with several texts
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int64()),
                                           pa.array([z for _, z in rows], pa.binary())], names=["key", "z"])

    wanted = nodes.join(keys, "key").select(F.col("id").alias("_id"), "key")
    found = texts.join(wanted, F.col("doc_id") == F.col("_id")).select("text", "key")
    return per_batch(run, found, "key long, z binary").groupBy("key").agg(F.first("z").alias("z"))


def _tested(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose texts are alike."""
    import zstandard

    def run(batch):
        unpack, sets = zstandard.ZstdDecompressor(), {}

        def of(key, z):
            if key not in sets:
                sets[key] = shingles(unpack.decompress(z))
            return sets[key]
        keep = [alike(of(a, x), of(b, y)) for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    one, two = (texts.select(F.col("key").alias(k), F.col("z").alias(f"z_{k}")) for k in ("a", "b"))
    return per_batch(run, pairs.join(one, "a").join(two, "b").select("a", "b", "z_a", "z_b"), "a long, b long")


def _close(n: str, m: str):
    """Sets of these sizes can be alike."""
    return F.least(n, m) * OF >= F.greatest(n, m) * PARTS


def _rare_first(frames: DataFrame, nodes: DataFrame) -> DataFrame:
    """key, n, shingle, at: the shingles of a node's prefix that other nodes hold too.

    ``at`` is the place in the order by number of nodes, then hash. Shingles of
    one node come first and are counted, not written.
    """
    import zstandard

    def run(batch):
        unpack = zstandard.ZstdDecompressor()
        sets = [shingles(unpack.decompress(z)) for z in batch.column(1).to_pylist()]
        size = np.fromiter(map(len, sets), np.int64, len(sets))
        every = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), size)), pa.array(every)],
                                          names=["key", "shingle"])

    held = cut_lineage(per_batch(run, frames.join(nodes.select("key"), "key", "left_semi"), "key long, shingle long"))
    shared = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    prefix = F.col("n") - F.ceil(F.col("n") * PARTS / OF) + 1
    ordered = (held.join(shared, "shingle").groupBy("key")
                   .agg(F.sort_array(F.collect_list(F.struct("c", "shingle"))).alias("s")).join(nodes, "key"))
    own = F.col("n") - F.size("s")
    first = F.slice("s", F.lit(1), F.greatest(F.lit(0), F.least(F.size("s"), (prefix - own).cast("int"))))
    return (ordered.select("key", "n", "component", own.alias("own"), F.posexplode(first).alias("at", "x"))
                   .select("key", "n", "component", F.col("x.shingle").alias("shingle"),
                           (F.col("at") + F.col("own")).alias("at")))


def _met(prefixes: DataFrame) -> DataFrame:
    """(a, b): nodes of different components with a common shingle in the prefixes that their sizes call for."""
    x = cut_lineage(prefixes)
    y = x.select(*[F.col(c).alias(f"_{c}") for c in ("shingle", "key", "n", "component", "at")])
    both = F.col("n") + F.col("_n")
    least = F.ceil(both * PARTS / (PARTS + OF))      # common shingles of two alike sets
    on = [F.col("shingle") == F.col("_shingle"), F.col("key") < F.col("_key"), F.col("component") != F.col("_component"),
          _close("n", "_n"), F.col("at") <= F.col("n") - least, F.col("_at") <= F.col("_n") - least]
    return x.join(y, on).select(F.col("key").alias("a"), F.col("_key").alias("b")).distinct()


def _covered(texts: DataFrame, each: DataFrame) -> DataFrame:
    """cell, key, n: a cell for every component of the SimHash operator that holds several nodes."""
    dealt = near_duplicates(texts).select("doc_id", F.xxhash64("component_id").alias("cell")).distinct()
    found = each.select("doc_id", "key", "n").join(dealt, "doc_id").select("cell", "key", "n").distinct()
    several = found.groupBy("cell").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    return cut_lineage(found.join(several.select("cell"), "cell", "left_semi"))


def _links(texts: DataFrame, nodes: DataFrame, cells: DataFrame) -> DataFrame | None:
    """key, component of the nodes that have links; None without any."""
    several = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    shared = cells.join(several, "cell")
    meets = shared.groupBy("key").agg(F.sum("c").alias("meets"))
    shared = cut_lineage(shared.drop("c").join(meets, "key"))
    frames = cut_lineage(_texts_of(texts, nodes, shared.select("key").distinct()))
    links = label = None
    turn = was = 0
    while True:
        x = shared.withColumn("component", F.col("key"))
        if label is not None:
            x = shared.join(label, "key", "left").withColumn("component", F.coalesce("component", "key"))
        spot = F.struct("meets", F.xxhash64("key", F.lit(turn)), "key", "n", "component")
        spot = F.max(spot) if turn == 0 else F.max_by(spot, F.xxhash64("key", F.lit(turn)))
        split = (x.groupBy("cell").agg(F.min("component").alias("l"), F.max("component").alias("h"), spot.alias("p"))
                  .filter("l <> h"))
        pivots = split.select("cell", F.col("p.key").alias("_k"), F.col("p.n").alias("_n"), F.col("p.component").alias("_c"))
        open_ = cut_lineage(x.join(pivots, "cell"))
        unresolved = open_.select("key", "n", "component").distinct()
        left = unresolved.count()
        if not left:
            return label
        last = turn > 0 and GOOD * (was - left) < was
        if last:
            pairs = _met(_rare_first(frames, unresolved))
        else:
            met = open_.filter(_close("n", "_n") & (F.col("component") != F.col("_c")))
            pairs = met.select(F.least("key", "_k").alias("a"), F.greatest("key", "_k").alias("b")).distinct()
        found = cut_lineage(_tested(pairs, frames))
        if not found.isEmpty():
            links = found if links is None else links.unionAll(found)
            label = components(links).withColumnRenamed("node", "key")
        if last:
            return label
        was, turn = left, turn + 1


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and component_id, the smallest doc_id of its component, of every row with a doc_id."""
    texts = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).cast("binary").alias("text"))
                 .filter("doc_id IS NOT NULL"))
    each = cut_lineage(_signed(texts))
    nodes = cut_lineage(each.groupBy("key").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"),
                                                F.first("bands").alias("bands")))
    cells = nodes.select(F.explode("bands").alias("cell"), "key", "n").unionByName(_covered(texts, each))
    label = _links(texts, nodes.select("key", "id"), cells)
    of_key = nodes.select("key", F.col("id").alias("component_id"))
    if label is not None:
        named = nodes.select("key", "id").join(label, "key", "left").withColumn("component", F.coalesce("component", "key"))
        least = named.groupBy("component").agg(F.min("id").alias("component_id"))
        of_key = named.join(least, "component").select("key", "component_id")
    return each.select("doc_id", "key").join(of_key, "key").select("doc_id", "component_id")
