"""Exact removal of repeated byte strings with a logarithmic family of sampled suffix arrays.

Every byte covered by a string of ``length`` bytes that starts earlier, in a
smaller document or earlier in the same one, is removed.

Sampling. A window of ``length`` bytes is represented by the suffix at its
leftmost smallest 24-byte hash. The choice depends on the window's bytes only,
so equal windows choose suffixes at equal offsets, and about one suffix in 35
bytes is indexed. The windows that choose the same suffix form one segment,
identified by the suffix's 24-byte head (``key``) and the hash of the segment's
bytes (``seg``).

1. Suffixes are dealt by head. A task takes them in document order as batches.
   Each batch is sorted into an array, merge-scanned against every level of the
   family (a segment seen before is removed whole; a known head with another
   segment is examined), and becomes a level; levels of equal size merge.
2. Segments to examine bring their bytes, meet again by a longer string, and
   are compared window by window, which gives the exact ends of matches. A
   string that more than ``HOT`` of them share is compared by one row for each
   window, whose first place is a minimum, so it does not gather in a task.
3. Spans are joined to the texts.

A passage that a third of the documents share sends one suffix per Arrow batch
of documents to its task; its other copies are settled where they are read.

Defined cases: a null text is empty; a null doc_id neither removes nor loses
bytes; texts shorter than ``length`` are kept; repeated rows with one doc_id
are one document read twice and return as often as they come; an empty table
gives no rows; further columns are ignored.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tideline.llm.common import fresh, per_batch, whole
from tideline.session import cut_lineage

LENGTH = 100
HEAD = 24
CHUNK = 1 << 15            # bytes hashed together; small arrays stay in the cache
BATCH = 1 << 16            # suffixes of a new batch in the family
HOT = 1024                 # segments of one core that one task compares

_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_S = np.uint64(32)
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)
_BYTE = (np.arange(1, 257, dtype=np.uint64) * _K2) ^ ((np.arange(1, 257, dtype=np.uint64) * _K1) >> _S)


def _join(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = x * _K1
    out += y
    out ^= out >> _S
    out *= _K2
    out ^= out >> np.uint64(29)
    return out


def _double(h: np.ndarray, step: int) -> np.ndarray:
    out = np.zeros_like(h)
    if len(h) > step:
        out[:-step] = _join(h[:-step], h[step:])
    return out


def _hash16(data: np.ndarray) -> np.ndarray:
    h = _BYTE[data]
    for step in (1, 2, 4, 8):
        h = _double(h, step)
    return h


def _strings(h16: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes from each position, from 16-byte hashes that cover them."""
    out = h16[at]
    for off in (*range(16, length - 15, 16), length - 16):
        out = _join(out, h16[at + off])
    return out


def _window_min(c: np.ndarray, width: int) -> np.ndarray:
    m, size = c, 1
    while size * 2 <= width:
        m = np.minimum(m[:-size], m[size:]) if len(m) > size else m[:0]
        size *= 2
    rest = width - size
    if rest:
        m = np.minimum(m[:-rest], m[rest:]) if len(m) > rest else m[:0]
    return m


def segments(texts: list[bytes], length: int = LENGTH):
    """(row, pos, gap, run, key, seg) of the segments of some texts.

    ``pos`` is the suffix, ``gap`` the distance back to the first window that
    chooses it and ``run`` the number of such windows.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    h16 = _hash16(data)
    head = np.zeros_like(h16)
    if len(h16) > HEAD - 16:
        head[:-(HEAD - 16)] = _join(h16[:-(HEAD - 16)], h16[HEAD - 16:])
    chosen = _window_min((head & _HIGH) | np.arange(len(data), dtype=np.uint64), length - HEAD + 1)
    ok = np.zeros(len(data), bool)
    for end, size in zip(ends, sizes):
        if size >= length:
            ok[end - size:end - length + 1] = True
    start = np.flatnonzero(ok)
    suffix = (chosen[start] & _LOW).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (suffix[1:] != suffix[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(start)] - 1
    a, b, p = start[first], start[last], suffix[first]
    row = np.searchsorted(ends, a, side="right")
    seg = _join(_strings(h16, a, length), _strings(h16, b, length))
    seg = _join(seg, ((p - a) * 256 + (b - a)).astype(np.uint64))
    return row, p - (ends - sizes)[row], p - a, b - a + 1, head[p], seg


def _chunks(texts: list[bytes]):
    part, size, at = [], 0, 0
    for i, t in enumerate(texts):
        if part and size + len(t) > CHUNK:
            yield at, part
            part, size, at = [], 0, i
        part.append(t)
        size += len(t)
    if part:
        yield at, part


_KINDS = {"covered": 0, "source": 1, "suffix": 2}


def _suffixes(docs: DataFrame, length: int) -> DataFrame:
    """deal, seg, doc_id, v, kind: suffixes to index, and spans settled within one batch of documents.

    ``v`` packs position, gap and run; of a span, its start and size.
    """
    def run(batch):
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        texts = batch.column(1).to_pylist()
        order = np.argsort(ids, kind="stable")
        ids, texts = ids[order], [texts[i] for i in order]
        parts = []
        for at, part in _chunks(texts):
            if any(len(t) >= length for t in part):
                row, pos, gap, n, key, seg = segments(part, length)
                parts.append((ids[row + at], pos, gap, n, key, seg))
        if not parts:
            return pa.RecordBatch.from_pydict({"deal": pa.array([], pa.int64()), "seg": pa.array([], pa.int64()),
                                               "doc_id": pa.array([], pa.int64()), "v": pa.array([], pa.int64()),
                                               "kind": pa.array([], pa.int32())})
        doc, pos, gap, n, key, seg = (np.concatenate(x) for x in zip(*parts))
        again = _repeats(key, seg, doc, pos)
        v = np.where(again, (pos - gap) << 8 | (n + length - 1), pos << 16 | gap << 8 | n)
        deal = np.where(again, doc * 1_000_003 + pos, key.view(np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array(deal), pa.array(seg.view(np.int64)), pa.array(doc), pa.array(v),
             pa.array(np.where(again, 0, 2).astype(np.int32))], names=["deal", "seg", "doc_id", "v", "kind"])
    return per_batch(run, docs.filter("doc_id IS NOT NULL"), "deal long, seg long, doc_id long, v long, kind int")


def _repeats(key, seg, doc, pos) -> np.ndarray:
    """Rows, in document order, whose (key, seg) came before at another place."""
    order = np.lexsort((seg, key))
    k, s = key[order], seg[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
    first = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    out = np.zeros(len(k), bool)
    out[order] = (first != order) & ((doc[first] != doc[order]) | (pos[first] != pos[order]))
    return out


class Family:
    """Sorted arrays of (key, seg, doc, v, examined); sizes of the levels differ by a factor of two or more."""

    def __init__(self):
        self.levels: list[list[np.ndarray]] = []

    def add(self, key, seg, doc, v):
        """Scan a batch in document order against the levels, then keep its new segments.

        Returns (covered, examined) masks over the batch and the (doc, v) of
        earlier segments that now have to be examined as well.
        """
        covered, known, sources = np.zeros(len(key), bool), np.zeros(len(key), bool), []
        order = np.lexsort((seg, key))
        k, s, d, w = key[order], seg[order], doc[order], v[order]
        for level in self.levels:
            lk, ls, ld, lv, seen = level
            lo, hi = np.searchsorted(lk, k, "left"), np.searchsorted(lk, k, "right")
            known |= hi > lo
            width = int((hi - lo).max(initial=0))
            at = lo.copy()
            step = 1 << max(0, width - 1).bit_length()
            end = hi.copy()
            while step:                              # binary search of seg among the rows of the key
                mid = np.minimum((at + end) // 2, max(0, len(lk) - 1))
                go = at < end
                right = go & (ls[mid] < s)
                at = np.where(right, mid + 1, at)
                end = np.where(go & ~right, mid, end)
                step >>= 1
            spot = np.minimum(at, len(ls) - 1)
            hit = (at < hi) & (ls[spot] == s)
            twin = hit & (ld[spot] == d) & (lv[spot] == w)      # the same document read twice
            covered |= hit
            for i, j in set(zip(lo[(hi > lo) & ~hit].tolist(), hi[(hi > lo) & ~hit].tolist())):
                fresh = np.flatnonzero(seen[i:j] == 0) + i
                if len(fresh):
                    seen[fresh] = 1
                    sources.append((ld[fresh], lv[fresh]))
            if twin.any():
                keep = ~twin
                k, s, d, w, order = k[keep], s[keep], d[keep], w[keep], order[keep]
                covered, known = covered[keep], known[keep]
        new_seg = np.ones(len(k), bool)
        new_seg[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
        run = np.cumsum(new_seg) - 1
        head = np.flatnonzero(new_seg)[run] if len(k) else run
        again = ~new_seg & ((d[head] != d) | (w[head] != w))
        new_key = np.ones(len(k), bool)
        new_key[1:] = k[1:] != k[:-1]
        group = np.cumsum(new_key) - 1
        many = np.bincount(group, weights=new_seg & ~covered, minlength=1)[group] > 1 if len(k) else known
        fresh = new_seg & ~covered
        examine = fresh & (known | many)
        out_cover, out_examine = np.zeros(len(key), bool), np.zeros(len(key), bool)
        out_cover[order] = covered | again
        out_examine[order] = examine
        self._push([k[fresh], s[fresh], d[fresh], w[fresh], examine[fresh].astype(np.int8)])
        return out_cover, out_examine, sources

    def _push(self, level):
        if not len(level[0]):
            return
        while self.levels and len(self.levels[-1][0]) <= 2 * len(level[0]):
            older = self.levels.pop()
            both = [np.concatenate(x) for x in zip(older, level)]
            order = np.lexsort((both[1], both[0]))
            level = [x[order] for x in both]
        self.levels.append(level)


def _scan(length: int):
    def run(batches):
        family, held = Family(), []

        def flush():
            x = [np.concatenate(c) for c in zip(*held)]
            held.clear()
            seg, doc, v, key = x
            covered, examined, sources = family.add(key, seg, doc, v)
            pos, gap, n = v >> 16, v >> 8 & 255, v & 255
            docs = [doc[covered], doc[examined], *[s[0] for s in sources]]
            vs = [((pos - gap) << 8 | (n + length - 1))[covered], v[examined], *[s[1] for s in sources]]
            kinds = np.repeat([0, 1], [len(docs[0]), sum(map(len, docs[1:]))]).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(docs)), pa.array(np.concatenate(vs)), pa.array(kinds)],
                names=["doc_id", "v", "kind"])

        size = 0
        for batch in batches:
            deal, seg, doc, v, kind = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            done = kind == 0
            if done.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[done]), pa.array(v[done]), pa.array(kind[done])], names=["doc_id", "v", "kind"])
            new = ~done
            held.append((seg[new].view(np.uint64), doc[new], v[new], deal[new].view(np.uint64)))
            size += int(new.sum())
            if size >= BATCH:
                size = 0
                yield flush()
        if held:
            yield flush()
    return run


def _contexts(docs: DataFrame, examined: DataFrame, length: int) -> DataFrame:
    """head, doc_id, start, gap, run, context of the segments to examine.

    Windows that begin at most ``side`` bytes before the suffix share its next
    ``length - side`` bytes, the others the ``side`` bytes before it: they are
    dealt by these longer strings, so a frequent head does not gather.
    """
    import zstandard

    side = (length - HEAD) // 2

    def run(batch):
        import xxhash
        unpack = zstandard.ZstdDecompressor()
        head, doc, start, gap, runs, bits = [], [], [], [], [], []
        for i, z, vs in zip(*(c.to_pylist() for c in batch.columns)):
            text = unpack.decompress(z)
            for v in set(vs):
                pos, back, n = v >> 16, v >> 8 & 255, v & 255
                for top, low, core in ((min(back, side), back - n + 1, text[pos:pos + length - side]),
                                       (back, max(back - n + 1, side + 1), text[pos - side:pos + HEAD])):
                    if top >= low:
                        head.append(xxhash.xxh64_intdigest(core, low <= side) - (1 << 63))
                        doc.append(i)
                        start.append(pos - top)
                        gap.append(top)
                        runs.append(top - low + 1)
                        bits.append(text[pos - top:pos - low + length])
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (head, doc, start, gap, runs)] + [pa.array(bits, pa.binary())],
            names=["head", "doc_id", "start", "gap", "run", "context"])

    wanted = (examined.groupBy(F.col("doc_id").alias("_d")).agg(F.collect_list("v").alias("vs")))
    joined = docs.join(wanted, F.col("doc_id") == F.col("_d")).select("doc_id", "z", "vs")
    return per_batch(run, joined, "head long, doc_id long, start long, gap long, run long, context binary")


def _windows(x: pd.DataFrame, length: int):
    """(row, key, hash, doc, start) of every window of the segments ``x``; equal windows have equal key and hash."""
    texts = x["context"].tolist()
    sizes = np.array([len(t) for t in texts])
    h16 = _hash16(np.frombuffer(b"".join(texts), np.uint8))
    runs = x["run"].to_numpy()
    row = np.repeat(np.arange(len(x)), runs)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs)
    at = (np.cumsum(sizes) - sizes)[row] + inside
    back = x["gap"].to_numpy()[row] - inside
    key = _join(x["head"].to_numpy().view(np.uint64)[row], back.astype(np.uint64))
    return row, key, _strings(h16, at, length), x["doc_id"].to_numpy()[row], x["start"].to_numpy()[row] + inside


def _hot_spans(met: DataFrame, length: int) -> DataFrame:
    """(doc_id, v): one span for each window of ``met`` that came before, by a row for each window.

    The first window of each kind is a minimum, so a frequent one does not gather.
    """
    def run(batch):
        _, key, seg, doc, start = _windows(batch.to_pandas(), length)
        return pa.RecordBatch.from_arrays([pa.array(_join(key, seg).view(np.int64)), pa.array(doc), pa.array(start)],
                                          names=["window", "doc_id", "start"])

    each = per_batch(run, met, "window long, doc_id long, start long")
    first = each.groupBy("window").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    return (each.join(first, "window").filter(F.struct("doc_id", "start") > F.col("first"))
                .select("doc_id", F.shiftleft("start", 8).bitwiseOR(F.lit(length)).alias("v")))


def _compare(length: int):
    def windows(x: pd.DataFrame):
        """Spans of windows that came before, among the segments of some whole heads in document order."""
        row, key, seg, doc, start = _windows(x, length)
        hit = _repeats(key, seg, doc, start)
        i = np.flatnonzero(hit)
        if not len(i):
            return None
        new = np.ones(len(i), bool)
        new[1:] = (i[1:] != i[:-1] + 1) | (row[i[1:]] != row[i[:-1]])
        first = np.flatnonzero(new)
        n = np.diff(np.r_[first, len(i)])
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[i[first]]), pa.array(start[i[first]] << 8 | (n + length - 1))], names=["doc_id", "v"])

    def run(batches):
        held = None
        for batch in batches:
            x = batch.to_pandas()
            x = x if held is None else pd.concat([held, x], ignore_index=True)
            done = (x["head"] != x["head"].iat[-1]).to_numpy()
            out = windows(x[done]) if done.any() else None
            if out is not None:
                yield out
            held = x[~done]
        if held is not None and len(held):
            out = windows(held)
            if out is not None:
                yield out
    return run


def repeated_spans(texts: DataFrame, packed: DataFrame, length: int = LENGTH, hot_from: int = HOT) -> DataFrame:
    """(doc_id, v): spans to remove, ``v`` = start * 256 + size.

    ``texts`` has doc_id and text, ``packed`` the same texts as zstd frames ``z``.
    """
    if not HEAD <= length <= 128:
        raise ValueError("a span's size is packed in one byte")
    dealt = _suffixes(texts, length).repartition("deal")
    scanned = cut_lineage(dealt.sortWithinPartitions("doc_id", "v")
                          .mapInArrow(_scan(length), "doc_id long, v long, kind int"))
    met = cut_lineage(_contexts(packed, scanned.filter("kind = 1"), length))
    # one row for HOT segments or more, at most a 1,024th of ``met``
    hot = F.broadcast(cut_lineage(met.groupBy("head").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > hot_from)
                                  .select("head")))
    cold = met.join(hot, "head", "left_anti").repartition("head").sortWithinPartitions("head", "doc_id", "start")
    return (scanned.filter("kind = 0").select("doc_id", "v")
            .unionAll(cold.mapInArrow(_compare(length), "doc_id long, v long"))
            .unionAll(_hot_spans(met.join(hot, "head", "left_semi"), length)))


def merged(vs: list[int]) -> list[tuple[int, int]]:
    """Maximal runs [start, end) of packed spans."""
    out: list[tuple[int, int]] = []
    for v in sorted(vs):
        a, b = v >> 8, (v >> 8) + (v & 255)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in spans:
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]])


def _packed(texts: DataFrame) -> DataFrame:
    """doc_id, z: texts as zstd frames, which is what a shuffle carries."""
    import zstandard

    def run(batch):
        press = zstandard.ZstdCompressor(level=1)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([press.compress(t) for t in batch.column(1).to_pylist()], pa.binary())],
            names=["doc_id", "z"])
    return per_batch(run, texts, "doc_id long, z binary")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                   with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked, kept_text.

    ``kept_text`` drops characters of which a cut left only some bytes.
    """
    import zstandard

    def settle(batch):
        unpack = zstandard.ZstdDecompressor()
        rows = []
        for i, z, vs in zip(*(c.to_pylist() for c in batch.columns)):
            t = unpack.decompress(z)
            spans = merged(vs or [])
            kept = cut(t, spans)
            rows.append((i, len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                         kept.decode("utf-8", "ignore") if with_text else None))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()][:5 + with_text]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * with_text
    x = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).cast("binary").alias("text"))
    packed = _packed(x)
    spans = repeated_spans(x, packed, length)
    each = spans.groupBy(F.col("doc_id").alias("_d")).agg(F.collect_list("v").alias("vs"))
    joined = packed.join(each, F.col("doc_id") == F.col("_d"), "left").select("doc_id", "z", "vs")
    return per_batch(settle, joined, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                     + ", kept_text string" * with_text)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: str = "n_chars",
                    length: int = LENGTH) -> DataFrame:
    """Rows of ``docs`` with repeats cut from ``text`` and ``size``, if there is such a column, counted anew.

    Characters of which a cut left only some bytes go as well; null texts stay null.
    """
    x = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).cast("binary").alias("text"))
    of, held = fresh(docs, "repeats_of"), fresh(docs, "repeats")
    each = (repeated_spans(x, _packed(x), length).groupBy(F.col("doc_id").alias(of))
            .agg(F.collect_list("v").alias(held)))
    at, count = docs.columns.index(text), docs.columns.index(size) if size in docs.columns else None

    def run(batch):
        columns = batch.columns[:-1]
        texts, spans = columns[at].to_pylist(), batch.column(len(columns)).to_pylist()
        kept = [t if t is None or not vs else
                cut(t.encode("utf-8", "surrogatepass"), merged(vs)).decode("utf-8", "ignore")
                for t, vs in zip(texts, spans)]
        columns[at] = pa.array(kept, columns[at].type)
        if count is not None:
            was = columns[count].to_pylist()
            columns[count] = pa.array([len(t) if t is not None and vs else n for t, vs, n in zip(kept, spans, was)],
                                      columns[count].type)
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    joined = docs.join(each, F.col(doc_id).cast("long") == F.col(of), "left").drop(of)
    return per_batch(run, joined, docs.schema)
