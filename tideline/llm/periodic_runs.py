"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a stretch with smallest period q, four periods and six words long or
more, that no neighbouring word extends. At scale B a text is cut into blocks
that start at multiples of B. A run of period q in B .. 2B - 1 holds a whole
block and that block's copy q words on, so it is enough to look for every block
in the words B .. 2B - 1 behind its start. The sum of squared differences of
word numbers is zero exactly where a block occurs; expanded, it needs sums of
squares and one cross-correlation, which an integer transform modulo 65,537
gives for all distances at once. A true occurrence is zero under any modulus;
the few false zeros fall when words are compared.

Each zero is a seed (place, distance) that is extended word by word both ways
while words at that distance are the same. Equal stretches are one run with the
least distance. Seeds inside a run found at a smaller scale, at a multiple of
its period, are that run again and are not extended. Blocks that lie with their
whole window inside such a run, and blocks with a word that does not recur
within 2B words, cannot give a new seed and are not transformed; nothing else
is left out. Blocks beyond 32,768 words are looked for by their first 32,768
(the extension settles the rest), so a transform has 65,536 points at most.

Work and memory grow with the text: a scale holds a bounded number of blocks in
memory at a time, and a text is one row of one task.

Defined cases: a null, empty or wordless text has no runs and an empty
collapsed text; a null doc_id is kept; repeated rows give repeated rows; an
empty table gives no rows; further columns are ignored.
"""
from __future__ import annotations

import re
from collections import defaultdict
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tideline.llm.common import SPACES, portions, whole

PRIME, ROOT = 65537, 3     # 2^16 + 1 and a generator of its 2^16 units
LONGEST = 1 << 15          # words of a block that are transformed
LEAST, PERIODS = 6, 4      # words and periods of a run
CELLS = 1 << 16            # numbers transformed together
STEP = 64                  # words compared first when a seed is extended

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _fold(x: np.ndarray) -> np.ndarray:
    """A small number of the same residue: 2^16 is -1."""
    return (x & 0xFFFF) - (x >> 16)


@cache
def _powers(half: int, back: bool) -> np.ndarray:
    root = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
    root = pow(root, PRIME - 2, PRIME) if back else root
    out = np.ones(half, np.int64)
    done = 1
    while done < half:                               # doubling: the next powers are those so far times root^done
        out[done:2 * done] = out[:done] * pow(root, done, PRIME) % PRIME
        done *= 2
    return out[:, None]


def transform(x: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of the columns, in bit-reversed order; magnitudes stay below 2^33."""
    size, columns = x.shape
    half = size // 2
    while half:
        part = x.reshape(size // (2 * half), 2, half, columns)
        first, second = part[:, 0], part[:, 1]
        x = np.stack([first + second, _fold((first - second) * _powers(half, False))], axis=1)
        half //= 2
    return x.reshape(size, columns)


def back(x: np.ndarray) -> np.ndarray:
    """Inverse of ``transform`` times the number of rows."""
    size, columns = x.shape
    half = 1
    while half < size:
        part = x.reshape(size // (2 * half), 2, half, columns)
        first, second = part[:, 0], _fold(part[:, 1] * _powers(half, True))
        x = np.stack([first + second, first - second], axis=1)
        half *= 2
    return x.reshape(size, columns)


def zeros(block: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Whether block column j has no squared difference, modulo the prime, to its window from row s on; (s, j).

    Blocks have ``size`` rows, windows twice as many; s < size.
    """
    size, columns = block.shape
    turned = np.zeros((2 * size, columns), np.int64)
    turned[0], turned[size + 1:] = block[0], block[:0:-1]
    both = _fold(_fold(transform(turned))) * _fold(_fold(transform(window)))
    cross = back(_fold(both))[:size] % PRIME * pow(2 * size, PRIME - 2, PRIME) % PRIME
    sums = np.zeros((2 * size + 1, columns), np.int64)
    np.cumsum(window * window % PRIME, axis=0, out=sums[1:])
    squares = (block * block % PRIME).sum(axis=0) + sums[size:2 * size] - sums[:size]
    return (squares - 2 * cross) % PRIME == 0


def seeds(x: np.ndarray, at: np.ndarray, end: np.ndarray, scale: int):
    """(place, distance, index of the block) with a zero, for blocks that start at ``at`` in texts that end at ``end``."""
    size = min(scale, LONGEST)
    step = max(1, CELLS // (2 * size))
    padded = np.concatenate([x, np.zeros(2 * size, np.int64)]) % PRIME
    for tile in range(scale // size):
        distance = scale + tile * size               # of the window's first row
        for first in range(0, len(at), step):
            here, limit = at[first:first + step], end[first:first + step]
            rows = np.arange(2 * size)[:, None]
            block = padded[here[None, :] + rows[:size]]
            window = padded[np.minimum(here[None, :] + distance + rows, len(padded) - 1)]
            inside = here[None, :] + distance + rows[:size] + size <= limit[None, :]
            s, j = np.nonzero(zeros(block, window) & inside)
            if len(s):
                yield here[j], distance + s, first + j


def _same(x: np.ndarray, a: int, b: int, limit: int) -> int:
    """Number of equal words from a and b on, fewer than ``limit`` + 1."""
    done, step = 0, STEP
    while done < limit:
        n = min(step, limit - done)
        differ = np.flatnonzero(x[a + done:a + done + n] != x[b + done:b + done + n])
        if len(differ):
            return done + int(differ[0])
        done, step = done + n, step * 4
    return done


def _same_before(x: np.ndarray, a: int, b: int, limit: int) -> int:
    """Number of equal words that end ahead of a and b."""
    done, step = 0, STEP
    while done < limit:
        n = min(step, limit - done)
        differ = np.flatnonzero(x[a - done - n:a - done] != x[b - done - n:b - done])
        if len(differ):
            return done + n - 1 - int(differ[-1])
        done, step = done + n, step * 4
    return done


def _extended(x, start, end, place, distance, size, found: dict) -> None:
    """Enter the runs of one text's seeds into ``found``: (first, end) -> least period."""
    keep = np.ones(len(place), bool)
    order = np.lexsort((place, distance))
    by_place = np.argsort(place, kind="stable")
    sorted_place = place[by_place]
    for (first, last), period in found.items():
        low, high = np.searchsorted(sorted_place, (first, last))
        some = by_place[low:high]
        keep[some[(place[some] + distance[some] + size <= last) & (distance[some] % period == 0)]] = False
    done_at, done_to = -1, -1
    new = {}
    for k in order[keep[order]]:
        u, d = int(place[k]), int(distance[k])
        if d == done_at and u < done_to:
            continue
        right = _same(x, u, u + d, end - u - d)
        if right < size:
            continue                                 # zero by the modulus only
        left = _same_before(x, u, u + d, u - start)
        done_at, done_to = d, u + right
        first, last = u - left, u + right + d
        if last - first >= max(LEAST, PERIODS * d):
            new[first, last] = min(d, new.get((first, last), d))
    for place_of, period in new.items():
        found[place_of] = min(period, found.get(place_of, period))


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) by start, then period, of the runs of each sequence of word numbers."""
    lengths = np.array([len(t) for t in texts], np.int64)
    x = np.concatenate([np.zeros(0, np.int64), *texts])
    ends = np.cumsum(lengths)
    starts = ends - lengths
    of = np.repeat(np.arange(len(texts)), lengths)
    order = np.lexsort((x, of))                      # stable: equal words of a text in their order
    again = np.full(len(x), len(x) + 1, np.int64)    # words until the same word comes again
    same = (x[order[1:]] == x[order[:-1]]) & (of[order[1:]] == of[order[:-1]])
    again[order[:-1][same]] = (order[1:] - order[:-1])[same]
    found: list[dict] = [{} for _ in texts]
    scale = 1
    while True:
        able = np.flatnonzero(lengths >= max(LEAST, PERIODS * scale))
        if not len(able):
            break
        size = min(scale, LONGEST)
        each = (lengths[able] - 2 * scale) // scale + 1
        doc = np.repeat(able, each)
        at = starts[doc] + scale * (np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each))
        lone = np.zeros(len(x) + 1, np.int64)
        np.cumsum(again >= 2 * scale, out=lone[1:])
        keep = lone[at + size] == lone[at]           # every word of the block recurs within the reach
        for i in able[[bool(found[i]) for i in able]]:
            low, high = np.searchsorted(doc, (i, i + 1))
            for (first, last), period in found[i].items():
                a, b = np.searchsorted(at[low:high], (first, last - 3 * scale + 1)) + low
                keep[a:b] = False                    # period <= scale: only its multiples can be found
        doc, at = doc[keep], at[keep]
        hits = list(seeds(x, at, ends[doc], scale)) if len(at) else []
        if hits:
            place, distance, block = map(np.concatenate, zip(*hits))
            owner = doc[block]
            by = np.argsort(owner, kind="stable")
            for some in np.split(by, np.flatnonzero(np.diff(owner[by])) + 1):
                i = owner[some[0]]
                _extended(x, int(starts[i]), int(ends[i]), place[some], distance[some], size, found[i])
        scale *= 2
    return [sorted((first - int(s), last - first, period) for (first, last), period in f.items())
            for f, s in zip(found, starts)]


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words some run holds behind its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) > 0


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and the collapsed text of every row."""
    run_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            counts, runs, collapsed = [], [], []
            for _, part in portions(texts):
                words = [_WORD.findall(t) for t in part]
                number = defaultdict(count().__next__).__getitem__
                found = runs_of([np.fromiter(map(number, w), np.int64, len(w)) for w in words])
                for w, r in zip(words, found):
                    counts.append(len(w))
                    runs.append([dict(zip(("start", "length", "period"), x)) for x in r])
                    if r:
                        w = [w[i] for i in np.flatnonzero(~dropped(len(w), r))]
                    collapsed.append(" ".join(w))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(counts, pa.int64()), pa.array(runs, run_type), pa.array(collapsed, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    x = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    return x.mapInArrow(lambda batches: run(b for b in batches if b.num_rows),
                        "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
                        "collapsed string")


def with_planted_runs(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The text; of one document in ten, chosen by a hash of doc_id, with a periodic tail in place of its last words."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(whole(text), SPACES + "+"), lambda w: w != "")
    parts = F.struct(words.alias("w"), g.alias("g"))

    def planted(p):
        n = F.size(p.w).cast("long")
        a = F.pmod(p.g, n)
        period = 1 + F.floor((n - a) / (3 + F.pmod(p.g, F.lit(8))))
        return F.array_join(F.transform(p.w, lambda word, i: F.when(i < a, word).otherwise(
            F.get(p.w, (a + F.pmod(i - a, period)).cast("int")))), " ")
    tail = F.element_at(F.transform(F.array(parts), lambda p: planted(p)), 1)
    return F.when((F.pmod(h, F.lit(10)) == 0) & (F.size(words) > 0), tail).otherwise(whole(text))


def digests(found: DataFrame) -> DataFrame:
    """The greatest run (longest, then first) and sha256 of all runs and of the collapsed text, from ``periodic_runs``."""
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("down"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    x = found.withColumn("_best", best)
    return x.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"),
                    (-F.col("_best.down")).alias("length"), F.col("_best.period").alias("period"),
                    F.expr("-1000 * _best.down div _best.period").alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
