"""Benchmark decontamination with a block-max index of the test items.

An inverted index with BM25 impacts is built over the items; every passage of
every document is a query. An impact is divided by the item's own score, so a
passage that holds all of an item's words scores 1, whatever the item's length.

Retrieval skips as WAND does. Within an item, the lightest words, which add up
to less than half the threshold, cannot carry it: a passage that reaches the
threshold holds enough of the others, the pivot words. Only they have postings,
which are added up first against the maxima of blocks of items, then, in blocks that
can still reach the threshold, against single items; both bounds include all
lighter words, so no passage above the threshold is lost. What remains is
scored exactly and verified: the shares of five-word shingles of the question
and of the answer (the item's last sentence or line) found in the passage.

The index travels with the tasks. Items are indexed in parts of at most
``PART_CHARS`` characters, one pass over the documents for each part, so its
size is bounded whatever the benchmark's size. Numbers of items, of words and of
holders of a word, and the length of a passage, are those of all items in every
part, so results do not depend on the parts.

Defined cases: null and wordless texts match nothing; an item without words
indexes nothing; items of one sentence have an empty answer, which always
overlaps; repeated items and documents are reported as often as they come, a
pair once per document row; empty tables give no rows; other columns are ignored.
"""
from __future__ import annotations

import re
from collections import Counter
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tideline.llm.common import per_batch, portions, whole
from tideline.session import cut_lineage

THRESHOLD = 0.6            # of the item's own BM25 score
LIGHT = 0.3                # of it, that an item's words without postings may add up to
OVERLAP = 0.8
SHINGLE = 5
BLOCK = 64                 # items of a block
PART_CHARS = 8 << 20
STRIDE = 64                # words; a passage is two strides, each at least as long as the longest item
K1, B = 1.2, 0.75
WORDS_KEPT = 400_000

_WORD = re.compile(r"\w+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    parts = [w for w in (words(p) for p in re.split(r"[.!?\n]+", text)) if w]
    return list(chain.from_iterable(parts[:-1] or parts)), parts[-1] if len(parts) > 1 else []


def shingles(ids: list[int], size: int = SHINGLE) -> set[tuple[int, ...]]:
    if not ids:
        return set()
    return {tuple(ids[i:i + size]) for i in range(max(1, len(ids) - size + 1))}


def share(part: list[int], passage: list[int]) -> float:
    """Share of the part's shingles that the passage holds in sequence; 1 for an empty part."""
    want = shingles(part)
    if not want:
        return 1.0
    size = min(SHINGLE, len(part))
    return len(want & {tuple(passage[i:i + size]) for i in range(len(passage) - size + 1)}) / len(want)


class Statistics(NamedTuple):
    """Of all items with words: how many, their words, the longest one's words, and the number of holders of a word."""
    items: int
    words: int
    longest: int
    holders: dict[str, int]


class ItemIndex:
    """Impacts of items in compressed rows, their pivot words and block maxima."""

    def __init__(self, items: list[tuple[int, str]], threshold: float = THRESHOLD, over: Statistics | None = None):
        """``over`` describes all items, if these are a part of them."""
        items = sorted(((i, t) for i, t in items if words(t)), key=lambda x: (len(words(x[1])), x[1]))
        self.ids = [i for i, _ in items]
        bags = [Counter(words(t)) for _, t in items]
        self.threshold = threshold
        self.term = {w: k for k, w in enumerate(sorted(set(chain.from_iterable(bags))))}
        self.parts = [tuple([self.term[w] for w in p] for p in question_and_answer(t)) for _, t in items]
        sizes = [sum(b.values()) for b in bags]
        over = over or Statistics(len(bags), sum(sizes), max(sizes, default=0), Counter(chain.from_iterable(bags)))
        self.stride = max(STRIDE, over.longest)
        df, mean = over.holders, over.words / max(1, over.items)
        self.impact, self.lighter, posts = [], np.zeros(len(bags)), []
        for i, bag in enumerate(bags):
            long = K1 * (1 - B + B * sum(bag.values()) / mean)
            w = {self.term[t]: np.log(1 + (over.items - df[t] + 0.5) / (df[t] + 0.5)) * n * (K1 + 1) / (n + long)
                 for t, n in bag.items()}
            own = sum(w.values())
            w = {t: x / own for t, x in w.items()}
            self.impact.append(w)
            for t, x in sorted(w.items(), key=lambda e: (e[1], e[0])):
                if self.lighter[i] + x < LIGHT:
                    self.lighter[i] += x
                else:
                    posts.append((t, i, x))
        posts.sort()
        self.pivot = self._rows(posts)
        blocks: dict[tuple[int, int], float] = {}
        for t, i, x in posts:
            blocks[t, i // BLOCK] = max(blocks.get((t, i // BLOCK), 0.0), x)
        self.block = self._rows(sorted((t, b, x) for (t, b), x in blocks.items()))
        self.block_lighter = np.array([self.lighter[k:k + BLOCK].max() for k in range(0, len(bags), BLOCK)])

    def _rows(self, posts):
        """Postings as (start of each term, targets, impacts)."""
        t = np.array([p[0] for p in posts], np.int64)
        start = np.searchsorted(t, np.arange(len(self.term) + 1))
        return start, np.array([p[1] for p in posts], np.int64), np.array([p[2] for p in posts])

    @staticmethod
    def _reach(rows, passage, term, lighter, threshold, only=None):
        """(passage, target) pairs whose impacts and lighter words can reach the threshold."""
        start, target, impact = rows
        n = start[term + 1] - start[term]
        at = np.repeat(start[term] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        key = np.repeat(passage, n) * (len(lighter) + 1) + target[at]
        x = impact[at]
        if only is not None:
            some = np.isin(np.repeat(passage, n) * only[1] + target[at] // BLOCK, only[0])
            key, x = key[some], x[some]
        pairs, slot = np.unique(key, return_inverse=True)
        total = np.bincount(slot, weights=x, minlength=len(pairs))
        p, t = np.divmod(pairs, len(lighter) + 1)
        ok = total + lighter[t] >= threshold - 1e-9
        return p[ok], t[ok]

    def candidates(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """(passage, item) that can reach the threshold; passage k covers two strides from word k * stride."""
        heavy = self.pivot[0][1:] > self.pivot[0][:-1]
        at = np.flatnonzero(np.r_[heavy, False][ids])          # unknown words are -1, the added False
        if not len(at):
            return []
        stride = at // self.stride
        passage, term = np.r_[stride, stride - 1], np.r_[ids[at], ids[at]].astype(np.int64)
        some = passage >= 0
        key = np.unique(passage[some] * len(self.term) + term[some])
        passage, term = np.divmod(key, len(self.term))
        p, b = self._reach(self.block, passage, term, self.block_lighter, self.threshold)
        if not len(p):
            return []
        width = len(self.block_lighter) + 1
        alive = np.isin(passage, p)
        p, i = self._reach(self.pivot, passage[alive], term[alive], self.lighter, self.threshold, (p * width + b, width))
        return list(zip(p.tolist(), i.tolist()))

    def matches(self, texts: list[np.ndarray]) -> list[list[tuple[int, float, float, float, int]]]:
        """Per text, (item, score, question overlap, answer overlap, first word) of the best verified passage per item.

        Texts are laid out in one array, each followed by a blank stride; the
        passages that begin there are left out, so none spans two texts.
        """
        strides = np.array([-(-len(t) // self.stride) + 1 for t in texts])
        first = np.cumsum(strides) - strides
        ids = np.full(strides.sum() * self.stride, -1, np.int32)
        for t, at in zip(texts, first * self.stride):
            ids[at:at + len(t)] = t
        best: list[dict[int, tuple]] = [{} for _ in texts]
        sets: dict[int, set] = {}
        blank = set((first + strides - 1).tolist())
        for k, i in self.candidates(ids):
            if k in blank:
                continue
            have = sets.get(k)
            if have is None:
                have = sets[k] = set(ids[k * self.stride:(k + 2) * self.stride].tolist())
            score = sum(x for t, x in self.impact[i].items() if t in have)
            if score < self.threshold:
                continue
            passage = ids[k * self.stride:(k + 2) * self.stride].tolist()
            q, a = (share(part, passage) for part in self.parts[i])
            if q < OVERLAP or a < OVERLAP:
                continue
            row = int(np.searchsorted(first, k, side="right")) - 1
            old = best[row].get(i)
            if old is None or (score, q + a) > (old[1], old[2] + old[3]):
                best[row][i] = (i, float(score), q, a, int(k - first[row]) * self.stride)
        return [list(b.values()) for b in best]


class Terms:
    """Term numbers of whole texts; a blank-separated piece is looked up once and remembered."""

    def __init__(self, term: dict[str, int], cut=words):
        self.term, self.known, self.cut = term, {}, cut

    def ids(self, text: str) -> np.ndarray:
        parts = text.split()
        new = set(parts).difference(self.known)
        if new:
            if len(self.known) > WORDS_KEPT:
                self.known.clear()
                new = set(parts)
            for p in new:
                self.known[p] = np.array([self.term.get(w, -1) for w in self.cut(p)], "<i4").tobytes()
        return np.frombuffer(b"".join(map(self.known.__getitem__, parts)), "<i4")


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD,
                 part_chars: int = PART_CHARS) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap, first_word of every verified match."""
    items = items.select(F.col(item_id).cast("long").alias("item_id"), whole(item_text).alias("text"))
    parts = max(1, -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // part_chars))
    items = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    x = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    held = cut_lineage(_words_of(items))
    every = held.filter("word IS NULL").agg(F.count("n"), F.sum("n"), F.max("n")).first()
    holders = cut_lineage(held.filter("word IS NOT NULL").groupBy("word")
                              .agg(F.count(F.lit(1)).alias("n"), F.collect_set("part").alias("parts")))
    found = None
    for part in range(parts):
        own = [tuple(r) for r in items.filter(F.col("part") == part).select("item_id", "text").collect()]
        words_of = holders.filter(F.array_contains("parts", F.lit(part).cast("long"))).select("word", "n").collect()
        over = Statistics(every[0], every[1] or 0, every[2] or 0, {w: n for w, n in words_of})
        got = _matches(x, ItemIndex(own, threshold, over))
        found = got if found is None else found.unionAll(got)
    return found


def _words_of(items: DataFrame) -> DataFrame:
    """part, word, n: a row of each distinct word of an item (n = 1) and one of its number of words (no word)."""
    def run(batch):
        rows = []
        for part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            bag = words(text)
            if bag:
                rows.append((part, None, len(bag)))
                rows.extend((part, w, 1) for w in set(bag))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
            zip(*rows) if rows else [[]] * 3, (pa.int64(), pa.string(), pa.int64()))], names=["part", "word", "n"])
    return per_batch(run, items.select("part", "text"), "part long, word string, n long")


def _matches(docs: DataFrame, index: ItemIndex) -> DataFrame:
    schema = ("doc_id long, item_id long, score double, question_overlap double, answer_overlap double, "
              "first_word long")
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]

    def run(batches):
        terms = Terms(index.term)
        for batch in batches:
            rows = []
            doc, texts = (c.to_pylist() for c in batch.columns)
            for at, part in portions(texts):
                for i, found in zip(doc[at:], index.matches([terms.ids(t) for t in part])):
                    rows.extend((i, index.ids[item], *rest) for item, *rest in found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)],
                names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word"])
    return docs.mapInArrow(run, schema)
