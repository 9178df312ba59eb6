"""Language proportions of whole texts by expectation-maximisation over words.

Letter trigrams are counted per language over a bounded sample of the rows that
may be learned from. A word's likelihood under a language is the product of its
trigrams' probabilities. A text is a mixture of languages: the set starts with
the single best one, and the language with the steepest gain is added as long
as the likelihood, fitted by EM, rises by more than the penalty. The likelihood
is concave in the proportions, so where no gain is positive the set is final.
Texts of a batch are fitted together as segments of one array.

Defined cases: a text that is null or has no letter is ``und`` with score 0 and
no proportions; ties go to the language first by name; without any row to learn
from every text is ``und``; an empty table gives no rows; repeated rows return
as often as they come; further columns are ignored, and ``lang`` is read only
to learn from rows that are not held out.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tideline.llm.common import held_out, per_batch, portions, whole

PER_LANGUAGE = 3000        # expected rows a language is learned from
BUCKETS = 1 << 16          # of hashed trigrams
SMOOTHING = 0.1
FLOOR = 1e-9               # least likelihood of a word relative to its best language
PENALTY = 2.0              # times log(words) / 2 for each further language
STEPS = 20

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every letter with its two neighbours, first letter of every word, text of every word)."""
    low = [t.lower() for t in texts]
    points = np.frombuffer("\n".join(["", *low, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[points]
    c = np.where(letter, points, 0).astype(np.uint32)
    mixed = c[:-2] * np.uint32(0x9E3779B1) + c[1:-1] * np.uint32(0x85EBCA77) + c[2:] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    inside = letter[1:-1]
    begins = inside & ~letter[:-2]
    starts = np.cumsum(inside)[begins] - 1
    ends = np.cumsum([len(t) + 1 for t in low])
    return (mixed >> np.uint32(16))[inside], starts, np.searchsorted(ends, np.flatnonzero(begins), side="right")


def learn(rows: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities by bucket and language) from ``rows`` (id, text, lang)."""
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return [], np.zeros((BUCKETS, 0), np.float32)
    langs = sorted(sizes)
    share = F.create_map(*[x for g in langs for x in (F.lit(g), F.lit(min(1.0, per_language / sizes[g])))])
    some = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)

    def count(batches):
        for batch in batches:
            by_lang: dict[str, np.ndarray] = {}
            names = batch.column(1).to_pylist()
            for at, part in portions(batch.column(0).to_pylist()):
                buckets, starts, text = trigrams(part)
                owner = np.repeat(text, np.diff(np.r_[starts, len(buckets)]))
                for g in set(names[at:at + len(part)]):
                    own = np.array([x == g for x in names[at:at + len(part)]])
                    total = by_lang.setdefault(g, np.zeros(BUCKETS, np.int64))
                    total += np.bincount(buckets[own[owner]], minlength=BUCKETS)
            for g, total in by_lang.items():
                seen = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g] * len(seen), pa.string()), pa.array(seen.astype(np.int32)), pa.array(total[seen])],
                    names=["lang", "bucket", "n"])

    counts = (some.select("text", "lang").mapInArrow(count, "lang string, bucket int, n long")
                  .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())   # languages x buckets at most
    table = np.full((BUCKETS, len(langs)), SMOOTHING)
    table[counts["bucket"], [langs.index(g) for g in counts["lang"]]] += counts["n"]
    return langs, np.log(table / table.sum(axis=0)).astype(np.float32)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first, axis=0)


def _fit(lik, owner, first, n, p):
    """EM from proportions ``p``; returns them with the log likelihood of each text."""
    for _ in range(STEPS):
        part = lik * p[owner]
        part /= part.sum(axis=1, keepdims=True)
        new = _sums(part, first) / n[:, None]
        moved = np.abs(new - p).max(initial=0.0)
        p = new
        if moved < 1e-3:
            break
    return p, _sums(np.log((lik * p[owner]).sum(axis=1)), first)


def mixtures(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Proportions (texts x languages) from the words' log likelihoods; ``first`` is each text's first word."""
    n = np.diff(np.r_[first, len(words)])
    owner = np.repeat(np.arange(len(n)), n)
    top = words.max(axis=1, keepdims=True)
    lik = np.maximum(np.exp(words - top, dtype=np.float64), FLOOR)
    single = _sums(np.log(lik), first)
    p = np.zeros_like(single)
    p[np.arange(len(n)), single.argmax(axis=1)] = 1.0
    best = single.max(axis=1)
    open_ = np.arange(len(n))
    while len(open_):
        sel = np.isin(owner, open_) if len(open_) < len(n) else slice(None)
        part, size = lik[sel], n[open_]
        start = np.r_[0, np.cumsum(size)[:-1]]
        own = np.repeat(np.arange(len(open_)), size)
        now = p[open_]
        gain = _sums(part / (part * now[own]).sum(axis=1, keepdims=True), start) - size[:, None]
        gain[now > 0] = -np.inf
        add = gain.argmax(axis=1)
        able = gain[np.arange(len(open_)), add] > 0
        if not able.any():
            break
        if not able.all():
            part, own = part[able[own]], own[able[own]]
            open_, now, add, size = open_[able], now[able], add[able], size[able]
            start = np.r_[0, np.cumsum(size)[:-1]]
            own = np.repeat(np.arange(len(open_)), size)
        seed = now * 0.9
        seed[np.arange(len(open_)), add] = 0.1
        new, level = _fit(part, own, start, size, seed)
        better = level - best[open_] > PENALTY * np.log(np.maximum(size, 2)) / 2
        p[open_[better]], best[open_[better]] = new[better], level[better]
        open_ = open_[better]
    return p


def judge(texts: list[str], model: tuple[list[str], np.ndarray]):
    """(lang_pred, score, proportions) lists of some texts."""
    langs, table = model
    pred, score, mix = ["und"] * len(texts), [0.0] * len(texts), [None] * len(texts)
    for at, part in portions(texts) if langs else ():
        buckets, starts, owner = trigrams(part)
        if not len(starts):
            continue
        words = np.add.reduceat(table[buckets], starts, axis=0)
        first = np.flatnonzero(np.r_[True, np.diff(owner) > 0])
        for row, q in zip(owner[first].tolist(), mixtures(words, first)):
            b = int(q.argmax())
            pred[at + row], score[at + row] = langs[b], float(min(1.0, q[b]))
            mix[at + row] = [(langs[j], float(q[j])) for j in np.flatnonzero(q > 0)]
    return pred, score, mix


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (the proportion of lang_pred) and proportions of every text."""
    def run(batch):
        pred, score, mix = judge(batch.column(1).to_pylist(), model)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(pred), pa.array(score),
             pa.array(mix, pa.map_(pa.string(), pa.float64()))],
            names=["doc_id", "lang_pred", "score", "proportions"])

    x = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    return per_batch(run, x, "doc_id long, lang_pred string, score double, proportions map<string,double>")


def keep_if(docs: DataFrame, model: tuple[list[str], np.ndarray], least: float, text: str = "text") -> DataFrame:
    """Whole rows of ``docs`` whose main language has at least ``least`` of the words."""
    at = docs.columns.index(text)

    def run(batch):
        texts = [t or "" for t in batch.column(at).to_pylist()]
        pred, score, _ = judge(texts, model)
        return batch.filter(pa.array([g != "und" and s >= least for g, s in zip(pred, score)]))
    return per_batch(run, docs, docs.schema)


def learn_from(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
               per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """``learn`` on the rows of ``docs`` that are not held out."""
    free = docs.filter(~held_out(doc_id))
    return learn(free.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")),
                 per_language)
