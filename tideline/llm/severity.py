"""Toxicity as a severity grade by cumulative-link ordinal regression.

P(grade <= k) = logistic(cut_k - w . x): one weight vector is shared by all
ordered cuts, x is the log count of each word and word beginning of a learned
vocabulary, and the answer is the expected grade. Where labels are binary, the grades are 0
for clean texts and 1 or 2 for toxic ones, by how much they hold of the words
that are clearly more frequent in toxic rows than in clean ones.

The model is fitted on a bounded sample of labelled rows; scoring covers every
whole text, cut into words once per distinct blank-separated piece.

Defined cases: null and empty texts hold no word and get the grade the cuts
alone give; null labels are not learned from; with one class only, or none,
every severity is that class, 0 without labels; an empty table gives no rows;
repeated rows return as often as they come; further columns are ignored.
"""
from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tideline.llm.common import held_out, whole
from tideline.llm.decontaminate import Terms, words as plain_words

SAMPLE = 8_000             # expected labelled rows to learn from
VOCABULARY = 8192          # features that tell the classes apart best
SURE = 4.0                 # standard errors by which a feature's log odds must be above zero
LEAST_ROWS = 5             # different texts a feature must occur in
BEGINNINGS = (3, 4, 5, 6)  # letters of a word's beginnings, which inflected and compound forms share
RIDGE = 1e-5
ROUNDS = 400
START = 0.1                # of a feature's log odds, as first weight


@dataclass
class OrdinalModel:
    vocabulary: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    cuts: np.ndarray = field(default_factory=lambda: np.zeros(0))
    lowest: int = 0                                  # grade below the first cut

    def probabilities(self, eta: np.ndarray) -> np.ndarray:
        below = _logistic(self.cuts[None, :] - eta[:, None])
        edge = np.ones((len(eta), 1))
        return np.diff(np.concatenate([0 * edge, below, edge], axis=1), axis=1)


def features(word: str) -> list[str]:
    """A word, and its beginnings marked by a dash."""
    return [word, *(word[:k] + "-" for k in BEGINNINGS if len(word) > k)]


def words(text: str) -> list[str]:
    return [f for w in plain_words(text) for f in features(w)]


def bag(text: str) -> Counter:
    out = Counter()
    for w, n in Counter(plain_words(text)).items():
        for f in features(w):
            out[f] += n
    return out


def _logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def odds(pairs: list[tuple[str, int]], least: int = LEAST_ROWS) -> dict[str, tuple[float, float]]:
    """(smoothed log odds between toxic and clean rows, the same over its standard error) of each feature."""
    seen = (Counter(), Counter())
    for text, toxic in pairs:
        seen[toxic].update(bag(text).keys())
    n1 = sum(y for _, y in pairs)
    n0 = len(pairs) - n1
    out = {}
    for w, one in seen[1].items():
        if one + seen[0][w] >= least:
            a, b = one + 0.5, seen[0][w] + 0.5
            x = float(np.log(a / (n1 - a + 1)) - np.log(b / (n0 - b + 1)))
            out[w] = x, x / float(np.sqrt(1 / a + 1 / b))
    return out


def value(count):
    """Feature value of a word's count in a text."""
    return np.log2(1 + count)


def grades(held: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """0 for clean rows; toxic rows 1, or 2 where they hold more telling features than the median toxic row."""
    return np.where(toxic, np.where(held > np.median(held[toxic]), 2, 1), 0)


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, start: np.ndarray, grade: np.ndarray,
                ridge: float = RIDGE, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(weights, cuts) of the mean likelihood with a ridge, by Adam on all rows.

    ``rows``, ``cols`` and ``values`` are the entries of the feature matrix,
    ``start`` the first weights; grades are 0..K with every grade present. Cuts
    stay ordered as sums of exponentials.
    """
    n, width = len(grade), len(start)
    top = int(grade.max())
    share = np.cumsum(np.bincount(grade, minlength=top + 1))[:-1] / n
    cuts = np.log(share / (1 - share))
    step = np.r_[cuts[0], np.log(np.maximum(np.diff(cuts), 1e-3))]
    theta = np.r_[start, step]
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        w, step = theta[:width], theta[width:]
        cuts = np.cumsum(np.r_[step[0], np.exp(step[1:])])
        eta = np.bincount(rows, weights=w[cols] * values, minlength=n)
        edges = np.concatenate([np.full((n, 1), -40.0), cuts[None, :] - eta[:, None], np.full((n, 1), 40.0)], axis=1)
        below = _logistic(edges)
        slope = below * (1 - below)
        i = np.arange(n)
        p = np.maximum(below[i, grade + 1] - below[i, grade], 1e-12)
        up, down = slope[i, grade + 1] / p, slope[i, grade] / p
        g_eta = (up - down) / n
        g_cut = np.array([(-up * (grade == k) + down * (grade == k + 1)).sum() / n for k in range(top)])
        g_step = np.cumsum(g_cut[::-1])[::-1] * np.r_[1.0, np.exp(step[1:])]
        grad = np.r_[np.bincount(cols, weights=g_eta[rows] * values, minlength=width) + ridge * w, g_step]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return theta[:width], np.cumsum(np.r_[theta[width], np.exp(theta[width + 1:])])


def learn(pairs: list[tuple[str, int]], vocabulary: int = VOCABULARY) -> OrdinalModel:
    """Model from (text, toxic) rows, of which there are few enough for one machine.

    Equal rows count once: copies would make every word they share look telling.
    """
    pairs = sorted(set((t, int(y)) for t, y in pairs))
    toxic = np.array([y for _, y in pairs], bool)
    if not len(pairs) or toxic.all() or not toxic.any():
        return OrdinalModel(lowest=int(len(pairs) > 0 and toxic.all()))
    tell = odds(pairs)
    best = sorted((w for w, (_, z) in tell.items() if z >= SURE), key=lambda w: (-tell[w][1], w))[:vocabulary]
    index = {w: i for i, w in enumerate(best)}
    hits = [(r, index[w], value(n)) for r, (t, _) in enumerate(pairs) for w, n in bag(t).items() if w in index]
    rows, cols, values = (np.array([h[k] for h in hits], kind) for k, kind in enumerate((int, int, float)))
    grade = grades(np.bincount(rows, weights=values, minlength=len(pairs)), toxic)
    if not (grade == 2).any():
        grade = np.minimum(grade, 1)
    start = np.array([tell[w][0] for w in best], float) * START
    weights, cuts = fit_ordinal(rows, cols, values, start, grade)
    return OrdinalModel(index, weights, cuts)


def learn_from(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
               label: str = "toxic", sample: int = SAMPLE) -> OrdinalModel:
    """``learn`` on about ``sample`` labelled rows that are not held out, chosen by a hash of the id."""
    marked = labels.filter(f"{label} IN (0, 1)").filter(~held_out(doc_id)).select(
        F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    total = marked.count()
    share = min(1.0, sample / total) if total else 1.0
    some = marked.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share * 1_000_000)
    rows = some.join(docs.select(F.col(doc_id).alias("id"), whole(text).alias("text")), "id")
    return learn([(r["text"], r["label"]) for r in rows.select("text", "label").toLocalIterator()])


def toxicity(docs: DataFrame, model: OrdinalModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, expected_severity, p_toxic = P(grade >= 1), severity (likeliest grade), toxic (p_toxic >= 0.5)."""
    def run(batches):
        terms = Terms(model.vocabulary, words)
        for batch in batches:
            eta = np.zeros(batch.num_rows)
            for i, t in enumerate(batch.column(1).to_pylist()):
                ids, n = np.unique(terms.ids(t), return_counts=True)
                eta[i] = (model.weights[ids[ids >= 0]] * value(n[ids >= 0])).sum()
            p = model.probabilities(eta)
            grade = np.arange(p.shape[1]) + model.lowest
            clean = p[:, 0] if model.lowest == 0 else np.zeros(len(eta))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p @ grade), pa.array(1 - clean),
                 pa.array(grade[p.argmax(axis=1)].astype(np.int32)), pa.array((clean <= 0.5).astype(np.int32))],
                names=["doc_id", "expected_severity", "p_toxic", "severity", "toxic"])

    x = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    return x.mapInArrow(lambda batches: run(b for b in batches if b.num_rows),
                        "doc_id long, expected_severity double, p_toxic double, severity int, toxic int")
