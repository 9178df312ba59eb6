"""Periodic runs against every stretch of small sequences, and the query against a plain scan of each distance."""
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tideline.llm import periodic_runs as op
from tideline.llm.common import table

SCHEMA = "doc_id long, text string"


def plain(w):
    """Runs of a sequence by one scan for each distance."""
    best, n = {}, len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            first = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - first >= max(6, 4 * q):
                best.setdefault((first, i + q), q)
    return sorted((a, b - a, q) for (a, b), q in best.items())


def by_definition(w):
    """Runs of a sequence straight from the definition."""
    n = len(w)

    def has(a, b, q):
        return all(w[i] == w[i + q] for i in range(a, b - q))
    out = []
    for a in range(n):
        for b in range(a + 6, n + 1):
            q = next(q for q in range(1, b - a + 1) if has(a, b, q))
            if b - a >= 4 * q and not (a and has(a - 1, b, q)) and not (b < n and has(a, b + 1, q)):
                out.append((a, b - a, q))
    return sorted(out)


def numbers(rows):
    return [np.array(r, np.int64) for r in rows]


def test_plain_is_the_definition():
    rng = random.Random(1)
    for _ in range(150):
        w = [rng.randrange(2) for _ in range(rng.randrange(26))]
        assert plain(w) == by_definition(w)


@pytest.mark.parametrize("longest", [1, 4, op.LONGEST])
def test_random_sequences(longest, monkeypatch):
    monkeypatch.setattr(op, "LONGEST", longest)
    monkeypatch.setattr(op, "CELLS", 64)
    rng = random.Random(longest)
    rows = [[], [3], [5] * 6, [5] * 5, [70000] * 300, [0, 65537] * 20]
    for _ in range(300):
        part = [rng.randrange(rng.choice([2, 3, 60])) for _ in range(rng.randrange(1, 40))]
        times = rng.randrange(1, 12)
        noise = [rng.randrange(5) for _ in range(rng.randrange(30))]
        rows.append(noise + part * times + part[:rng.randrange(len(part) + 1)] + noise[::-1])
    for _ in range(40):                              # runs of runs
        a, b = [0] * rng.randrange(1, 9), [1] * rng.randrange(1, 9)
        rows.append((a + b) * rng.randrange(1, 9) + a * 3 + (b + a) * rng.randrange(7))
    assert op.runs_of(numbers(rows)) == [plain(r) for r in rows]


def test_zeros_are_occurrences():
    rng = np.random.default_rng(4)
    for size in (1, 2, 8, 64):
        window = rng.integers(0, 2, (2 * size, 30))
        block = np.array([window[s:s + size, j] for j, s in enumerate(rng.integers(0, size, 30))]).T
        got = op.zeros(block, window)
        assert (got == [[(block[:, j] == window[s:s + size, j]).all() for j in range(30)] for s in range(size)]).all()


def test_long_period_and_one_word():
    rng = random.Random(9)
    part = [rng.randrange(10 ** 6) for _ in range(40_000)]
    rows = [part * 4 + part[:100], [1] * 100_000, [i % 7 for i in range(90_000)]]
    assert op.runs_of(numbers(rows)) == [[(0, 160_100, 40_000)], [(0, 100_000, 1)], [(0, 90_000, 7)]]


def expected(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if n and h is not None and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain(w)
    gone = {i for a, length, q in runs for i in range(a + q, a + length)}
    best = min(((-length, a, q) for a, length, q in runs), default=None)
    top = (None,) * 4 if best is None else (best[1], -best[0], best[2], -1000 * best[0] // best[2])

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *top, sha("".join(f"{a},{length},{q}\n" for a, length, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query(spark, small):
    import __spark_entry__
    rows = [tuple(r) for r in table(spark, small, "documents").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in __spark_entry__.queries()["op13_periodic_runs"](spark, small).select(*COLUMNS).collect())
    assert got == sorted(expected(*r) for r in rows)
    assert sum(r[1] for r in got) > 5


def test_odd_rows(spark):
    tail = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0][:6]
    rows = [(None, "a " * 8), (None, None), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "na\tna na\nna na na"),
            (5, "x y " * 3000), (5, "x y " * 3000), (6, "a b " * 9), (tail[0], ""), (tail[1], None),
            (tail[2], "one"), (tail[3], "the words of this text are many and go on " * 2),
            (tail[4], " ".join(map(str, range(500)))), (tail[5], "b " * 77)]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA + ", runs int, collapsed string")
    docs = docs.withColumn("text", op.with_planted_runs())
    got = op.digests(op.periodic_runs(docs)).select(*COLUMNS).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(expected(*r)) for r in rows)
    assert op.digests(op.periodic_runs(docs.limit(0))).count() == 0
