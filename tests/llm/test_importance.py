"""Importance resampling against counts over whole texts, without lines."""
import hashlib
import math
import re
import zlib
from collections import Counter

from tideline.llm import importance
from tideline.llm.common import table

SCHEMA = "doc_id long, text string"


def features(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(w), [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def plain(rows, target, percent=5, least=20, buckets=10000, seed=42):
    """Sorted rows (doc_id, n_features, weight, score, rank)."""
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, features(text)[1]))
    for text in target:
        t.update(map(bucket, features(text)[1]))
    S, T = float(sum(s.values())), float(sum(t.values()))
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (S + buckets) / ((s[b] + 1.0) * (T + buckets))))
            for b in range(buckets)}
    out = []
    for d, text in rows:
        n, f = features(text)
        weight = sum(gain[bucket(x)] for x in f)
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, n, len(f), weight, score, None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], -1 if r[0] is None else r[0]))
    for k, r in enumerate(able[:len(able) * percent // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()),
                  key=repr)


def test_query(spark, small):
    import __spark_entry__
    rows = [tuple(r) for r in table(spark, small, "documents").select("doc_id", "text").collect()]
    target = [r.text for r in table(spark, small, "benchmark").collect()]
    assert rows_of(__spark_entry__.queries()["op12_importance_resampling"](spark, small)) == plain(rows, target)


def test_runs_across_lines():
    for text in ("a b c\nd e f", "a\nb\nc\nd", "a\n\n - \nb c\nd", "a b\nc\nd e\n", "one", "", "x\ny", "A-B c\nÉ9 d\n\ne"):
        lines = importance.lines_of(text.encode())
        got = Counter(importance.crossing(lines))
        joined = [b" ".join(w) for w in lines]
        if joined:
            got.update(importance.inside(joined)[1].tolist())
        assert got == Counter(zlib.crc32(f.encode()) for f in features(text)[1]), text


def test_odd_rows_hot_lines_and_ties(spark, monkeypatch):
    monkeypatch.setattr(importance, "HOT", 6)        # the first line is looked up, the others are joined
    monkeypatch.setattr(importance, "PORTION", 50)
    common = "the line that every text repeats\n"
    rows = [(i, common * 3 + f"own words of text {i % 7}\nup\nto\nthe end " * (i % 5)) for i in range(60)]
    rows += [(None, common + "no id " * 20), (100, None), (101, ""), (102, "\n\r\t -- \n"), (103, "x " * 5000),
             (7, "another text of the same id " * 6), (104, common * 9), (104, common * 9)]
    target = ["the end of text", None, "own words\nup to", "LINE that"]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", rank int, line int")
    items = spark.createDataFrame([(t,) for t in target], "text string")
    got = rows_of(importance.resample(docs, items, percent=30))
    want = plain(rows, target, percent=30)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert sorted(r[5] for r in got if r[5]) == list(range(1, 1 + sum(r[5] is not None for r in want)))
    assert [r for r in got if r[0] not in (7, 104)] == [r for r in want if r[0] not in (7, 104)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert importance.resample(none, none).count() == 0
    some = spark.createDataFrame([(1, "a b c")], SCHEMA)
    assert rows_of(importance.resample(some, none)) == plain([(1, "a b c")], [])
