"""Frequent strings whose neighbours differ, compared by a row for each window."""
import random

from brute import spans_removed
from tideline.llm import suffix_index
from tideline.llm.common import table


def test_frequent_core_is_not_one_task(spark, monkeypatch):
    """No task of the comparison gets more than ``HOT`` segments of one core."""
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    line = word(90)
    rows = [(i, word(rng.randint(40, 160)) + line + word(rng.randint(40, 160))) for i in range(300)]
    rows += [(300 + i, rows[i][1][20:] + word(30)) for i in range(0, 300, 7)]
    plain = suffix_index._compare

    def watched(length):
        run = plain(length)

        def counted(batches):
            def seen(batch):
                heads = batch.column(0).to_pylist()
                most = max(map(heads.count, set(heads)))
                if most > 50:
                    raise AssertionError(f"{most} segments of one core in a task")
                return batch
            return run(seen(b) for b in batches)
        return counted
    monkeypatch.setattr(suffix_index, "_compare", watched)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spans = suffix_index.repeated_spans(docs.selectExpr("doc_id", "CAST(text AS BINARY) AS text"),
                                        suffix_index._packed(docs.selectExpr("doc_id", "CAST(text AS BINARY) AS text")),
                                        hot_from=50)
    got = {}
    for r in spans.collect():
        got.setdefault(r.doc_id, []).append(r.v)
    size = {d: len(t) for d, t in rows}
    cut = {d: sum(b - a for a, b in suffix_index.merged(vs)) for d, vs in got.items()}
    assert {d: (size[d], cut.get(d, 0)) for d in size} == {d: x[:2] for d, x in spans_removed(rows).items()}


def test_every_core_by_windows(spark, small):
    """The row for each window gives the spans of the comparison in tasks."""
    docs = table(spark, small, "documents").selectExpr("doc_id", "CAST(text AS BINARY) AS text")

    def cut(hot_from):
        got = {}
        for r in suffix_index.repeated_spans(docs, suffix_index._packed(docs), hot_from=hot_from).collect():
            got.setdefault(r.doc_id, []).append(r.v)
        return {d: suffix_index.merged(vs) for d, vs in got.items()}
    assert cut(0) == cut(10 ** 9) != {}
