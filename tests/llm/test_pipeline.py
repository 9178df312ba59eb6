"""Every pipeline stage against a plain version on its own input."""
import corpus_pipeline
from brute import spans_removed
from test_resemblance import plain
from tideline.llm.common import table
from tideline.session import cut_lineage


def test_stages(spark, small):
    docs = table(spark, small, "documents")
    items = [b for _, b in table(spark, small, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = cut_lineage(stage(spark, docs, small))
        if name == "pack":
            assert {r.doc_id for r in out.collect()} == set(before)
            total = out.agg({"length": "sum"}).first()[0]
            assert out.select("sequence_id").distinct().count() <= -(-total // 2048) + 1
            break
        assert out.columns == docs.columns
        after = {r.doc_id: r.text for r in out.collect()}
        if name == "language":
            gone = set(before) - set(after)
            assert len(gone) <= 2 and all(after[d] == before[d] for d in after)
        elif name == "near_duplicates":
            assert set(after) == set(plain(list(before.items())).values())
        elif name == "repeated_passages":
            want = spans_removed(list(before.items()))
            assert set(after) == set(before)
            assert all(abs(len(after[d].encode()) - (n - cut)) <= 6 for d, (n, cut, _, _) in want.items())
        else:
            assert set(before) - set(after) == {d for d, t in before.items() if any(b in t for b in items)}
        docs = out


ROWS = [(1, "The cat sat on the mat and the dog ran off to see the bird in the tree. " * 9, "en", "a", 1),
        (2, None, None, None, None), (3, "", "en", "a", 0), (4, " \n\t -- ", "en", "b", 6),
        (5, " ".join(f"word{i % 97} other{i % 89}" for i in range(30_000)), "en", "a", 9),
        (6, "ties ties ties and more words here", "en", "a", 3), (6, "ties ties ties and more words here", "en", "a", 3),
        (None, "no id at all but a text", "en", "c", 2), (8, "émigré 🙂 " * 40, "fr", "a", 5)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["_id", "_repeats", "_repeats_of", "component_id", "item_id", "key", "node", "score", "repeats", "lang_pred"]


def test_stages_on_odd_rows_and_clashing_names(spark, small):
    docs = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", *[f"{i} AS {c}" for i, c in enumerate(CLASH)])
    want = {"language": [1, 5, 6, 6, 8, None], "near_duplicates": [1, 2, 4, 5, 6, 6, 8, None],
            "repeated_passages": [1, 2, 3, 4, 5, 6, 6, 8, None], "decontaminate": [1, 2, 3, 4, 5, 6, 6, 8, None]}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.schema.names == docs.columns
        rows = out.collect()
        ids = [r.doc_id for r in rows]
        assert sorted(ids, key=str) == sorted(want[name], key=str), (name, ids)
        assert all(r[c] == i for r in rows for i, c in enumerate(CLASH))
        nulls = spark.createDataFrame([(None,) * 5] * 3, SCHEMA)
        assert stage(spark, nulls, small).count() == (0 if name == "language" else 3)
        assert stage(spark, docs.limit(0), small).count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert sorted((r.doc_id for r in packed.select("doc_id", "piece").collect() if r.piece == 0), key=str) == \
        sorted((r[0] for r in ROWS), key=str)
