"""Document operators against brute force, held-out labels and awkward rows."""
import random
import zlib

import numpy as np
import pytest

from brute import components, fingerprint, spans_removed
from compare import check, duck
from tideline.llm import decontaminate, extendible_shards, html_text, language_mixture, packing, quality_rules, \
    rule_ensemble, severity, simhash, suffix_index
from tideline.llm.common import table
from tideline.llm.queries import llm

LONG = " ".join(f"word{i % 97} other{i % 89}" for i in range(30_000))
ROWS = [(1, "The cat sat on the mat and the dog ran off to see the bird in the tree. " * 4, "en", "a", 1),
        (2, None, "en", None, None), (3, "", None, "a", 0), (4, "   \n\t", "en", "b", 4), (5, LONG, "en", "a", 9),
        (6, "ties ties ties", "en", "a", 3), (6, "ties ties ties", "en", "a", 3), (None, "no id at all", None, "c", 2),
        (7, "<|endoftext|> émigré 🙂 " * 9, "fr", "a", 5)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    """Awkward documents, with columns named like those the operators add."""
    return spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "1 AS fp", "'x' AS kept", "2 AS _t", "3 AS score", "4 AS h")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(llm.checks))
def test_checked_query(spark, small, name):
    state, note, _ = check(spark, duck(small), small, name, llm.queries[name], llm.checks[name])
    assert state == "ok", note


def test_host_quality(spark, odd, none):
    got = {(r.doc_id, r.n_words): r for r in quality_rules.host_quality(odd).collect()}
    assert len(got) == 8 and got[2, 0].base_failed and not got[2, 0].kept
    assert quality_rules.host_quality(none).count() == 0
    text = "a b c x a b c " + " ".join(f"w{i}" for i in range(60)) + "\nline\nline\n \n \n"
    one = spark.createDataFrame([(1, text, "h")], "doc_id long, text string, source string")
    r = quality_rules.host_quality(one).first()
    assert (r.n_repeat_words, r.n_dup_lines, r.base_failed) == (6, 1, False)


def test_language(spark, odd, none, small):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = llm.queries["op2_language_mixture"](spark, "/root/testdata/sf0.01").join(
        docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.97 and got.score.between(0, 1).all()
    model = language_mixture.learn_from(docs)
    out = {r.doc_id: r for r in language_mixture.identify(odd, model).collect()}
    assert out[2].lang_pred == out[3].lang_pred == out[4].lang_pred == "und" and out[1].lang_pred != "und"
    assert language_mixture.identify(none, model).count() == 0
    assert language_mixture.identify(odd, language_mixture.learn_from(none)).filter("lang_pred <> 'und'").count() == 0
    a, b = (docs.filter(f"lang = '{g}' AND length(text) > 3000").first()["text"][:2500] for g in ("de", "es"))
    mixed = spark.createDataFrame([(1, a + "\n" + b)], "doc_id long, text string")
    shares = language_mixture.identify(mixed, model).first()["proportions"]
    assert shares["de"] > 0.25 and shares["es"] > 0.25


def test_near_duplicates(spark, odd, none, small):
    docs = table(spark, small, "documents")
    rows = docs.select("doc_id", "text").collect()
    marks = [(d, fingerprint(t)) for d, t in rows]
    want = components(marks)
    got = simhash.near_duplicates(docs).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {
        (d, f"{f:016x}", want[d]) for d, f in marks}
    out = simhash.near_duplicates(odd).collect()
    assert len(out) == len(ROWS) and {r.component_id for r in out if r.doc_id in (2, 3, 4)} == {2}
    assert simhash.near_duplicates(none).count() == 0


def test_anchor_covering(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)]
    near = [b ^ sum(1 << k for k in rng.sample(range(64), n)) for b in base for n in (1, 2, 3, 4)]
    fps = sorted(set(base + near))
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(fps)],
                                  "fp long, node long")
    links = simhash.anchor_links(nodes)
    got = {r.node: r.component for r in simhash.components(links).collect()}
    want = components(list(enumerate(fps)))
    assert {i: got.get(i, i) for i in want} == want


def test_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert {r.component for r in simhash.components(links).collect()} == {0}


def test_decontaminate(spark, odd, none, small):
    docs, items = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "benchmark")
    parts, one = (sorted(map(tuple, decontaminate.contaminated(docs, items, part_chars=n).collect()))
                  for n in (2000, decontaminate.PART_CHARS))
    whole = {(r[0], r[1]) for r in one}

    def norm(t):
        return " " + " ".join(decontaminate.words(t)) + " "
    texts = [(d, norm(t)) for d, t in docs.select("doc_id", "text").collect()]
    want = {(d, i) for i, b in items.collect() for d, t in texts if norm(b) in t}
    assert want and want <= whole and len(whole - want) <= 2
    assert [(*r[:2], round(r[2], 9), *r[3:]) for r in parts] == [(*r[:2], round(r[2], 9), *r[3:]) for r in one]
    assert decontaminate.contaminated(odd, items).count() == 0
    assert decontaminate.contaminated(none, items).count() == 0
    assert decontaminate.contaminated(docs, none.selectExpr("doc_id AS item_id", "text")).count() == 0


def test_skipping_loses_nothing(spark):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 12)))) for i in range(150)]
    index = decontaminate.ItemIndex(items)
    terms = decontaminate.Terms(index.term)
    ids = terms.ids(" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(500)))
    padded = np.r_[ids, np.full(2 * index.stride, -1, np.int32)]
    found = set(index.candidates(padded))
    for k in range(len(ids) // index.stride):
        have = set(padded[k * index.stride:(k + 2) * index.stride].tolist())
        for i, impact in enumerate(index.impact):
            if sum(x for t, x in impact.items() if t in have) >= index.threshold:
                assert (k, i) in found


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a < b) "</p>"</script></head><body>
<nav><a href="/">Home</a></nav><div class="ad">Buy <b>now</b></div><article><h1>Big &amp; bold</h1><p>One<b>two</b>
three<p class="advert">x<p>Four&nbsp;five &lt;six&gt;<br>seven<section class="comments"><article>rude</article></section>
<form><input name=q>Search</form><p>Last.</article><aside>side</aside><footer>&copy; foot</footer></body></html>"""


@pytest.mark.parametrize("page, text", [
    (PAGE, "Big & bold Onetwo three Four five <six> seven Last."), ("", ""), ("<p></p>", ""), ("<b", "<b"),
    ("<!-- never closed", ""), ("<script>x", ""), ("<nav>never closed <p>" + "some words " * 20, None)])
def test_main_text(page, text):
    got = html_text.main_text(page)
    assert got == text if text is not None else "some words" in got


def test_pages(spark, small):
    got = llm.queries["op5_line_block_text"](spark, small).collect()
    assert len(got) == table(spark, small, "pages").count() and all(r.n_chars == len(r.text) > 0 for r in got)
    odd_pages = spark.createDataFrame([(1, None, None), (None, "u", "")], "page_id long, url string, html string")
    assert [r.text for r in html_text.extract(odd_pages).collect()] == ["", ""]


def test_pieces_and_packing(spark, odd, none):
    from tokenizers import Tokenizer
    coder = Tokenizer.from_file(packing.tokenizer_file())
    got = packing.pack_documents(odd, capacity=64, documents=5).toPandas()
    want = []
    for i, t, *_ in ROWS:
        ids = np.array(coder.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        cuts = [0, *range(len(ids) - (len(ids) - 1) // 64 * 64, len(ids) + 1, 64)]
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = [tuple(None if x != x else int(x) for x in r) for r in got[cols].itertuples(index=False)]
    assert sorted(rows, key=str) == sorted(want, key=str)
    for _, x in got.sort_values("offset").groupby("sequence_id"):
        assert list(x.offset) == list(np.cumsum(x.length) - x.length) and x.length.sum() <= 64 and len(x) <= 5
    assert packing.pack_documents(none).count() == 0


def test_packing_by_all_three_residuals(spark):
    """Equal token room: the weights, not the tokens alone, choose the sequence, and the document limit binds."""
    n = np.array([60, 60, 40, 20, 20, 20, 10, 10, 10, 10] * 20)
    alone = packing.best_fit(n, 100)[0]
    seq = packing.best_fit(n, 100, documents=4, weights=packing.WEIGHTS)[0]
    assert np.bincount(alone).max() > 4 and np.bincount(seq).max() <= 4
    assert np.bincount(seq, weights=n).max() <= 100 and list(seq) != list(alone)
    docs = spark.range(300).selectExpr("id AS doc_id", "'x' AS text")
    got = packing.pack_documents(docs).groupBy("sequence_id").count().toPandas()["count"]
    assert got.sum() == 300 and got.max() == packing.DOCUMENTS


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_limits(rule):
    rng = np.random.default_rng(2)
    n = rng.integers(1, 100, 400)
    seq, off = packing.best_fit(n, 128, documents=4, attention=10_000, weights=(1, .5, .5), rule=rule)
    for s in np.unique(seq):
        own = n[seq == s]
        assert own.sum() <= 128 and len(own) <= 4 and (own ** 2).sum() <= 10_000
        assert sorted(off[seq == s]) == sorted(np.cumsum(own[np.argsort(off[seq == s])])
                                               - own[np.argsort(off[seq == s])])


def test_shards(spark, odd, none, small, tmp_path):
    docs = table(spark, small, "documents")
    got = extendible_shards.shard_documents(docs, limit=9000).toPandas()
    rows = {r.doc_id: (r.h, r.b) for r in docs.selectExpr("doc_id", "coalesce(octet_length(text), 0) AS b").withColumn(
        "h", extendible_shards.place()).collect()}

    def leaf(ids, depth):
        if sum(rows[i][1] for i in ids) <= 9000 or len(ids) == 1:
            return {i: depth for i in ids}
        halves = [[i for i in ids if rows[i][0] >> (59 - depth) & 1 == bit] for bit in (0, 1)]
        return {i: d for half in halves if half for i, d in leaf(half, depth + 1).items()}
    want = leaf(list(rows), 0)
    assert {r.doc_id: r.depth for r in got.itertuples()} == want
    assert all((s <= 9000) != o for s, o in zip(got.shard_bytes, got.oversized))
    assert extendible_shards.shard_documents(odd, limit=100).count() == len(ROWS)
    assert extendible_shards.shard_documents(none).count() == 0
    clash = docs.selectExpr("*", "1 AS _d", "2 AS shard_of", "'x' AS depth", "3 AS prefix")
    extendible_shards.write_shards(clash, str(tmp_path / "s"), limit=200_000)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == len(rows) and {"_d", "shard_of", "depth", "prefix", "shard"} <= set(back.columns)


def test_one_large_document_among_many_shards(spark):
    """Documents of one size fill many shards at one depth; one above the limit lies far deeper."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('x', if(id = 7, 5000, 100)) AS text")
    got = extendible_shards.shard_documents(docs, limit=1600).collect()
    deep = {r.doc_id: r.depth for r in got}
    assert len(got) == 3000 and max(deep.values()) == deep[7] and [r.doc_id for r in got if r.oversized] == [7]
    sizes = {}
    for r in got:
        sizes.setdefault(r.shard, [0, r.shard_bytes])[0] += r.n_bytes
    assert all(a == b for a, b in sizes.values())


def test_repeats(spark, odd, none, small):
    rng = random.Random(4)
    docs = table(spark, small, "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    passage = rows[0][1][:130]
    rows += [(1000 + i, rows[i % 50][1][:rng.randint(50, 400)] + passage[rng.randint(0, 31):] + "ab" * rng.randint(0, 150)
              + rows[(i * 7) % 50][1][-rng.randint(90, 110):]) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r[0]: tuple(r)[1:] for r in suffix_index.remove_repeats(df).collect()}
    assert got == spans_removed(rows)
    out = suffix_index.remove_repeats(odd).collect()
    assert len(out) == len(ROWS) and {r.n_removed for r in out if r.doc_id in (1, 2, 3, 4, 6, None)} >= {0}
    want = spans_removed([(i, t) for i, t, *_ in ROWS if i is not None])
    assert {r.doc_id: tuple(r)[1:5] for r in out if r.doc_id is not None} == want
    assert suffix_index.remove_repeats(none).count() == 0


def test_family_levels():
    """Batches through the family settle as one pass over all rows does."""
    rng = np.random.default_rng(1)
    n = 4000
    key, seg = rng.integers(0, 300, n).astype(np.uint64), rng.integers(0, 3, n).astype(np.uint64)
    doc, v = np.arange(n), np.arange(n)
    family, covered = suffix_index.Family(), []
    for a in range(0, n, 170):
        part = slice(a, a + 170)
        covered.append(family.add(key[part], seg[part], doc[part], v[part])[0])
    seen, want = set(), []
    for x in zip(key.tolist(), seg.tolist()):
        want.append(x in seen)
        seen.add(x)
    assert np.concatenate(covered).tolist() == want
    sizes = [len(x[0]) for x in family.levels]
    assert sum(sizes) == len(seen) and all(a > 2 * b for a, b in zip(sizes, sizes[1:]))


def test_quality(spark, odd, none):
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = rule_ensemble.learn_from(docs, labels)
    assert model.rules
    got = rule_ensemble.quality(docs, model).join(labels, "doc_id").filter("pmod(crc32(CAST(doc_id AS STRING)), 3) = 1").toPandas()
    assert (got.predicted == got.quality).mean() > 0.95
    out = rule_ensemble.quality(odd, model).collect()
    assert len(out) == len(ROWS) and all(0 <= r.score <= 1 for r in out)
    assert rule_ensemble.quality(none, model).count() == 0
    bare = rule_ensemble.learn_from(docs, labels.filter("quality = 1"))
    assert not bare.rules and rule_ensemble.quality(odd, bare).first()["predicted"] == 1


def test_severity(spark, odd, none):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = severity.learn_from(docs, labels, sample=4000)
    got = severity.toxicity(docs, model).withColumnRenamed("toxic", "said").join(labels, "doc_id").filter(
        "pmod(crc32(CAST(doc_id AS STRING)), 3) = 1").toPandas()
    assert got.said[got.toxic == 1].mean() > 0.85 and got.said[got.toxic == 0].mean() < 0.01
    assert got.expected_severity[got.toxic == 1].mean() > 1 > got.expected_severity[got.toxic == 0].mean()
    out = {r.doc_id: r for r in severity.toxicity(odd, model).collect()}
    assert out[2].toxic == 0 and len(model.cuts) == 2 and model.cuts[0] < model.cuts[1]
    assert severity.toxicity(none, model).count() == 0
    assert severity.toxicity(odd, severity.learn([])).filter("expected_severity <> 0").count() == 0
