"""Quality score by a sparse ensemble of rules over text statistics.

Statistics are column expressions on the whole text. A random forest of shallow
trees, grown by Spark ML on a bounded sample of labelled rows, supplies rules:
each path from a root is a conjunction of conditions on statistics. A logistic
regression with a lasso penalty weighs them, most weights become zero, and the
rest are compiled to one column expression that scores any number of texts
without Python.

Defined cases: null and empty texts have zero statistics and a score like any
other; labels that are null are not learned from; with one class only, or none,
the score is the smoothed share of label 1; several labels of a document count
as several rows; an empty table gives no rows; repeated rows return as often as
they come; further columns are ignored.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tideline.llm.common import SPACES, held_out, whole
from tideline.session import cut_lineage

SAMPLE = 20_000            # expected labelled rows to learn from
TREES, DEPTH = 24, 3
LASSO = 0.001


def statistics(text: str = "text") -> dict[str, Column]:
    """Name -> column over ``_t`` (whole text) and ``_w`` (its words), all finite."""
    n = F.length("_t")
    words = F.size("_w")

    def per(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0)).cast("double")

    def count(pattern: str) -> Column:
        return F.length(F.regexp_replace("_t", pattern, ""))

    capitals, letters = count(r"[^\p{Lu}]+"), count(r"[^\p{L}]+")
    return {
        "n_chars": n.cast("double"),
        "n_words": words.cast("double"),
        "chars_per_word": per(letters, words),
        "letters": per(letters, n),
        "capitals": per(capitals, letters),
        "digits": per(count(r"[^0-9]+"), n),
        "symbols": per(count(r"[^#*$%&|<>]+"), words),
        "shouts": per(count(r"[^!]+"), words),
        "stops": per(count(r"[^.]+"), words),
        "lines": per(count(r"[^\n]+"), words),
        "distinct_words": per(F.size(F.array_distinct("_w")), words),
        "top_run": per(F.expr("size(filter(_w, (x, i) -> x = get(_w, i - 1)))"), words),
    }


def with_statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and one column per statistic."""
    x = docs.select(*keep, whole(text).alias("_t"))
    x = x.select(*keep, "_t", F.array_remove(F.split("_t", f"{SPACES}+"), "").alias("_w"))
    return x.select(*keep, *[c.alias(name) for name, c in statistics().items()])


@dataclass(frozen=True)
class Rule:
    """All of (statistic, above or not, cut)."""
    conditions: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, above, at in self.conditions:
            out = out & (F.col(name) > at if above else F.col(name) <= at)
        return out


@dataclass(frozen=True)
class Ensemble:
    """Score = logistic(intercept + sum of the weights of the rules that hold)."""
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


_NODE = re.compile(r"^(\s*)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)")


def tree_rules(tree: str, names: list[str]) -> set[Rule]:
    """Every path of a printed tree, inner nodes included."""
    out, path = set(), []
    for line in tree.splitlines():
        m = _NODE.match(line)
        if not m:
            continue
        indent = len(m[1])
        path = [p for p in path if p[0] < indent] + [(indent, (names[int(m[2])], m[3] == ">", float(m[4])))]
        out.add(Rule(tuple(sorted(set(c for _, c in path)))))
    return out


def learn(rows: DataFrame, sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH,
          lasso: float = LASSO) -> Ensemble:
    """Ensemble from ``rows`` (id, text, label 0 or 1); about ``sample`` rows, chosen by a hash of the id, are used."""
    import math

    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = rows.filter("label IN (0, 1)")
    total = rows.count()
    share = min(1.0, sample / total) if total else 1.0
    some = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share * 1_000_000)
    names = list(statistics())
    known = cut_lineage(with_statistics(some, ["label"]).withColumn("label", F.col("label").cast("double")))
    sizes = {int(r["label"]): r["count"] for r in known.groupBy("label").count().collect()}
    if len(sizes) < 2:
        ones, n = sizes.get(1, 0), sum(sizes.values())
        return Ensemble(math.log((ones + 1) / (n - ones + 1)), ())
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, featuresCol="x").fit(
        VectorAssembler(inputCols=names, outputCol="x").transform(known))
    rules = sorted({r for t in forest.trees for r in tree_rules(t.toDebugString, names)},
                   key=lambda r: r.conditions)
    held = known.select("label", *[r.column().cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    fitted = LogisticRegression(featuresCol="x", elasticNetParam=1.0, regParam=lasso, maxIter=60).fit(
        VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="x").transform(held))
    weights = fitted.coefficients.toArray()
    return Ensemble(float(fitted.intercept),
                    tuple((r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-6))


def learn_from(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
               label: str = "quality", sample: int = SAMPLE) -> Ensemble:
    """``learn`` on the labelled documents that are not held out."""
    marked = labels.filter(~held_out(doc_id)).select(F.col(doc_id).alias("id"), F.col(label).alias("label"))
    return learn(marked.join(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")), "id"), sample)


def quality(docs: DataFrame, model: Ensemble, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score and predicted (1 if score >= 0.5) of every document."""
    x = with_statistics(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), ["doc_id"])
    return (x.select("doc_id", model.score().alias("score"))
             .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
