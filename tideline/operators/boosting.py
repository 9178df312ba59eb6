"""Boosted trees by second-order gains, grown from histograms.

Every feature is cut into bins at its quantiles once. A round's tree grows level
by level: each task adds up gradients and hessians per node, feature and bin,
Spark sums these arrays, and the driver, which sees one array of a size that
does not depend on the rows, chooses the splits. Several models on parts of the
same rows (the folds of a cross-fit) grow side by side in the same jobs.

A node's score is T(G)^2 / (H + l2), with T(G) the gradient sum moved towards
zero by l1. A split needs ``min_weight`` hessian on both sides and a gain above
zero; splits whose gain is below ``gamma`` and whose children are leaves are
then taken back, bottom up. A tree sees a seeded share of the columns and a
hash-drawn share of the rows. Values up to the threshold go left.

Margins are written every ``EVERY`` rounds, so a task never evaluates more
trees than that and a lost executor costs a re-read.

Growing over all rows costs a job for every level of every round. A learner with
``fit_rows`` grows instead on about that many rows, drawn by a hash, inside one
task for each model; models run next to each other. Both ways use the same
splits, and scoring always sees all rows.
"""
from __future__ import annotations

import json
import random
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline import settings as S
from tideline.session import cut_lineage

EVERY = 64
FIT_ROWS = 100_000         # labelled rows a model is fitted on, about; None: all rows, a job for each level
MIN_GAIN = 1e-6
MAX_MEMBERS = 62           # models that grow side by side; a row's models are bits of a long


@dataclass
class Tree:
    """Nodes in order of their number; a leaf has feature -1, and ``value`` counts for leaves only."""
    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)     # hessian sum
    gain: list[float] = field(default_factory=list)

    def add(self, value: float, cover: float) -> int:
        for part, x in zip((self.feature, self.threshold, self.left, self.right, self.value, self.cover, self.gain),
                           (-1, 0.0, -1, -1, value, cover, 0.0)):
            part.append(x)
        return len(self.feature) - 1

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row of ``x``."""
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        left, right = np.array(self.left), np.array(self.right)
        at = np.zeros(len(x), np.int64)
        inner = np.flatnonzero(feature[at] >= 0)
        while len(inner):
            node = at[inner]
            at[inner] = np.where(x[inner, feature[node]] <= threshold[node], left[node], right[node])
            inner = inner[feature[at[inner]] >= 0]
        return at

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves(x)]


def matrix(column) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths as one array."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


@dataclass
class BoostedTrees:
    """A fitted model: log-odds are ``base`` plus the leaves of all trees."""
    trees: list[Tree]
    features: int
    base: float = 0.0

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += tree.margin(x)
        return out

    def score(self, df: DataFrame, out: str = "risk_score") -> DataFrame:
        """``df`` with the probability of label 1; needs the vector column ``features``."""
        from pyspark.ml.functions import vector_to_array

        @F.pandas_udf("double")
        def probability(x: pd.Series) -> pd.Series:
            return pd.Series(1 / (1 + np.exp(-self.margins(np.stack(x.to_list())))) if len(x) else [], dtype=float)
        return df.withColumn(out, probability(vector_to_array("features")))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """One row per node: tree, node, feature (-1: leaf), threshold, left, right, value, cover, gain."""
        rows = [(t, n, *x) for t, tree in enumerate(self.trees) for n, x in enumerate(zip(
            tree.feature, tree.threshold, tree.left, tree.right, tree.value, tree.cover, tree.gain))]
        return spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, left int, right int, "
                                           "value double, cover double, gain double")

    def save(self, spark: SparkSession, path: str) -> None:
        doc = {"features": self.features, "base": self.base, "trees": [asdict(t) for t in self.trees]}
        spark.createDataFrame([(json.dumps(doc),)], "value string").write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BoostedTrees":
        doc = json.loads(spark.read.text(path).first()[0])
        return cls([Tree(**t) for t in doc["trees"]], doc["features"], doc["base"])


@dataclass
class Boosting:
    """Settings of the learner; defaults are those of the production model."""
    rounds: int = S.MODEL_ROUNDS
    step: float = S.MODEL_STEP
    depth: int = S.MODEL_DEPTH
    min_weight: float = S.MODEL_MIN_ROWS
    row_share: float = S.MODEL_ROW_SHARE
    column_share: float = float(S.MODEL_COLUMN_SHARE)
    l1: float = S.MODEL_L1
    l2: float = S.MODEL_L2
    gamma: float = S.MODEL_GAMMA
    bins: int = 64
    seed: int = S.MODEL_SEED
    label: str = S.TARGET
    weight: str | None = "weight"
    fit_rows: int | None = FIT_ROWS

    def fit(self, df: DataFrame) -> BoostedTrees:
        """A model on the rows of ``df`` (vector ``features``, label, weight)."""
        return self.fit_members(df, [F.lit(True)])[0]

    def fit_members(self, df: DataFrame, members: list) -> list[BoostedTrees]:
        """A model per condition in ``members``, on the rows where it holds."""
        from pyspark.ml.functions import vector_to_array
        if not 0 < len(members) <= MAX_MEMBERS:
            raise ValueError(f"1 to {MAX_MEMBERS} models grow side by side")
        use = sum((F.when(m, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, m in enumerate(members)), F.lit(0))
        weight = F.col(self.weight).cast("double") if self.weight else F.lit(1.0)
        rows = cut_lineage(df.select(vector_to_array("features").alias("x"), F.col(self.label).cast("double").alias("y"),
                                     weight.alias("w"), use.alias("use"), F.monotonically_increasing_id().alias("row")))
        first = rows.first()
        if first is None:
            raise ValueError("no rows to learn from")
        n = len(first["x"])
        if self.fit_rows is not None:
            return self._fit_in_tasks(rows, len(members), n)
        cuts = self._cuts(rows, n)
        rows = rows.withColumn("m", F.array_repeat(F.lit(0.0), len(members)))
        models = [BoostedTrees([], n) for _ in members]
        since = 0
        for turn in range(self.rounds):
            for model in models:
                model.trees.append(Tree())
            shown = [self._shown(n, k, turn) for k in range(len(models))]
            self._grow(rows, models, since, turn, cuts, shown)
            if turn + 1 - since == EVERY and turn + 1 < self.rounds:
                rows, since = cut_lineage(_with_margins(rows, models, since)), turn + 1
        return models

    def _fit_in_tasks(self, rows: DataFrame, members: int, n: int) -> list[BoostedTrees]:
        """A task per model, each on about ``fit_rows`` of its rows."""
        sizes = rows.agg(*[F.sum(F.shiftright("use", k).bitwiseAND(F.lit(1))) for k in range(members)]).first()
        share = F.element_at(F.array(*[F.lit(self.fit_rows / max(1, s or 0)) for s in sizes]), F.col("k") + 1)
        drawn = F.pmod(F.xxhash64("row", F.lit(self.seed)), F.lit(1 << 30)) < share * (1 << 30)
        every = F.explode(F.expr(f"filter(sequence(0, {members - 1}), i -> (shiftright(use, i) & 1) = 1)"))
        some = rows.select("x", "y", "w", "row", every.alias("k")).filter(drawn)

        def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("row")
            trees = self._fit_rows(np.stack(part["x"].to_list()), part["y"].to_numpy(), part["w"].to_numpy(),
                                   part["row"].to_numpy(), int(key[0]))
            return pd.DataFrame({"k": [int(key[0])], "trees": [json.dumps([asdict(t) for t in trees])]})
        found = {r["k"]: r["trees"] for r in some.groupBy("k").applyInPandas(run, "k int, trees string").collect()}
        return [BoostedTrees([Tree(**t) for t in json.loads(found.get(k, "[]"))], n) for k in range(members)]

    def _fit_rows(self, x, y, w, row, member: int) -> list[Tree]:
        """All rounds on rows in memory."""
        n = x.shape[1]
        shares = (np.arange(self.bins) + 1) / self.bins
        cuts = [np.unique(np.quantile(x[:, i], shares, method="inverted_cdf"))[:-1] for i in range(n)]
        width = max(map(len, cuts)) + 1
        bins = np.stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(cuts)], axis=1)
        margin, trees = np.zeros(len(y)), []
        for turn in range(self.rounds):
            tree, shown = Tree(), self._shown(n, member, turn)
            own = np.flatnonzero(_draw(row, self.seed, turn) < self.row_share)
            p = 1 / (1 + np.exp(-margin))
            g, h = (w * (p - y))[own], (w * p * (1 - p))[own]
            slot = bins[own][:, shown] + np.arange(len(shown)) * width
            front = [(tree.add(0.0, float(h.sum())), np.arange(len(own)))]
            tree.value[0] = self._leaf(g.sum(), h.sum())
            for _ in range(self.depth):
                opened = []
                for node, some in front:
                    part = np.zeros((n, width, 2))
                    flat = slot[some].ravel()
                    for j, v in enumerate((g, h)):
                        part[shown, :, j] = np.bincount(flat, np.repeat(v[some], len(shown)),
                                                        len(shown) * width).reshape(-1, width)
                    best = self._split(part, cuts, shown)
                    if best is None:
                        continue
                    left = bins[own[some], best[1]] <= best[2]
                    opened += zip(self._branch(tree, node, best, cuts), (some[left], some[~left]))
                front = opened
            self._prune(tree)
            margin += tree.margin(x)
            trees.append(tree)
        return trees

    def _shown(self, n: int, member: int, turn: int) -> list[int]:
        """The columns that a tree may split on."""
        return sorted(random.Random(f"{self.seed}:{member}:{turn}").sample(range(n), max(1, int(self.column_share * n))))

    def _branch(self, tree: Tree, node: int, best, cuts) -> tuple[int, int]:
        gain, feature, cut, low, high = best
        tree.feature[node], tree.threshold[node], tree.gain[node] = feature, float(cuts[feature][cut]), gain
        tree.left[node] = tree.add(self._leaf(*low), float(low[1]))
        tree.right[node] = tree.add(self._leaf(*high), float(high[1]))
        return tree.left[node], tree.right[node]

    def _cuts(self, rows: DataFrame, n: int) -> list[np.ndarray]:
        """Thresholds of each feature: its quantiles, without the greatest."""
        wide = rows.select(*[F.col("x")[i].alias(f"f{i}") for i in range(n)])
        shares = [(i + 1) / self.bins for i in range(self.bins)]
        found = wide.approxQuantile([f"f{i}" for i in range(n)], shares, 0.2 / self.bins)
        return [np.unique(q)[:-1] for q in found]

    def _grow(self, rows, models, since, turn, cuts, shown) -> None:
        """Fill the last tree of every model, a level a job."""
        front = [[0] for _ in models]                # open nodes of the level
        for model in models:
            model.trees[-1].add(0.0, 0.0)
        for level in range(self.depth):
            sums = self._sums(rows, models, since, turn, cuts, front)
            at = 0
            for k, model in enumerate(models):
                tree, new = model.trees[-1], []
                for node in front[k]:
                    part = sums[at]
                    at += 1
                    if level == 0:
                        g, h = part[0].sum(axis=0)
                        tree.cover[0], tree.value[0] = float(h), self._leaf(g, h)
                    best = self._split(part, cuts, shown[k])
                    if best is None:
                        continue
                    new += self._branch(tree, node, best, cuts)
                front[k] = new
            if not any(front):
                break
        for model in models:
            self._prune(model.trees[-1])

    def _sums(self, rows, models, since, turn, cuts, front) -> list[np.ndarray]:
        """(features, bins, [G, H]) of every open node, model after model."""
        width = max(len(c) for c in cuts) + 1
        n, share, seed = len(cuts), self.row_share, self.seed
        size = sum(map(len, front)) * n * width * 2
        trees = [[*m.trees[since:]] for m in models]

        def run(batches):
            total = np.zeros((sum(map(len, front)), n, width, 2))
            for batch in batches:
                x, m = matrix(batch.column(0)), matrix(batch.column(5))
                y, w, use, row = (batch.column(i).to_numpy() for i in range(1, 5))
                if not len(y):
                    continue
                bins = np.stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(cuts)], axis=1)
                drawn = _draw(row, seed, turn) < share
                at = 0
                for k, grown in enumerate(trees):
                    margin = m[:, k].copy()
                    for tree in grown[:-1]:
                        margin += tree.margin(x)
                    p = 1 / (1 + np.exp(-margin))
                    g, h = w * (p - y), w * p * (1 - p)
                    own = drawn & ((use >> k) & 1 == 1)
                    leaf = grown[-1].leaves(x)
                    for node in front[k]:
                        some = np.flatnonzero(own & (leaf == node))
                        slot = (bins[some] + np.arange(n) * width).ravel()
                        for j, v in enumerate((g, h)):
                            total[at, :, :, j] += np.bincount(slot, np.repeat(v[some], n), n * width).reshape(n, width)
                        at += 1
            import pyarrow as pa
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["v"])

        from pyspark.ml.functions import array_to_vector
        from pyspark.ml.stat import Summarizer
        parts = rows.select("x", "y", "w", "use", "row", "m").mapInArrow(run, "v array<double>")
        total = parts.select(Summarizer.sum(array_to_vector("v")).alias("v")).first()["v"].toArray()
        return list(total.reshape(size // (n * width * 2), n, width, 2))

    def _leaf(self, g: float, h: float) -> float:
        return float(-self.step * _towards_zero(g, self.l1) / (h + self.l2)) if h + self.l2 > 0 else 0.0

    def _split(self, part: np.ndarray, cuts, shown):
        """(gain, feature, cut, (G, H) left, (G, H) right) of the best allowed split; ties to the first."""
        upto = np.cumsum(part, axis=1)
        total = upto[:, -1:, :]
        low, high = upto[:, :-1, :], total - upto[:, :-1, :]

        def value(x):
            h = x[..., 1] + self.l2
            return np.divide(_towards_zero(x[..., 0], self.l1) ** 2, h, out=np.zeros_like(h), where=h > 0)
        gain = value(low) + value(high) - value(total)
        places = np.arange(gain.shape[1])[None, :] < np.array([len(c) for c in cuts])[:, None]
        allowed = places & (low[..., 1] >= self.min_weight) & (high[..., 1] >= self.min_weight)
        hidden = np.ones(len(cuts), bool)
        hidden[shown] = False
        gain[~allowed | hidden[:, None]] = -np.inf
        if not gain.size:
            return None
        feature, cut = np.unravel_index(np.argmax(gain), gain.shape)
        if not gain[feature, cut] > MIN_GAIN:
            return None
        return float(gain[feature, cut]), int(feature), int(cut), tuple(low[feature, cut]), tuple(high[feature, cut])

    def _prune(self, tree: Tree) -> None:
        """Take back splits into two leaves whose gain is below gamma, children before parents."""
        for node in reversed(range(len(tree.feature))):
            if tree.feature[node] < 0 or tree.gain[node] >= self.gamma:
                continue
            if tree.feature[tree.left[node]] < 0 and tree.feature[tree.right[node]] < 0:
                tree.feature[node], tree.left[node], tree.right[node], tree.gain[node] = -1, -1, -1, 0.0


def _towards_zero(g, by):
    return np.sign(g) * np.maximum(np.abs(g) - by, 0.0)


def _draw(row: np.ndarray, seed: int, turn: int) -> np.ndarray:
    """A number in [0, 1) for each row and round."""
    with np.errstate(over="ignore"):
        x = row.astype(np.uint64) + np.uint64((seed * 1_000_003 + turn) & 0xFFFFFFFF) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / float(1 << 53)


def _with_margins(rows: DataFrame, models: list[BoostedTrees], since: int) -> DataFrame:
    """``rows`` with the margins of all trees so far."""
    import pyarrow as pa
    new = [m.trees[since:] for m in models]
    at = rows.columns.index("m")

    def run(batches):
        for batch in batches:
            x, m = matrix(batch.column(0)), matrix(batch.column(at)).copy()
            for k, trees in enumerate(new):
                for tree in trees:
                    m[:, k] += tree.margin(x)
            columns = batch.columns
            columns[at] = pa.array(list(m), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
    return rows.mapInArrow(lambda batches: run(b for b in batches if b.num_rows), rows.schema)
