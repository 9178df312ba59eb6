"""Exact nearest neighbours as a join of point blocks.

Equal vectors are one node, which keeps its smallest ids: a group of copies costs
what one point costs. Nodes are put in the cell of their nearest pivot, and
neighbouring cells form blocks. A block is first compared with itself, which
bounds the distances its rows still look for; then pairs of blocks meet, both
directions at once, unless the triangle inequality says that no cell of the one
can hold anything nearer for a row of the other. So vectors are sent out once
for each pair of blocks and never once for each row and cell, and no list of all
pairs is written.

Two blocks are compared by one single-precision product that gives half of each
squared distance less more than its rounding error. What it lets through is
settled by differences in double precision, so the product only spares work.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tideline.session import cut_lineage

MAX_PIVOTS = 1024       # bound of what the driver and each task hold besides two blocks
BLOCK_VALUES = 1 << 22  # numbers in a block
BLOCKS, LEAST = 8, 1024  # blocks that a table is cut in if they keep so many rows
ROWS, COLUMNS = 1024, 2048  # of one product
HELD = 1 << 21          # pairs kept before they are cut to the best
_PART = 1 << 14         # pairs settled at once
_BUCKETS = 64           # a large group of copies is cut to its smallest ids in so many parts first


def _rough(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances by a product, off by less than ``_off``."""
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def _off(a: np.ndarray, b: np.ndarray) -> float:
    return 1e-6 * math.sqrt(max((a * a).sum(axis=1).max(initial=0), (b * b).sum(axis=1).max(initial=0)))


def _matrix(column) -> np.ndarray:
    """The rows of an Arrow column of equally long lists."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if len(pc.unique(pc.list_value_length(flat))) > 1:
        raise ValueError("the vectors differ in length")
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


class _Screen:
    """Pairs of rows of ``a`` and ``b`` that may be as near as the limits of either side."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.scale = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) or 1.0
        a, b = a / self.scale, b / self.scale
        centre = b.mean(axis=0)
        a, b = a - centre, b - centre
        self.slack = (a.shape[1] + 16) * 2.0 ** -23      # twice the rounding of the product, relative to both squares
        self.least = a.shape[1] * 1e-22                  # and that of the shift by the centre
        sa, sb = ((x * x).sum(axis=1, keepdims=True) * (0.5 - self.slack) for x in (a, b))
        self.a = np.hstack([a, np.ones_like(sa), sa]).astype(np.float32)
        self.b = np.hstack([-b, sb, np.ones_like(sb)]).astype(np.float32)

    def limit(self, distance: np.ndarray) -> np.ndarray:
        """Of half the squares; a negative distance lets nothing through."""
        half = (distance / self.scale) ** 2 / 2 * (1 + 2 * self.slack) + self.least
        return np.where(distance < 0, -np.inf, half).astype(np.float32)

    def reached(self, want: int) -> np.ndarray:
        """For each row of ``a`` a distance within which ``want`` rows of ``b`` and the row itself lie."""
        some = self.b[np.linspace(0, len(self.b) - 1, min(len(self.b), 2 * COLUMNS)).astype(int)]
        if len(some) <= want:
            return np.full(len(self.a), np.inf)
        out = np.empty(len(self.a))
        most = float(some[:, -2].max())
        for i in range(0, len(self.a), ROWS):
            x = self.a[i:i + ROWS]
            half = np.partition(x @ some.T, want, axis=1)[:, want].astype(float)
            half = np.maximum(half, 0) + 8 * self.slack * (x[:, -1] + most) + self.least
            out[i:i + ROWS] = np.sqrt(2 * half) * self.scale * (1 + 1e-6)
        return out


class _Best:
    """The ``want`` nearest rows of ``y`` within ``limit`` for each row of ``x``; of equally near ones the first by ``turn``."""

    def __init__(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray, turn: np.ndarray, want: int):
        self.x, self.y, self.limit, self.turn, self.want = x, y, limit, turn, want
        self.held = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        self.size = 0

    def add(self, i: np.ndarray, j: np.ndarray) -> bool:
        """Whether the limits have changed."""
        for at in range(0, len(i), _PART):
            r, c = i[at:at + _PART], j[at:at + _PART]
            gap = self.x[r] - self.y[c]
            d = np.sqrt((gap * gap).sum(axis=1))
            near = (d <= self.limit[r]) & (d < np.inf)
            self.held.append((r[near], c[near], d[near]))
            self.size += int(near.sum())
            if self.size > HELD:
                self.cut()
        if len(i) > _PART:
            self.cut()
            return True
        return False

    def cut(self):
        i, j, d = (np.concatenate(v) for v in zip(*self.held))
        order = np.lexsort((self.turn[j], d, i))
        i, j, d = i[order], j[order], d[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        last = place == self.want - 1
        self.limit[i[last]] = d[last]
        keep = place < self.want
        self.held, self.size = [(i[keep], j[keep], d[keep])], 0
        return self.held[0]


def _meet(x: np.ndarray, y: np.ndarray, ask_x: np.ndarray, ask_y: np.ndarray, is_x: np.ndarray, is_y: np.ndarray,
          turn_x: np.ndarray, turn_y: np.ndarray, want: int, screen: _Screen | None = None) -> tuple:
    """The best of each side for the other; ``ask`` limits the distances of rows that look for points (negative:
    none), ``is`` marks the rows that are points, ``turn`` orders those that are equally near."""
    screen = screen or _Screen(x, y)
    for_x, for_y = _Best(x, y, ask_x, turn_y, want), _Best(y, x, ask_y, turn_x, want)
    low_x, low_y = screen.limit(ask_x), screen.limit(ask_y)
    for i in range(0, len(x), ROWS):
        r = slice(i, i + ROWS)
        for j in range(0, len(y), COLUMNS):
            c = slice(j, j + COLUMNS)
            there = (ask_x[r] >= 0).any() and is_y[c].any()
            back = (ask_y[c] >= 0).any() and is_x[r].any()
            if not there and not back:
                continue
            half = screen.a[r] @ screen.b[c].T
            if there:
                at, to = np.divmod(np.flatnonzero(half <= low_x[r, None]), half.shape[1])
                at, to = at + i, to + j
                point = is_y[to]
                if for_x.add(at[point], to[point]):
                    low_x = screen.limit(ask_x)
            if back:
                at, to = np.divmod(np.flatnonzero(half <= low_y[None, c]), half.shape[1])
                at, to = at + i, to + j
                point = is_x[at]
                if for_y.add(to[point], at[point]):
                    low_y = screen.limit(ask_y)
    return for_x.cut(), for_y.cut()


def _chain(centre: np.ndarray) -> list[int]:
    """The pivots in an order in which each is followed by the nearest one left."""
    left, order = list(range(1, len(centre))), [0]
    while left:
        at = int(_rough(centre[order[-1:]], centre[left]).argmin())
        order.append(left.pop(at))
    return order


def _placeable(df: DataFrame) -> DataFrame:
    vec = F.coalesce(F.col("vec").cast("array<double>"), F.raise_error(F.lit("a vector is null")).cast("array<double>"))
    return df.select("id", vec.alias("vec")).filter(F.forall("vec", lambda v: F.abs(v) < float("inf")))


def _nodes(queries: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """node, vec, ids (the k + 1 smallest of its points, with how often they come, at most k), asks, holds."""
    def few(x, n):
        return F.slice(F.sort_array(x), 1, n)

    tagged = points.select("id", "vec", F.lit(queries is points).alias("asks"), F.lit(True).alias("holds"))
    if queries is not points:
        tagged = tagged.unionByName(queries.select("id", "vec", F.lit(True).alias("asks"), F.lit(False).alias("holds")))
    each = tagged.groupBy("vec", F.pmod(F.xxhash64("id"), F.lit(_BUCKETS)).alias("b"), "id").agg(
        F.count_if("holds").alias("n"), F.max("asks").alias("asks"))
    each = each.withColumn("one", F.when(F.col("n") > 0, F.struct("id", F.least("n", F.lit(k)).cast("int").alias("n"))))
    part = each.groupBy("vec", "b").agg(few(F.collect_list("one"), k + 1).alias("ids"), F.max("asks").alias("asks"))
    return (part.groupBy("vec").agg(few(F.flatten(F.collect_list("ids")), k + 1).alias("ids"), F.max("asks").alias("asks"))
            .select(F.monotonically_increasing_id().alias("node"), "vec", "ids", "asks", (F.size("ids") > 0).alias("holds")))


def _blocks(counts: dict[int, int], order: list[int], chunk: int) -> tuple[dict[int, tuple[int, int]], list[list[int]]]:
    """cell -> (first block, number of blocks), and the cells of each block."""
    of, cells, room = {}, [], 0
    for c in (c for c in order if c in counts):
        n = counts[c]
        if n > chunk:
            parts = -(-n // chunk)
            of[c], room = (len(cells), parts), 0
            cells += [[c] for _ in range(parts)]
        elif cells and n <= room:
            of[c] = (len(cells) - 1, 1)
            cells[-1].append(c)
            room -= n
        else:
            of[c], room = (len(cells), 1), chunk - n
            cells.append([c])
    return of, cells


def nearest(queries: DataFrame, points: DataFrame, k: int, chunk: int | None = None,
            pivots: int | None = None) -> DataFrame:
    """(id, neighbour, distance, place) with place 1..k; a point is not its own neighbour.

    The number of pivots follows the square root of the number of points; a
    block has at most about ``chunk`` rows.

    Both frames have ``id`` (string or bigint) and ``vec`` (array<double>).
    Equal distances are ordered by neighbour id. A vector that is null is an error; a row
    whose vector holds a null, NaN or infinity has no distances and is left out.
    The result is written once.
    """
    same = queries is points
    points = cut_lineage(_placeable(points))
    queries = points if same else cut_lineage(_placeable(queries))
    nodes = cut_lineage(_nodes(queries, points, k))
    chosen = nodes.filter("holds").select("vec").orderBy(F.xxhash64("vec")).limit(pivots or MAX_PIVOTS).collect()
    if not chosen:
        raise ValueError("there are no points to search")
    total = nodes.count()
    centre = np.array([r["vec"] for r in chosen[:pivots or max(16, math.isqrt(total))]], dtype="float64")
    # an id with several vectors is no neighbour of its own, so a node may find so many others that do not count
    own = nodes.select(F.explode("ids.id").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    want = k + own - 1
    chunk = chunk or max(1, min(BLOCK_VALUES // max(1, centre.shape[1]), max(LEAST, -(-total // BLOCKS))))

    def to_cells(batches):
        for batch in batches:
            x = _matrix(batch.column("vec"))
            for at in range(0, len(x), ROWS):
                d = _rough(x[at:at + ROWS], centre)
                best = d.argmin(axis=1)
                part = batch.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(best.astype("int32")), pa.array(d[np.arange(len(d)), best])],
                    names=[*part.schema.names, "cell", "away"])

    kind = dict(points.dtypes)["id"]
    slim = nodes.select("node", "vec", "asks", "holds", F.get("ids", F.lit(0))["id"].alias("low"))
    placed = cut_lineage(slim.mapInArrow(
        to_cells, f"node long, vec array<double>, asks boolean, holds boolean, low {kind}, cell int, away double"))
    facts = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect()  # one a pivot
    of, cells = _blocks({r["cell"]: r["n"] for r in facts}, _chain(centre), chunk)
    radius = np.zeros(len(centre))
    for r in facts:
        radius[r["cell"]] = r["radius"]

    def per_key(values):  # one entry per pivot or block
        return F.create_map(*[v for key, value in values.items() for v in (F.lit(key), value)])

    first, parts = (per_key({c: F.lit(v[i]) for c, v in of.items()})[F.col("cell")] for i in (0, 1))
    placed = placed.withColumn("block", (first + F.pmod(F.xxhash64("node"), parts)).cast("int"))

    def home(table: pa.Table) -> pa.Table:
        """The rows of a block with their nearest inside it, and the blocks that may hold nearer ones."""
        table = table.take(pc.sort_indices(table, sort_keys=[("low", "ascending")]))
        x = _matrix(table["vec"])
        asks, holds = table["asks"].to_numpy(), table["holds"].to_numpy()
        node, block = table["node"].to_numpy(), table["block"][0].as_py()
        held = np.flatnonzero(holds)
        limit = np.full(len(x), -1.0)
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if len(held):
            screen = _Screen(x, x[held])
            limit[asks] = screen.reached(want)[asks]
            # the row itself comes at distance 0: one more
            found, _ = _meet(x, x[held], limit, np.full(len(held), -1.0), holds, np.ones(len(held), bool),
                             np.arange(len(x)), held, want + 1, screen)
        else:
            limit[asks] = np.inf
        i, j, d = found
        count = np.bincount(i, minlength=len(x))
        limit[asks & (count <= want)] = np.inf
        starts = np.concatenate([[0], np.cumsum(count)])
        near = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(node[held][j]), pa.array(d)], names=["neighbour", "distance"]))
        visits = []
        for at in range(0, len(x), ROWS):
            part = x[at:at + ROWS]
            reach = _rough(part, centre) - radius <= (limit[at:at + ROWS] + _off(part, centre) * (limit[at:at + ROWS] >= 0))[:, None]
            reach &= asks[at:at + ROWS, None]
            hit = np.array([reach[:, c].any(axis=1) if b != block else np.zeros(len(part), bool)
                            for b, c in enumerate(cells)]).T
            visits += [np.flatnonzero(h).astype("int32") for h in hit]
        return pa.table({"node": table["node"], "vec": table["vec"], "holds": table["holds"], "low": table["low"],
                         "block": table["block"], "most": pa.array(limit), "near": near,
                         "visits": pa.array(visits, pa.list_(pa.int32()))})

    settled = cut_lineage(placed.select("node", "vec", "asks", "holds", "low", "block").repartition(len(cells), "block").groupBy("block").applyInArrow(
        home, f"node long, vec array<double>, holds boolean, low {kind}, block int, most double, "
              "near array<struct<neighbour: long, distance: double>>, visits array<int>"))
    found = settled.select("node", F.explode("near").alias("x")).select("node", "x.neighbour", "x.distance")
    pairs = {tuple(sorted((r["block"], r["other"]))) for r in
             settled.select("block", F.explode("visits").alias("other")).distinct().collect()}  # two blocks each
    if pairs:
        others = {}
        for a, b in sorted(pairs):
            others.setdefault(a, []).append(b)
            others.setdefault(b, []).append(a)
        sent = (settled.filter(F.col("block").isin(list(others)))
                .withColumn("other", F.explode(per_key({b: F.lit(v) for b, v in others.items()})[F.col("block")])))
        sent = sent.select(F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "node", "vec",
                           "holds", "low", (F.col("block") < F.col("other")).alias("left"),
                           F.when(F.array_contains("visits", F.col("other")), F.col("most")).otherwise(-1.0).alias("most"))

        def compare(table: pa.Table) -> pa.Table:
            table = table.take(pc.sort_indices(table, sort_keys=[("low", "ascending")]))
            left = table["left"].to_numpy()
            x, ask, holds, node = _matrix(table["vec"]), table["most"].to_numpy(), table["holds"].to_numpy(), table["node"].to_numpy()
            # rows that look for points come first, so that whole products of others are left out
            a, b = (rows[np.argsort(ask[rows] < 0, kind="stable")] for rows in (np.flatnonzero(left), np.flatnonzero(~left)))
            (i, j, d), (m, n, e) = _meet(x[a], x[b], ask[a].copy(), ask[b].copy(), holds[a], holds[b], a, b, want)
            return pa.table({"node": np.concatenate([node[a][i], node[b][m]]),
                             "neighbour": np.concatenate([node[b][j], node[a][n]]), "distance": np.concatenate([d, e])})

        found = found.unionByName(sent.repartition(len(pairs), "one", "two").groupBy("one", "two").applyInArrow(compare, "node long, neighbour long, distance double"))
    # ties stay until the ids decide; the node itself is one more
    found = (found.withColumn("_r", F.rank().over(Window.partitionBy("node").orderBy("distance"))).filter(F.col("_r") <= want + 1))
    ids = nodes.select(F.col("node").alias("neighbour"), F.explode("ids").alias("x")).select("neighbour", "x.id", "x.n")
    named = found.join(ids, "neighbour").select("node", F.col("id").alias("neighbour"), "distance", "n")
    named = named.withColumn("_c", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("_c", "n")
    asked = queries.join(nodes.select("vec", "node"), "vec").select("id", "node")
    best = Window.partitionBy("id").orderBy("distance", "neighbour")
    out = asked.join(named, "node").filter(~F.col("id").eqNullSafe(F.col("neighbour")))
    return cut_lineage(out.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)
                       .select("id", "neighbour", "distance", "place"))
