"""Terrain: lattice, point in polygon, raster lookup, relief classes."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideline.functions.sums import mean
from tideline.operators.scale import running, staged_blocks

RELIEF = ["Low Relief", "Moderate Relief", "High Relief"]  # by rising mean elevation


def regions(vertices: DataFrame, **wanted) -> DataFrame:
    """Vertices whose attributes have the wanted values."""
    for name, value in wanted.items():
        vertices = vertices.filter(F.col(name) == value)
    return vertices


def bounds(vertices: DataFrame) -> DataFrame:
    return vertices.agg(F.min("lon").alias("xmin"), F.min("lat").alias("ymin"),
                        F.max("lon").alias("xmax"), F.max("lat").alias("ymax"))


def lattice(box: DataFrame, n: int = 50) -> DataFrame:
    """n x n points over a bounding box, both ends included."""
    cells = box.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))

    def place(lo, hi, k):
        step = (F.col(hi) - F.col(lo)) / F.lit(float(n - 1))
        return F.when(F.col(k) == n - 1, F.col(hi)).otherwise(F.col(lo) + F.col(k) * step)

    return cells.select("i", "j", place("xmin", "xmax", "i").alias("lon"), place("ymin", "ymax", "j").alias("lat"))


def edges(vertices: DataFrame) -> DataFrame:
    """Closed rings to edges; vertices are (part, seq, lon, lat), in the order of seq.

    Vertices are numbered over the parts of a range shuffle and joined to the
    one after them, so a ring need not fit a task.
    """
    stored, block = staged_blocks(vertices.select("part", "seq", "lon", "lat"), ["part", "seq"])
    placed = running(stored, ["part"], ["seq"], block, {"_i": (F.lit(1).cast("bigint"), "sum")}, totals=["_i"])
    after = placed.select("part", (F.col("_i") - 1).alias("_at"), F.col("lon").alias("x2"), F.col("lat").alias("y2"))
    return (placed.withColumn("_at", F.col("_i") % F.col("_i_total")).join(after, ["part", "_at"])
            .select("part", F.col("lon").alias("x1"), F.col("lat").alias("y1"), "x2", "y2")
            .filter((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2"))))


def _crosses(x: Column, y: Column, x1, y1, x2, y2) -> Column:
    """The edge meets the ray to the right of the point (lower end in, upper end out)."""
    spans = (y1 > y) != (y2 > y)
    return spans & (x < (x2 - x1) * (y - y1) / F.when(y2 != y1, y2 - y1) + x1)


def _touches(x: Column, y: Column, x1, y1, x2, y2) -> Column:
    """The point lies on the edge."""
    cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
    return ((cross == 0) & x.between(F.least(x1, x2), F.greatest(x1, x2))
            & y.between(F.least(y1, y2), F.greatest(y1, y2)))


def inside(points: DataFrame, vertices: DataFrame, bands: int = 1024) -> DataFrame:
    """Points strictly inside the outline (even-odd rule over all rings).

    The bounding box filters first. Points and edges meet by latitude band and
    crossings are counted, so neither side has to fit a task. An outline
    without height has no inside.
    """
    lines = edges(vertices)
    box = bounds(vertices)
    part = lambda c: box.select(c).scalar()
    x, y = F.col("lon"), F.col("lat")
    near = points.filter(x.between(part("xmin"), part("xmax")) & y.between(part("ymin"), part("ymax")))
    low, high = part("ymin"), part("ymax")

    def band(v):
        place = F.floor(F.try_divide(v - low, high - low) * F.lit(bands))
        return F.least(place, F.lit(bands - 1)).cast("int")

    lowest, highest = band(F.least("y1", "y2")), band(F.greatest("y1", "y2"))
    spread = lines.filter(lowest.isNotNull()).withColumn("_b", F.explode(F.sequence(lowest, highest)))
    corner = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    per = (near.select("lon", "lat").distinct().withColumn("_b", band(y)).join(spread, "_b").groupBy("lon", "lat")
           .agg(F.count_if(_crosses(x, y, *corner)).alias("_c"), F.max(_touches(x, y, *corner)).alias("_t")))
    good = per.filter((F.col("_c") % 2 == 1) & ~F.col("_t")).select("lon", "lat")
    return near.join(good, ["lon", "lat"], "left_semi")


def elevation_at(points: DataFrame, pixels: DataFrame, x0: float, y0: float, dx: float, dy: float,
                 keys: list[str] = ("lon", "lat")) -> DataFrame:
    """Bilinear elevation from the four pixels around each point.

    ``pixels`` is (row, col, elevation), rows counted downwards from ``y0``.
    With fewer than four pixels the nearest one counts; a point whose nearest
    pixel is missing is dropped.
    """
    keys = list(keys)
    p = (points.withColumn("_fc", (F.col("lon") - x0) / dx).withColumn("_fr", (F.lit(y0) - F.col("lat")) / dy)
         .withColumn("_c", F.rint("_fc").cast("int")).withColumn("_r", F.rint("_fr").cast("int")))
    u = F.lit(0.5) - (F.col("_c") - F.col("_fc"))
    v = F.lit(0.5) + (F.col("_r") - F.col("_fr"))
    p = p.withColumn("_u", u).withColumn("_v", v)

    def corner(dr, dc, w, near):
        return F.struct((F.col("_r") + dr).alias("row"), (F.col("_c") + dc).alias("col"), w.alias("w"),
                        near.cast("int").alias("near"))

    U, V = F.col("_u"), F.col("_v")
    left, up = F.rint(U) == 0, F.rint(1 - V) == 0
    four = F.array(corner(-1, -1, (1 - U) * V, up & left), corner(-1, 0, U * V, up & ~left),
                   corner(0, -1, (1 - U) * (1 - V), ~up & left), corner(0, 0, U * (1 - V), ~up & ~left))
    looked = p.select(*keys, F.explode(four).alias("k")).select(*keys, "k.*").join(
        pixels.select("row", "col", "elevation"), ["row", "col"], "left")
    mixed = F.sum(F.col("w") * F.col("elevation"))
    nearest = F.max(F.when(F.col("near") == 1, F.col("elevation")))
    value = F.when(F.count("elevation") == 4, mixed).otherwise(nearest)
    return looked.groupBy(*keys).agg(value.alias("elevation")).filter(F.col("elevation").isNotNull())


def relief_classes(points: DataFrame, k: int = 3, seed: int = 42) -> DataFrame:
    """Cluster standardised elevation and name the clusters by rising mean height.

    Classes beyond the three named ones are called "Relief 4" and so on.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    flow = Pipeline(stages=[
        VectorAssembler(inputCols=["elevation"], outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_std", withMean=True, withStd=True),
        KMeans(featuresCol="_std", predictionCol="cluster", k=k, seed=seed)])
    x = flow.fit(points).transform(points).drop("_raw", "_std")
    means = x.groupBy("cluster").agg(F.avg("elevation").alias("_m"))  # k rows
    order = Window.partitionBy(F.lit(0)).orderBy("_m")
    place = F.row_number().over(order)
    names = F.array(*[F.lit(n) for n in RELIEF])
    named = means.select("cluster", F.coalesce(F.try_element_at(names, place), F.concat(F.lit("Relief "), place))
                         .alias("relief_zone"))
    return x.join(F.broadcast(named), "cluster").drop("cluster")


def zone_centroids(points: DataFrame, by: str = "relief_zone") -> DataFrame:
    return points.groupBy(by).agg(
        mean("lat").alias("latitude"), mean("lon").alias("longitude"), F.count(F.lit(1)).alias("point_count"),
        mean("elevation").alias("mean_elevation"))


def zone_builder(vertices: DataFrame, pixels: DataFrame, x0, y0, dx, dy, n: int = 50) -> DataFrame:
    """Outline and raster to relief zones with their centroids."""
    grid = inside(lattice(bounds(vertices), n), vertices)
    return zone_centroids(relief_classes(elevation_at(grid, pixels, x0, y0, dx, dy)))
