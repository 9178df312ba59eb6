"""Checked queries: terrain operators on shapes derived from the tables, SQL functions, table flows."""
from __future__ import annotations

from pyspark.sql import functions as F

from tideline import settings as S
from tideline.functions import sql_functions
from tideline.functions.sums import mean, settle
from tideline.operators import features as X, geo as G, report as P
from tideline.plans import flows, oracle as O
from tideline.plans.core_queries import h_silver, round_cycles
from tideline.plans.registry import Registry
from tideline.session import shared_folder
from tideline.sources import adapters as A, feeds
from tideline.sources.lake import Lake

geo = Registry()


def outline(spark, d):
    """A closed outline: one vertex per hour of the day, further out where values are higher."""
    hours = A.table(spark, d, "events").groupBy(F.hour("ts").alias("seq")).agg(mean("value").alias("m"))
    turn = F.lit(2.0) * F.pi() * F.col("seq") / F.lit(24)
    r = F.lit(1.0) + F.col("m") / F.lit(100.0)
    return hours.select(F.lit(0).alias("part"), "seq", F.round(r * F.cos(turn), 6).alias("lon"),
                        F.round(r * F.sin(turn), 6).alias("lat"))


def places(spark, d):
    k = F.col("o_orderkey")
    return A.table(spark, d, "orders").select(
        k.alias("id"), ((k * 37 % 4001).cast("double") / 1000 - 2).alias("lon"),
        ((k * 53 % 4003).cast("double") / 1000 - 2).alias("lat"))


def pixels(spark, d):
    return (A.table(spark, d, "lineitem")
            .groupBy((F.col("l_partkey") % 40).cast("int").alias("row"), (F.col("l_suppkey") % 40).cast("int").alias("col"))
            .agg(mean("l_quantity").alias("elevation")))


_SHAPES = {
    "vx": f"SELECT 0 AS part, seq, round((1e0 + m / 100e0) * cos(2e0 * pi() * seq / 24), 6) AS lon, "
          "round((1e0 + m / 100e0) * sin(2e0 * pi() * seq / 24), 6) AS lat FROM (SELECT extract(hour FROM ts) AS seq, "
          f"{O.mean('value')} AS m FROM events GROUP BY 1) q",
    "ed": "SELECT lon AS x1, lat AS y1, coalesce(LEAD(lon) OVER (ORDER BY seq), FIRST_VALUE(lon) OVER (ORDER BY seq)) AS x2, "
          "coalesce(LEAD(lat) OVER (ORDER BY seq), FIRST_VALUE(lat) OVER (ORDER BY seq)) AS y2 FROM vx",
    "pl": "SELECT o_orderkey AS id, CAST(o_orderkey * 37 % 4001 AS DOUBLE) / 1000 - 2 AS lon, "
          "CAST(o_orderkey * 53 % 4003 AS DOUBLE) / 1000 - 2 AS lat FROM orders",
    "px": f"SELECT l_partkey % 40 AS row, l_suppkey % 40 AS col, {O.mean('l_quantity')} AS elevation FROM lineitem "
          "GROUP BY 1, 2",
}


@geo.add("G5_region_bounds", O.sql(
    "SELECT MIN(lon) AS xmin, MIN(lat) AS ymin, MAX(lon) AS xmax, MAX(lat) AS ymax FROM vx WHERE part = 0", extra=_SHAPES))
def _(spark, d):
    return G.bounds(G.regions(outline(spark, d), part=0))


_GRID = ("SELECT i, j, CASE WHEN i = 49 THEN xmax ELSE xmin + i * ((xmax - xmin) / 49e0) END AS lon, CASE WHEN j = 49 THEN "
         "ymax ELSE ymin + j * ((ymax - ymin) / 49e0) END AS lat FROM (SELECT MIN(lon) AS xmin, MIN(lat) AS ymin, MAX(lon) AS "
         "xmax, MAX(lat) AS ymax FROM vx) b, (SELECT unnest(generate_series(0, 49)) AS i) a, "
         "(SELECT unnest(generate_series(0, 49)) AS j) c")


@geo.add("G4_lattice", O.sql(_GRID, extra=_SHAPES))
def _(spark, d):
    return G.lattice(G.bounds(outline(spark, d)))


_IN = ("SELECT p.id FROM pl p, ed e GROUP BY p.id HAVING SUM(CASE WHEN (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * "
       "(lat - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1 AND NOT bool_or((x2 - x1) * (lat - y1) - (y2 - y1) * "
       "(lon - x1) = 0 AND lon BETWEEN least(x1, x2) AND greatest(x1, x2) AND lat BETWEEN least(y1, y2) AND greatest(y1, y2))")


@geo.add("J13_point_in_polygon", O.sql(_IN, extra=_SHAPES))
def _(spark, d):
    return G.inside(places(spark, d), outline(spark, d)).select("id")


@geo.add("J13_point_in_long_outline", O.sql(_IN, extra=_SHAPES))
def _(spark, d):
    return G.inside(places(spark, d), outline(spark, d), bands=16).select("id")


_BIL = {
    **_SHAPES,
    "sp": "SELECT id, (lon + 2) / 0.1e0 AS fc, (2 - lat) / 0.1e0 AS fr FROM pl",
    "cn": "SELECT id, CAST(round_even(fc, 0) AS INT) AS c, CAST(round_even(fr, 0) AS INT) AS r, "
          "0.5e0 - (round_even(fc, 0) - fc) AS u, 0.5e0 + (round_even(fr, 0) - fr) AS v FROM sp",
    "vv": "SELECT id, u, v, a.elevation AS ul, b.elevation AS ur, q.elevation AS ll, w.elevation AS lr FROM cn "
          "LEFT JOIN px a ON a.row = r - 1 AND a.col = c - 1 LEFT JOIN px b ON b.row = r - 1 AND b.col = c "
          "LEFT JOIN px q ON q.row = r AND q.col = c - 1 LEFT JOIN px w ON w.row = r AND w.col = c",
}


@geo.add("J14_raster_lookup", O.sql(
    "SELECT id, round(elevation + 1.37e-11, 9) AS elevation FROM (SELECT id, CASE WHEN ul IS NULL OR ur IS NULL OR ll IS NULL OR lr IS "
    "NULL THEN CASE WHEN round_even(1 - v, 0) = 0 THEN CASE WHEN round_even(u, 0) = 0 THEN ul ELSE ur END ELSE CASE WHEN "
    "round_even(u, 0) = 0 THEN ll ELSE lr END END ELSE ul * (1 - u) * v + ur * u * v + ll * (1 - u) * (1 - v) + lr * u * (1 - v) "
    "END AS elevation FROM vv) q WHERE elevation IS NOT NULL", extra=_BIL))
def _(spark, d):
    x = G.elevation_at(places(spark, d), pixels(spark, d), -2.0, 2.0, 0.1, 0.1, keys=["id"])
    return x.select("id", settle(F.col("elevation")).alias("elevation"))


@geo.add("M36_relief_classes")
def _(spark, d):
    x = G.elevation_at(places(spark, d), pixels(spark, d), -2.0, 2.0, 0.1, 0.1, keys=["id", "lon", "lat"])
    return G.relief_classes(x)


@geo.add("A19_zone_centroids", O.sql(
    "SELECT relief_zone, " + ", ".join(f"{O.mean(c)} AS {n}" for c, n in (
        ("lat", "latitude"), ("lon", "longitude"), ("elevation", "mean_elevation")))
    + ", COUNT(*) AS point_count FROM (SELECT CASE WHEN row % 3 = 0 THEN 'Low Relief' ELSE 'High Relief' END AS relief_zone, "
    "CAST(row AS DOUBLE) / 10 AS lat, CAST(col AS DOUBLE) / 10 AS lon, elevation FROM px) q GROUP BY 1", extra=_SHAPES))
def _(spark, d):
    x = pixels(spark, d).select(
        F.when(F.col("row") % 3 == 0, "Low Relief").otherwise("High Relief").alias("relief_zone"),
        (F.col("row").cast("double") / 10).alias("lat"), (F.col("col").cast("double") / 10).alias("lon"), "elevation")
    return G.zone_centroids(x)


@geo.add("C12_zone_builder")
def _(spark, d):
    return G.zone_builder(outline(spark, d), pixels(spark, d), -2.0, 2.0, 0.1, 0.1)


@geo.add("S13_terrain_points", O.sql(
    "SELECT CAST(col AS DOUBLE) AS lon, CAST(row AS DOUBLE) AS lat, elevation, row % 3 AS zone_idx FROM px", extra=_SHAPES))
def _(spark, d):
    path = shared_folder(spark, "points")
    p = pixels(spark, d).select("row", F.array(F.col("col").cast("double"), F.col("row").cast("double"), "elevation",
                                               (F.col("row") % 3).cast("double")).alias("p"))
    p.groupBy("row").agg(F.collect_list("p").alias("points")).select("points").write.json(path)
    return feeds.points(spark, path)


@geo.add("S14_boundary_and_raster", O.sql(
    "SELECT 'vertex' AS kind, COUNT(*) AS n FROM vx UNION ALL SELECT 'pixel', COUNT(*) FROM px", extra=_SHAPES))
def _(spark, d):
    lake = Lake(spark, shared_folder(spark, "lake"))
    v = lake.replace(outline(spark, d), "bronze", "boundary_vertices")
    x = lake.replace(pixels(spark, d), "bronze", "raster_pixels")
    n = lambda df, k: df.agg(F.lit(k).alias("kind"), F.count(F.lit(1)).alias("n"))
    return n(v, "vertex").unionByName(n(x, "pixel"))


@geo.add("UF1_sql_functions", O.sql(
    f"SELECT x.zone, x.time_6h, {O.label('x.river_discharge', 'x.precipitation', 'x.relative_humidity_2m')} AS label, "
    f"q.dq_score AS dq, {O.level_cut('x.precipitation / 10')} AS lv_cut, {O.level_ge('x.precipitation / 10')} AS lv_ge, "
    "x.precipitation + 0.85e0 * x.temperature_2m + 0.7225e0 * x.wind_speed_10m + 0.52200625e0 * x.relative_humidity_2m AS idx "
    "FROM h_silver x JOIN (" + O.dq_of("h_silver") + ") q ON q.zone = x.zone AND q.time_6h = x.time_6h", "h_silver"))
def _(spark, d):
    sql_functions.register(spark)
    h_silver(spark, d).createOrReplaceTempView("slots_6h")
    return spark.sql(
        "SELECT zone, time_6h, flood_label(river_discharge, precipitation, relative_humidity_2m) AS label, "
        f"dq_score({', '.join(S.SENSOR_BOUNDS)}) AS dq, risk_level_cut(precipitation / 10) AS lv_cut, "
        "risk_level_ge(precipitation / 10) AS lv_ge, decay_index(precipitation, temperature_2m, wind_speed_10m, "
        "relative_humidity_2m) AS idx FROM slots_6h")


@geo.add("C3_stored_history", O.sql("SELECT * FROM h_gold", "h_gold"))
def _(spark, d):
    lake = Lake(spark, shared_folder(spark, "lake"))
    lake.replace(A.history_weather(spark, d), "bronze", "weather_raw", ["zone"])
    lake.replace(A.history_discharge(spark, d), "bronze", "flood_raw", ["zone"])
    out = flows.build_history(lake)
    return round_cycles(out.select("zone", "time_6h", *S.GOLD_FEATURES, "dq_score", "is_flood"))


@geo.add("C7_forecast_run")
def _(spark, d):
    from tideline.operators import learning as L, splits as T
    from tideline.plans import training as W
    from tideline.plans.climate_queries import split_history
    live, past = split_history(spark, d)
    now = live.agg(F.min("time_6h").alias("n")).scalar()
    x, names, categories = W.prepare(X.gold(past))
    fit, _ = T.chronological_split(x)
    model = L.boosted().fit(L.weighted(fit))
    bundle = W.Bundle(L.FoldedModel([(model, L.isotonic(L.probability(model, fit)))]), names, categories, 0.4)
    scored = W.predict(flows.forecast_features(live, past, A.zones(spark), now), bundle)
    return P.zone_alerts(scored)
