"""Queries of the spatial, terrain, audit, naming and learning operators on the driver's tables, each with its DuckDB oracle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from terraline.functions import geo, naming
from terraline.operators import audit, filters, ordered, spatial, terrain
from terraline.plans.telemetry import FIXES, events, fixes, query, r6
from terraline.sources import network
from terraline.sources.tables import table

# ------------------------------------------------------------------------------------------------ spatial

POINTS = "p AS (SELECT s_suppkey AS pid, ((s_suppkey * 53) % 1000)::DOUBLE AS x, ((s_suppkey * 29) % 1000)::DOUBLE AS y FROM supplier), o AS (SELECT event_id AS oid, ((event_id * 37) % 1000)::DOUBLE AS ox, ((event_id * 91) % 1000)::DOUBLE AS oy FROM events)"
DIST = "sqrt((x - ox) ** 2 + (y - oy) ** 2)"


def _points(spark, sf_dir):
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(s.alias("pid"), ((s * 53) % 1000).cast("double").alias("x"), ((s * 29) % 1000).cast("double").alias("y"))


def _others(spark, sf_dir):
    return fixes(spark, sf_dir).select(F.col("event_id").alias("oid"), F.col("x").alias("ox"), F.col("y").alias("oy"))


@query("radius_join", f"WITH {POINTS} SELECT pid, oid, round({DIST}, 6) AS dist FROM p JOIN o ON {DIST} <= 12")
def radius_join(spark, sf_dir):
    return spatial.radius_join(_points(spark, sf_dir), _others(spark, sf_dir), 12.0).select("pid", "oid", r6("dist", "dist"))


@query("knn_join", f"WITH {POINTS} SELECT pid, oid, round(dist, 6) AS dist, rank FROM (SELECT pid, oid, {DIST} AS dist, row_number() OVER (PARTITION BY pid ORDER BY {DIST}, oid) AS rank FROM p, o) WHERE rank <= 3")
def knn_join(spark, sf_dir):
    return spatial.knn_join(_points(spark, sf_dir), _others(spark, sf_dir), 3, "pid", "oid", 8.0).select("pid", "oid", r6("dist", "dist"), "rank")


@query("nearest_with_threshold", f"WITH {POINTS} SELECT pid, oid, round(dist, 6) AS dist, dist <= 4 AS on_road FROM (SELECT pid, oid, {DIST} AS dist, row_number() OVER (PARTITION BY pid ORDER BY {DIST}, oid) AS rank FROM p, o) WHERE rank = 1")
def nearest_with_threshold(spark, sf_dir):
    return spatial.nearest_with_threshold(_points(spark, sf_dir), _others(spark, sf_dir), "pid", "oid", 8.0, 4.0).select("pid", "oid", r6("dist", "dist"), "on_road")


@query("within_radius_semi", f"WITH {POINTS} SELECT oid, ox, oy FROM o WHERE EXISTS (SELECT 1 FROM p WHERE {DIST} <= 5)")
def within_radius_semi(spark, sf_dir):
    return spatial.within_radius(_others(spark, sf_dir), _points(spark, sf_dir), 5.0, "oid")


EDGES = "e AS (SELECT n_nationkey AS edge_id, k AS seg_idx, ((n_nationkey * 41 + k * 170) % 1000)::DOUBLE AS ax, ((n_nationkey * 67 + k * 230) % 1000)::DOUBLE AS ay, ((n_nationkey * 41 + (k + 1) * 170) % 1000)::DOUBLE AS bx, ((n_nationkey * 67 + (k + 1) * 230) % 1000)::DOUBLE AS by_ FROM nation, (SELECT unnest([0, 1, 2]) AS k))"


def _edges(spark, sf_dir):
    n = F.col("n_nationkey")
    point = lambda k: F.struct(((n * 41 + k * 170) % 1000).cast("double").alias("x"), ((n * 67 + k * 230) % 1000).cast("double").alias("y"))
    return table(spark, sf_dir, "nation").select(n.alias("edge_id"), F.array(*[point(k) for k in range(4)]).alias("coords"))


@query("polyline_segments", f"WITH {EDGES} SELECT edge_id, seg_idx, ax, ay, bx, by_ AS by FROM e")
def polyline_segments(spark, sf_dir):
    return spatial.edge_segments(_edges(spark, sf_dir)).drop("coords")


@query("edge_samples", f"WITH {EDGES}, l AS (SELECT *, greatest(2, ceil(sqrt((bx - ax) ** 2 + (by_ - ay) ** 2) * 0.25))::INT AS n FROM e WHERE sqrt((bx - ax) ** 2 + (by_ - ay) ** 2) >= 1e-3), s AS (SELECT *, unnest(range(n)) AS i FROM l) SELECT edge_id, seg_idx, round(ax + i / (n - 1) * (bx - ax), 4) AS ox, round(ay + i / (n - 1) * (by_ - ay), 4) AS oy FROM s")
def edge_samples(spark, sf_dir):
    return spatial.edge_samples(spatial.edge_segments(_edges(spark, sf_dir))).select("edge_id", "seg_idx", F.round("ox", 4).alias("ox"), F.round("oy", 4).alias("oy"))


PROJECT = "q AS (SELECT pid, edge_id, seg_idx, ax, ay, bx, by_, x, y, CASE WHEN (bx - ax) ** 2 + (by_ - ay) ** 2 < 1e-12 THEN 0.0 ELSE greatest(0.0, least(1.0, ((x - ax) * (bx - ax) + (y - ay) * (by_ - ay)) / ((bx - ax) ** 2 + (by_ - ay) ** 2))) END AS t FROM p, e), d AS (SELECT *, sqrt((x - ax - t * (bx - ax)) ** 2 + (y - ay - t * (by_ - ay)) ** 2) AS dist FROM q)"


@query("point_segment_projection", f"WITH {POINTS}, {EDGES}, {PROJECT} SELECT pid, edge_id, round(dist, 6) AS dist FROM d WHERE dist <= 40 QUALIFY row_number() OVER (PARTITION BY pid, edge_id ORDER BY dist, seg_idx) = 1")
def point_segment_projection(spark, sf_dir):
    segments = spatial.edge_segments(_edges(spark, sf_dir)).drop("coords")
    near = spatial.radius_join(_points(spark, sf_dir), spatial.edge_samples(segments).select("edge_id", "ox", "oy"), 45.0).select("pid", "x", "y", "edge_id").distinct()
    return spatial.project_on_edges(near, segments, ["pid"]).where("dist <= 40").select("pid", "edge_id", r6("dist", "dist"))


@query("tile_range_join", f"WITH {POINTS}, t AS (SELECT tx, ty, 'tile_' || tx || '-' || ty AS path FROM (SELECT unnest(range(-2, 12, 2)) AS tx), (SELECT unnest(range(-1, 13)) AS ty)) SELECT pid, path FROM p JOIN t ON tx BETWEEN floor((x - 60) / 100) AND floor((x + 60) / 100) AND ty BETWEEN floor((y - 60) / 100) + 1 AND floor((y + 60) / 100) + 1")
def tile_range_join(spark, sf_dir):
    tiles = spark.range(-2, 12, 2).select(F.col("id").cast("int").alias("tx"), F.explode(F.sequence(F.lit(-1), F.lit(12))).alias("ty"))
    return spatial.tile_join(_points(spark, sf_dir), tiles.withColumn("path", F.format_string("tile_%d-%d", "tx", "ty")), 60.0, tile=100.0).select("pid", "path")


@query("bbox_filter", f"WITH {FIXES} SELECT event_id, x, y FROM fixes WHERE x BETWEEN 150 AND 450 AND y BETWEEN 250 AND 550")
def bbox_filter(spark, sf_dir):
    return fixes(spark, sf_dir).where(F.col("x").between(150, 450) & F.col("y").between(250, 550)).select("event_id", "x", "y")


@query("point_in_box", f"WITH {POINTS}, b AS (SELECT 'b' || i || j AS name, i * 150.0 AS x0, i * 150.0 + 220 AS x1, j * 150.0 AS y0, j * 150.0 + 220 AS y1 FROM (SELECT unnest(range(6)) AS i), (SELECT unnest(range(6)) AS j)) SELECT pid, min(name) AS name FROM p JOIN b ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 GROUP BY pid")
def point_in_box(spark, sf_dir):
    six = spark.range(6).select(F.col("id").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(5))).alias("j"))
    boxes = six.select(F.format_string("b%d%d", "i", "j").alias("name"), (F.col("i") * 150.0).alias("x0"), (F.col("i") * 150.0 + 220).alias("x1"), (F.col("j") * 150.0).alias("y0"), (F.col("j") * 150.0 + 220).alias("y1"))
    return spatial.containing_box(_points(spark, sf_dir), boxes, "pid", size=150.0)


@query("bbox_containment", f"WITH {EDGES}, b AS (SELECT edge_id, min(least(ax, bx)) AS min_lon, max(greatest(ax, bx)) AS max_lon, min(least(ay, by_)) AS min_lat, max(greatest(ay, by_)) AS max_lat FROM e GROUP BY edge_id) SELECT * FROM b WHERE min_lon <= 300 AND max_lon >= 500 AND min_lat <= 350 AND max_lat >= 600")
def bbox_containment(spark, sf_dir):
    edges = _edges(spark, sf_dir).select("edge_id", F.transform("coords", lambda p: F.struct(p["x"].alias("lon"), p["y"].alias("lat"))).alias("coords"))
    return network.covering_networks(network.network_bounds(edges, ["edge_id"]), (300.0, 500.0, 350.0, 600.0))


@query("first_rows_bbox", f"WITH {FIXES} SELECT user_id, min(lat) AS min_lat, max(lat) AS max_lat, min(lon) AS min_lon, max(lon) AS max_lon FROM (SELECT * FROM fixes QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) <= 50) GROUP BY user_id")
def first_rows_bbox(spark, sf_dir):
    return filters.first_n(fixes(spark, sf_dir), ["user_id"], ["event_id"], 50).groupBy("user_id").agg(F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"), F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"))


def _utm_sql(lon: str, lat: str) -> str:
    e, a, r = geo._E, geo._ALPHA, geo._K0 * geo._RADIUS
    east = "eta + " + " + ".join(f"{k!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, k in enumerate(a, 1))
    north = "xi + " + " + ".join(f"{k!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, k in enumerate(a, 1))
    return f"t0 AS (SELECT *, sinh(atanh(sin(radians({lat}))) - {e!r} * atanh({e!r} * sin(radians({lat})))) AS t, radians({lon} + 3) AS lam FROM fixes), t1 AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM t0), utm AS (SELECT event_id, 500000 + {r!r} * ({east}) AS e, {r!r} * ({north}) AS n FROM t1)"


@query("utm_forward", f"WITH {FIXES}, {_utm_sql('lon', 'lat')} SELECT event_id, round(e, 4) AS x_utm, round(n, 4) AS y_utm FROM utm")
def utm_forward(spark, sf_dir):
    e, n = geo.utm_forward(F.col("lon"), F.col("lat"))
    return fixes(spark, sf_dir).select("event_id", F.round(e, 4).alias("x_utm"), F.round(n, 4).alias("y_utm"))


@query("utm_round_trip", f"WITH {FIXES} SELECT event_id, round(lon, 6) AS lon, round(lat, 6) AS lat FROM fixes")
def utm_round_trip(spark, sf_dir):
    e, n = geo.utm_forward(F.col("lon"), F.col("lat"))
    lon, lat = geo.utm_inverse(F.col("e"), F.col("n"))
    return fixes(spark, sf_dir).select("event_id", e.alias("e"), n.alias("n")).select("event_id", r6(lon, "lon"), r6(lat, "lat"))


@query("haversine", f"WITH {FIXES} SELECT event_id, round(2 * 6371000.0 * asin(sqrt(least(1.0, sin(radians(40 - lat) / 2) ** 2 + cos(radians(lat)) * cos(radians(40)) * sin(radians(-3 - lon) / 2) ** 2))), 4) AS m FROM fixes")
def haversine(spark, sf_dir):
    return fixes(spark, sf_dir).select("event_id", F.round(geo.haversine_m(F.col("lat"), F.col("lon"), F.lit(40), F.lit(-3)), 4).alias("m"))


@query("bearing", f"WITH {FIXES}, b AS (SELECT event_id, fmod(degrees(atan2(x - 500, y - 500)) + 360, 360) AS b FROM fixes) SELECT event_id, round(b, 6) AS bearing, round(least(abs(b - 90), 360 - abs(b - 90)), 6) AS diff FROM b")
def bearing(spark, sf_dir):
    b = geo.bearing_deg(F.col("x") - 500, F.col("y") - 500)
    return fixes(spark, sf_dir).select("event_id", b.alias("b")).select("event_id", r6("b", "bearing"), r6(geo.angular_diff(F.col("b"), F.lit(90.0)), "diff"))


@query("wkt_parse", "SELECT event_id, 3 AS n, (event_id % 90)::DOUBLE AS lon, -(event_id % 45) / 2 AS lat FROM events")
def wkt_parse(spark, sf_dir):
    e = F.col("event_id")
    wkt = F.concat(F.lit("LINESTRING (1 2, "), (e % 90).cast("string"), F.lit(" "), (-(e % 45) / 2).cast("string"), F.lit(", 3.5 4)"))
    c = naming.linestring(wkt)
    return events(spark, sf_dir).select("event_id", F.size(c).alias("n"), c[1]["lon"].alias("lon"), c[1]["lat"].alias("lat"))


# ------------------------------------------------------------------------------------------------ terrain

CELLS = "cells AS (SELECT p_partkey // 400 AS g, (p_partkey % 400) // 20 AS row, p_partkey % 20 AS col, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE ((p_partkey * 31) % 97)::DOUBLE END AS z FROM part)"


def _cells(spark, sf_dir):
    p = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(F.floor(p / 400).alias("g"), F.floor((p % 400) / 20).alias("row"), (p % 20).alias("col"), F.when(p % 17 != 0, ((p * 31) % 97).cast("double")).alias("z"))


@query("dem_features", f"WITH {CELLS} SELECT g, count(z) AS n_cells, min(z) AS z_min, max(z) AS z_max, round(avg(z), 6) AS z_mean, round(stddev_pop(z), 6) AS z_std, max(z) - min(z) AS z_range, round(coalesce(stddev_pop(z), 0), 6) AS tri FROM cells GROUP BY g")
def dem_features(spark, sf_dir):
    return terrain.dem_stats(_cells(spark, sf_dir), ["g"]).select("g", "n_cells", "z_min", "z_max", r6("z_mean", "z_mean"), r6("z_std", "z_std"), "z_range", r6("tri", "tri"))


@query("ruggedness", f"WITH {CELLS}, f AS (SELECT g, row, col, z AS raw, coalesce(z, avg(z) OVER (PARTITION BY g)) AS z FROM cells), d AS (SELECT g, raw, abs(z - lag(z) OVER (PARTITION BY g, row ORDER BY col)) AS a, abs(z - lag(z) OVER (PARTITION BY g, col ORDER BY row)) AS b FROM f) SELECT g, CASE WHEN count(*) < 4 OR count(a) + count(b) = 0 THEN 0.0 ELSE round((coalesce(sum(a), 0) + coalesce(sum(b), 0)) / (count(a) + count(b)), 6) END AS ruggedness FROM d GROUP BY g")
def ruggedness(spark, sf_dir):
    return terrain.ruggedness(_cells(spark, sf_dir), ["g"]).select("g", r6("ruggedness", "ruggedness"))


@query("phi_lidar", f"WITH {CELLS}, m AS (SELECT *, (max(row) OVER (PARTITION BY g) + 1) // 2 AS r FROM cells), f AS (SELECT g, col, coalesce(z, avg(z) OVER (PARTITION BY g)) AS z FROM m WHERE row = r) SELECT g, round(coalesce(atan(regr_slope(z, col)), 0.0), 6) AS phi_lidar FROM f GROUP BY g")
def phi_lidar(spark, sf_dir):
    return terrain.phi_lidar(_cells(spark, sf_dir), ["g"]).select("g", r6("phi_lidar", "phi_lidar"))


_K = [(i, j, (2 if j == 0 else 1) * i, (2 if i == 0 else 1) * j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0)]


_SUMS = ", ".join("(" + " + ".join(f"coalesce(n{k}.z, 0) * {-w[m]}" for k, (_, _, *w) in enumerate(_K)) + f") / 8 AS g{a}" for m, a in ((1, "x"), (0, "y")))
_NEAR = " ".join(f"LEFT JOIN full_ n{k} ON n{k}.g = c.g AND n{k}.row = c.row + {i} AND n{k}.col = c.col + {j}" for k, (i, j, _, _) in enumerate(_K))


@query("sobel", f"WITH {CELLS}, full_ AS (SELECT g, row, col, coalesce(z, avg(z) OVER (PARTITION BY g)) AS z FROM cells), s AS (SELECT c.g, c.row, c.col, {_SUMS} FROM full_ c {_NEAR}) SELECT g, row, col, round(gx, 6) AS gx, round(gy, 6) AS gy, round(atan(sqrt(gx * gx + gy * gy)), 6) AS slope, CASE WHEN abs(gx) + abs(gy) > 1e-6 THEN round(abs(atan2(gy, gx)), 6) END AS aspect FROM s")
def sobel(spark, sf_dir):
    found = terrain.sobel(_cells(spark, sf_dir), ["g"])
    flat = F.abs("gx") + F.abs("gy") <= 1e-6  # no direction; and pi and minus pi are one
    return found.select("g", "row", "col", r6("gx", "gx"), r6("gy", "gy"), r6("slope", "slope"), F.when(~flat, F.round(F.abs("aspect"), 6)).alias("aspect"))


@query("raster_bilinear", f"WITH {POINTS}, c AS (SELECT pid, x / 60 AS fx, (1200 - y) / 60 AS fy FROM p), k AS (SELECT pid, floor(fx) + j AS col, floor(fy) + i AS row, (CASE WHEN i = 1 THEN fy - floor(fy) ELSE 1 - (fy - floor(fy)) END) * (CASE WHEN j = 1 THEN fx - floor(fx) ELSE 1 - (fx - floor(fx)) END) AS w FROM c, (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j)), r AS (SELECT p_partkey // 20 AS row, p_partkey % 20 AS col, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE ((p_partkey * 31) % 97)::DOUBLE END AS z FROM part) SELECT pid, CASE WHEN count(z) = 4 THEN round(sum(w * z), 6) END AS z FROM k LEFT JOIN r ON r.row = k.row AND r.col = k.col GROUP BY pid")
def raster_bilinear(spark, sf_dir):
    p = F.col("p_partkey")
    raster = table(spark, sf_dir, "part").select(F.floor(p / 20).alias("row"), (p % 20).alias("col"), F.when(p % 17 != 0, ((p * 31) % 97).cast("double")).alias("z"))
    return spatial.bilinear(_points(spark, sf_dir), raster, "pid", 0.0, 1200.0, 60.0).select("pid", r6("z", "z"))


@query("cloud_stats", f"WITH {FIXES} SELECT count(*) AS n, min(x) AS x_min, max(x) AS x_max, min(y) AS y_min, max(y) AS y_max, round(avg(value), 6) AS z_mean, round(stddev_pop(value), 6) AS z_std FROM fixes")
def cloud_stats(spark, sf_dir):
    return fixes(spark, sf_dir).agg(F.count("*").alias("n"), F.min("x").alias("x_min"), F.max("x").alias("x_max"), F.min("y").alias("y_min"), F.max("y").alias("y_max"), r6(F.avg("value"), "z_mean"), r6(F.stddev_pop("value"), "z_std"))


@query("terrain_patches")
def terrain_patches(spark, sf_dir):
    cloud = fixes(spark, sf_dir).select(F.col("x").alias("ox"), F.col("y").alias("oy"), (F.col("x") * 0.1 + F.col("y") * 0.05).alias("oz"))
    return terrain.patches_around(_points(spark, sf_dir), cloud, 60.0, "pid")


@query("map_match_tracks")
def map_match_tracks(spark, sf_dir):
    from terraline.operators.matcher import match_tracks

    points = fixes(spark, sf_dir).select(F.col("user_id").alias("track"), F.col("event_id").alias("ord"), "x", "y")
    return match_tracks(points, _edges(spark, sf_dir))


# ------------------------------------------------------------------------------------------------ audit

STAGES = "b AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), a AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_totalprice > 150000 GROUP BY 1)"


def _stages(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "k")
    return o, o.where("o_totalprice > 150000")


@query("stage_full_outer_loss", f"WITH {STAGES} SELECT coalesce(b.k, a.k) AS k, coalesce(b.n, 0) AS before_rows, coalesce(a.n, 0) AS after_rows, greatest(0, coalesce(b.n, 0) - coalesce(a.n, 0)) AS lost_rows, round(CASE WHEN coalesce(b.n, 0) > 0 THEN 100.0 * greatest(0, coalesce(b.n, 0) - coalesce(a.n, 0)) / b.n ELSE 0 END, 6) AS loss_pct FROM b FULL JOIN a ON a.k = b.k")
def stage_full_outer_loss(spark, sf_dir):
    return audit.compare_stage_counts(*_stages(spark, sf_dir), "k").withColumn("loss_pct", F.round("loss_pct", 6))


@query("global_loss", "SELECT count(*) AS before_rows, count(*) FILTER (o_totalprice > 150000) AS after_rows, count(*) FILTER (NOT coalesce(o_totalprice > 150000, false)) AS lost_rows, round(100.0 * count(*) FILTER (NOT coalesce(o_totalprice > 150000, false)) / count(*), 6) AS loss_pct FROM orders")
def global_loss(spark, sf_dir):
    return audit.global_loss(audit.compare_stage_counts(*_stages(spark, sf_dir), "k")).withColumn("loss_pct", F.round("loss_pct", 6))


COVER = "cov AS (SELECT c_custkey, c_mktsegment, (SELECT count(*) FROM orders o WHERE o.o_custkey = c.c_custkey) AS ordered_rows, (SELECT count(*) FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderstatus = 'F') AS filled_rows FROM customer c)"


def _coverage(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return audit.coverage(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), {"ordered": o, "filled": o.where("o_orderstatus = 'F'")}, "c_custkey")


@query("coverage", f"WITH {COVER} SELECT *, ordered_rows > 0 AS has_ordered, filled_rows > 0 AS has_filled FROM cov")
def coverage(spark, sf_dir):
    return _coverage(spark, sf_dir)


@query("coverage_rollup", f"WITH {COVER} SELECT c_mktsegment, count(*) AS keys, count(*) FILTER (ordered_rows > 0) AS with_ordered, round(100.0 * count(*) FILTER (ordered_rows > 0) / count(*), 6) AS pct_ordered, count(*) FILTER (filled_rows > 0) AS with_filled, round(100.0 * count(*) FILTER (filled_rows > 0) / count(*), 6) AS pct_filled FROM cov GROUP BY ROLLUP (c_mktsegment)")
def coverage_rollup(spark, sf_dir):
    return audit.coverage_summary(_coverage(spark, sf_dir), ["ordered", "filled"], "c_mktsegment").withColumns({c: F.round(c, 6) for c in ("pct_ordered", "pct_filled")})


@query("attribution", "WITH g AS (SELECT user_id AS k, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1), i AS (SELECT user_id AS k, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1), o AS (SELECT user_id AS k, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1), m AS (SELECT coalesce(g.k, i.k, o.k) AS k, coalesce(g.n, 0) AS gn, coalesce(i.n, 0) AS inn, coalesce(o.n, 0) AS outn FROM g FULL JOIN i ON g.k = i.k FULL JOIN o ON o.k = coalesce(g.k, i.k)) SELECT k, gn AS gps_rows, inn AS imu_rows, outn AS out_rows, least(gn, inn) AS possible_rows, greatest(0, least(gn, inn) - outn) AS overlap_loss, CASE WHEN gn < inn THEN 'gps' WHEN inn < gn THEN 'imu' ELSE 'equal' END AS limited_by FROM m")
def attribution(spark, sf_dir):
    e = events(spark, sf_dir).withColumnRenamed("user_id", "k")
    return audit.attribution(e.where("event_type = 'error'"), e.where("event_type = 'click'"), e.where("event_type = 'view'"), "k")


VARS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("variable_profile", "WITH long AS (" + " UNION ALL ".join(f"SELECT '{v}' AS variable, {v} AS value FROM lineitem" for v in VARS) + "), q AS (SELECT variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM long GROUP BY 1) SELECT variable, count(*) AS n_rows, count(value) AS valid_rows, round(100.0 * (count(*) - count(value)) / count(*), 6) AS invalid_pct, round(100.0 * count(*) FILTER (q3 > q1 AND (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))) / count(value), 6) AS outlier_pct, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, min(value) AS min, max(value) AS max FROM long JOIN q USING (variable) GROUP BY variable")
def variable_profile(spark, sf_dir):
    got = audit.variable_profile(table(spark, sf_dir, "lineitem").select(*VARS), VARS)
    return got.withColumns({"invalid_pct": F.round("invalid_pct", 6), "outlier_pct": F.round("outlier_pct", 6), "mean": F.round("mean", 4), "std": F.round("std", 4)})


@query("describe_percentiles", "SELECT l_returnflag, count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std, min(l_extendedprice) AS min, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90, round(quantile_cont(l_extendedprice, 0.95), 4) AS p95, round(quantile_cont(l_extendedprice, 0.99), 4) AS p99, max(l_extendedprice) AS max FROM lineitem GROUP BY l_returnflag")
def describe_percentiles(spark, sf_dir):
    got = audit.describe(table(spark, sf_dir, "lineitem"), "l_extendedprice", by=["l_returnflag"])
    return got.withColumns({c: F.round(c, 4) for c in ("mean", "std", "p50", "p90", "p95", "p99")})


@query("iqr_outliers", "WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.75) AS b FROM orders) SELECT o_orderkey, coalesce(b > a AND (o_totalprice < a - 0.3 * (b - a) OR o_totalprice > b + 0.3 * (b - a)), false) AS outlier FROM orders, q")
def iqr_outliers(spark, sf_dir):
    return filters.iqr_outliers(table(spark, sf_dir, "orders"), "o_totalprice", 0.3).select("o_orderkey", "outlier")


PRED = "p AS (SELECT l_returnflag, l_shipmode_, l_extendedprice / 1000 AS truth, l_quantity * 1.4 + l_discount * 10 AS guess FROM (SELECT *, l_linenumber AS l_shipmode_ FROM lineitem))"


def _predictions(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linenumber", (F.col("l_extendedprice") / 1000).alias("truth"), (F.col("l_quantity") * 1.4 + F.col("l_discount") * 10).alias("guess"))


@query("regression_metrics", f"WITH {PRED} SELECT l_returnflag, count(*) AS n, round(sqrt(avg((guess - truth) ** 2)), 6) AS rmse, round(avg(abs(guess - truth)), 6) AS mae, round(quantile_cont(abs(guess - truth), 0.5), 6) AS medae, round(1 - sum((guess - truth) ** 2) / (var_pop(truth) * count(*)), 6) AS r2, round(100 * avg(abs(guess - truth) / greatest(abs(truth), 1e-6)), 4) AS mape, round(avg(guess - truth), 6) AS bias, round(quantile_cont(abs(guess - truth), 0.9), 6) AS p90, round(quantile_cont(abs(guess - truth), 0.95), 6) AS p95, round(max(abs(guess - truth)), 6) AS max_error FROM p GROUP BY l_returnflag")
def regression_metrics(spark, sf_dir):
    got = audit.regression_metrics(_predictions(spark, sf_dir), "truth", "guess", ["l_returnflag"])
    return got.select("l_returnflag", "n", *[F.round(c, 4 if c == "mape" else 6).alias(c) for c in ("rmse", "mae", "medae", "r2", "mape", "bias", "p90", "p95", "max_error")])


@query("error_by_segment", f"WITH {PRED} SELECT l_shipmode_ AS l_linenumber, count(*) AS n, round(avg(abs(guess - truth)), 6) AS mae, round(sqrt(avg((guess - truth) ** 2)), 6) AS rmse, round(avg(guess - truth), 6) AS bias, round(quantile_cont(abs(guess - truth), 0.95), 6) AS p95 FROM p GROUP BY 1 HAVING count(*) >= 50")
def error_by_segment(spark, sf_dir):
    return audit.error_by_group(_predictions(spark, sf_dir), "l_linenumber", "truth", "guess", 50).select("l_linenumber", "n", *[r6(c, c) for c in ("mae", "rmse", "bias", "p95")])


@query("speed_bins", "SELECT CASE WHEN l_quantity <= -0.1 THEN NULL WHEN l_quantity <= 20 THEN '0-20' WHEN l_quantity <= 40 THEN '20-40' WHEN l_quantity <= 60 THEN '40-60' WHEN l_quantity <= 90 THEN '60-90' ELSE '90+' END AS bin, count(*) AS n FROM lineitem GROUP BY 1")
def speed_bins(spark, sf_dir):
    v = F.col("l_quantity")
    bins = F.when(v <= -0.1, F.lit(None)).when(v <= 20, "0-20").when(v <= 40, "20-40").when(v <= 60, "40-60").when(v <= 90, "60-90").otherwise("90+")
    return table(spark, sf_dir, "lineitem").groupBy(bins.alias("bin")).agg(F.count("*").alias("n"))


@query("unpivot_axes", " UNION ALL ".join(f"SELECT l_orderkey, l_linenumber, '{v}' AS axis, {v} AS value FROM lineitem" for v in VARS))
def unpivot_axes(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *VARS).unpivot(["l_orderkey", "l_linenumber"], VARS, "axis", "value")


@query("pivot_metric", "SELECT o_orderpriority, " + ", ".join(f"round(avg(o_totalprice) FILTER (o_orderstatus = '{s}'), 4) AS {s}" for s in "FOP") + " FROM orders GROUP BY o_orderpriority")
def pivot_metric(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.round(F.avg("o_totalprice"), 4))


@query("union_by_name", "SELECT event_id, user_id, NULL::DOUBLE AS value, 'a' AS src FROM events WHERE event_type = 'click' UNION ALL BY NAME SELECT event_id, user_id, value, 'b' AS src FROM events WHERE event_type = 'view'")
def union_by_name(spark, sf_dir):
    e = events(spark, sf_dir)
    return filters.union_ledgers(e.where("event_type = 'click'").select("event_id", "user_id", F.lit("a").alias("src")), e.where("event_type = 'view'").select("event_id", "user_id", "value", F.lit("b").alias("src")))


@query("key_intersect", "SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders")
def key_intersect(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).intersect(table(spark, sf_dir, "orders").select("o_custkey"))


@query("key_union", "SELECT c_custkey AS k FROM customer UNION SELECT o_custkey FROM orders")
def key_union(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).union(table(spark, sf_dir, "orders").select("o_custkey")).distinct()


@query("key_difference", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def key_difference(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select("o_custkey"))


@query("merge_indicator", "WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS m FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) SELECT coalesce(a.k, b.k) AS k, n, m, CASE WHEN n IS NOT NULL AND m IS NOT NULL THEN 'both' WHEN n IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS _merge FROM a FULL JOIN b ON a.k = b.k")
def merge_indicator(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "k")
    return audit.merge_indicator(o.where("o_orderstatus = 'F'").groupBy("k").agg(F.count("*").alias("n")), o.where("o_orderstatus = 'P'").groupBy("k").agg(F.count("*").alias("m")), "k")


@query("status_counts", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def status_counts(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))


@query("duplicate_null_rows", "WITH s AS (SELECT user_id, event_type, CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_id % 5 END AS v FROM events), g AS (SELECT *, count(*) AS n FROM s GROUP BY ALL) SELECT sum(n - 1)::BIGINT AS duplicate_rows, coalesce(sum(n) FILTER (user_id IS NULL OR event_type IS NULL OR v IS NULL), 0)::BIGINT AS null_rows FROM g")
def duplicate_null_rows(spark, sf_dir):
    s = events(spark, sf_dir).select("user_id", "event_type", F.when(F.col("event_id") % 13 != 0, F.col("event_id") % 5).alias("v"))
    return audit.duplicate_and_null_rows(s)


@query("pearson_matrix", "SELECT a AS a, b AS b, round(r, 6) AS r FROM (SELECT " + ", ".join(f"corr({a}, {b}) AS c{i}{j}" for i, a in enumerate(VARS) for j, b in enumerate(VARS)) + " FROM lineitem) CROSS JOIN LATERAL (VALUES " + ", ".join(f"('{a}', '{b}', c{i}{j})" for i, a in enumerate(VARS) for j, b in enumerate(VARS)) + ") t(a, b, r)")
def pearson_matrix(spark, sf_dir):
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(a, b).alias("r")) for a in VARS for b in VARS])
    return table(spark, sf_dir, "lineitem").agg(rows.alias("m")).select(F.explode("m").alias("m")).select("m.a", "m.b", r6("m.r", "r"))


@query("spearman_target", "WITH s AS (SELECT l_quantity AS q, l_extendedprice AS p, l_discount AS d FROM lineitem), r AS (SELECT " + ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS r{c}" for c in "qpd") + " FROM s) SELECT 'l_quantity' AS feature, round(corr(rq, rp), 6) AS rho FROM r UNION ALL SELECT 'l_discount', round(corr(rd, rp), 6) FROM r")
def spearman_target(spark, sf_dir):
    return audit.spearman(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"], "l_extendedprice").select("feature", F.round("rho", 6).alias("rho"))


@query("composite_score", "WITH m AS (SELECT o_orderpriority AS k, avg(o_totalprice) AS a, stddev_pop(o_totalprice) AS s, count(*)::DOUBLE AS n FROM orders GROUP BY 1) SELECT k, round(0.5 * a / max(a) OVER () + 0.3 * (1 - s / max(s) OVER ()) + 0.2 * n / max(n) OVER (), 6) AS score FROM m")
def composite_score(spark, sf_dir):
    m = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("k")).agg(F.avg("o_totalprice").alias("a"), F.stddev_pop("o_totalprice").alias("s"), F.count("*").cast("double").alias("n"))
    return audit.composite_score(m, {"a": (0.5, True), "s": (0.3, False), "n": (0.2, True)}).select("k", r6("score", "score"))


# ------------------------------------------------------------------------------------------------ text, names, learning


@query("text_parse_fields", """SELECT event_id, CAST(regexp_extract(props, '"k": (\\d+)', 1) AS BIGINT) AS k FROM events""")
def text_parse_fields(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", F.regexp_extract("props", r'"k": (\d+)', 1).try_cast("bigint").alias("k"))


@query("key_extract", "SELECT event_id, 'UNIT' || lpad((user_id % 90)::VARCHAR, 3, '0') || '_' || (20240000 + event_id % 9999) AS key, lpad((user_id % 90)::VARCHAR, 2, '0') AS device FROM events")
def key_extract(spark, sf_dir):
    name = F.concat(F.lit("x_UNIT"), F.lpad((F.col("user_id") % 90).cast("string"), 3, "0"), F.lit("_"), (20240000 + F.col("event_id") % 9999).cast("string"), F.lit("_seg2.csv"))
    return events(spark, sf_dir).select("event_id", naming.file_key(name).alias("key"), naming.device_of(name).alias("device"))


@query("loose_numbers", "SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE event_id / 8 END AS v FROM events")
def loose_numbers(spark, sf_dir):
    t = F.when(F.col("event_id") % 4 == 3, F.lit("n/a")).otherwise(F.concat(F.lit(" "), F.replace((F.col("event_id") / 8).cast("string"), F.lit("."), F.lit(",")), F.lit(" ")))
    return events(spark, sf_dir).select("event_id", naming.loose_double(t).alias("v"))


@query("device_dimension_join", "SELECT s_suppkey, k1, k2, k4_mm, d1_m, coeff, s_mm, alphav FROM supplier JOIN (VALUES " + ", ".join(str((k, *d[1:])) for k, d in enumerate(network.DEVICES)) + ") d(i, k1, k2, k4_mm, d1_m, coeff, s_mm, alphav) ON s_suppkey % 4 = i")
def device_dimension_join(spark, sf_dir):
    names = F.array(*[F.lit(d[0]) for d in network.DEVICES])
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.get(names, (F.col("s_suppkey") % 4).cast("int")).alias("device"))
    return network.device_join(rows, network.device_registry(spark), "device").select("s_suppkey", *network.CONSTANTS)


@query("training_rows", "SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL AND l_tax IS NOT NULL AND l_linenumber <> 3")
def training_rows(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.when(F.col("l_linenumber") != 3, F.col("l_discount")).alias("l_discount"), "l_tax")
    return filters.training_rows(li, ["l_quantity", "l_discount", "missing"], "l_tax")


@query("group_folds", "WITH g AS (SELECT l_suppkey, (row_number() OVER (ORDER BY count(*) DESC, l_suppkey) - 1) % 10 AS lap FROM lineitem GROUP BY l_suppkey) SELECT l_orderkey, l_linenumber, l_suppkey, (CASE WHEN lap < 5 THEN lap ELSE 9 - lap END)::INTEGER AS fold FROM lineitem JOIN g USING (l_suppkey)")
def group_folds(spark, sf_dir):
    from terraline.operators import learning

    return learning.group_folds(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), "l_suppkey", 5)


@query("forest_cv")
def forest_cv(spark, sf_dir):
    from terraline.operators import learning

    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_discount", "l_tax", (F.col("l_extendedprice") / 1000).alias("price"))
    return learning.cross_validate(li, ["l_quantity", "l_discount", "l_tax"], "price", learning.Run("random_forest", {"numTrees": 10, "maxDepth": 5}), groups="l_suppkey", folds=3)


@query("extra_trees_cv")
def extra_trees_cv(spark, sf_dir):
    from terraline.operators import learning

    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_discount", "l_tax", (F.col("l_extendedprice") / 1000).alias("price"))
    return learning.cross_validate(li, ["l_quantity", "l_discount", "l_tax"], "price", learning.Run("extra_trees", {"numTrees": 5, "maxDepth": 5}), groups="l_suppkey", folds=3)


_STEP = "greatest(x - x % 86400 + c + CASE WHEN x - x % 86400 + c < x - 43200 THEN 86400 ELSE 0 END, x + 1)"


@query(
    "clock_fold",
    f"""WITH RECURSIVE e AS (SELECT user_id, event_id, CASE WHEN event_type = 'click' THEN event_id * 3607 % 86400 END AS c FROM events),
p AS (SELECT *, count(c) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pos FROM e),
m AS (SELECT user_id, pos, c FROM p WHERE c IS NOT NULL),
f AS (SELECT user_id, pos, {_STEP} AS t FROM (SELECT *, 1700000000 AS x FROM m WHERE pos = 0)
  UNION ALL SELECT user_id, pos, {_STEP} AS t FROM (SELECT m.user_id, m.pos, m.c, f.t AS x FROM f JOIN m ON m.user_id = f.user_id AND m.pos = f.pos + 1)),
d AS (SELECT user_id, event_id, pos, row_number() OVER (PARTITION BY user_id, pos ORDER BY event_id) AS i, count(*) OVER (PARTITION BY user_id, pos) AS n FROM p WHERE c IS NULL)
SELECT d.user_id, event_id, (coalesce(f.t, 1700000000) * 1000000 + round_even(i * (1.0::DOUBLE / n) * 1e6, 0)::BIGINT)::BIGINT AS t_us FROM d LEFT JOIN f ON f.user_id = d.user_id AND f.pos = d.pos - 1""",
)
def clock_fold(spark, sf_dir):
    """Clicks are clock markers, other events the samples between them."""
    clock = F.when(F.col("event_type") == "click", F.col("event_id") * 3607 % 86400)
    e = events(spark, sf_dir).select("user_id", "event_id", clock.alias("c"), F.lit(1_700_000_000).cast("long").alias("anchor"))
    return ordered.clock_rows(e, ["user_id"], ["event_id"], "anchor", "c").select("user_id", "event_id", "t_us")
