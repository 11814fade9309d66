"""Queries of the motion, matching and report operators on the driver's tables, each with its DuckDB oracle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from terraline.functions import stability
from terraline.operators import filters, kinematics, learning, ordered, spatial
from terraline.plans import routes
from terraline.plans.telemetry import FIXES, fixes, query, r6
from terraline.sources.tables import table


@query("user_predicate", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_quantity > 10 AND abs(l_discount - 0.05) < 0.02) OR l_linenumber = 3")
def user_predicate(spark, sf_dir):
    return filters.where_text(table(spark, sf_dir, "lineitem"), "(l_quantity > 10 & abs(l_discount - 0.05) < 0.02) or l_linenumber == 3").select("l_orderkey", "l_linenumber")


@query("user_conditions", """SELECT 'lists' AS predicate, l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag IN ('A', 'N') AND NOT (l_linestatus = 'F') AND l_linenumber NOT IN (1, 2)
UNION ALL SELECT 'chains', l_orderkey, l_linenumber FROM lineitem WHERE 10 < l_quantity AND l_quantity <= 20 AND l_quantity % 2 = 0
UNION ALL SELECT 'quoted', l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'A&B' OR (l_linenumber = 7 AND l_quantity > 30)""")
def user_conditions(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    texts = {
        "lists": "l_returnflag in ['A', 'N'] & ~(l_linestatus == 'F') & l_linenumber not in [1, 2]",
        "chains": "10 < l_quantity <= 20 and `l_quantity` % 2 == 0", "quoted": "l_returnflag == 'A&B' | (l_linenumber == 7 & l_quantity > 30)",
    }
    parts = [filters.where_text(df, text).select(F.lit(name).alias("predicate"), "l_orderkey", "l_linenumber") for name, text in texts.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("mixed_sort", "SELECT o_orderpriority, o_orderstatus, o_custkey, n, row_number() OVER (ORDER BY o_orderpriority, n DESC, o_orderstatus, o_custkey) - 1 AS place FROM (SELECT o_orderpriority, o_orderstatus, o_custkey, count(*) AS n FROM orders GROUP BY 1, 2, 3)")
def mixed_sort(spark, sf_dir):
    """A sort in mixed directions, with each row's place, and no task that holds all rows."""
    counts = table(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderstatus", "o_custkey").agg(F.count("*").alias("n")).withColumn("__all", F.lit(0))
    return ordered.numbered(counts, "__all", ["o_orderpriority", F.desc("n"), "o_orderstatus", "o_custkey"], "place").drop("__all")


@query("ekf_track")
def ekf_track(spark, sf_dir):
    """The filter over each user's fixes in UTM coordinates, a minute apart; every fifth lacks a position, every seventh a speed."""
    e = F.col("event_id")
    rows = fixes(spark, sf_dir).select("user_id", (F.col("event_id") * 60.0).alias("t"), F.when(e % 5 != 0, 440000 + F.col("x")).alias("x"), (4475000 + F.col("y")).alias("y"), F.when(e % 7 != 0, F.col("speed_kmh") / 3.6).alias("v"), "hdop", F.lit(0.0).alias("a"), F.lit(0.0).alias("w"))
    return kinematics.kalman_track(rows, "user_id", "t", "x", "y", "v", "hdop", "a", "w")


_H = "2 * 6371000.0 * asin(sqrt(least(1.0, sin(radians(nlat - lat) / 2) ** 2 + cos(radians(lat)) * cos(radians(nlat)) * sin(radians(nlon - lon) / 2) ** 2)))"
_NODES = """n AS (SELECT c_custkey AS nid, CASE WHEN c_custkey % 2 = 0 THEN 40 + degrees((100 + c_custkey / 2000) / 6371000.0) ELSE 40 END AS nlat, CASE WHEN c_custkey % 2 = 0 THEN -3 ELSE -3 + degrees((99.8 + c_custkey / 2000) / 6371000.0 / cos(radians(40))) END AS nlon FROM customer)"""


@query("snap_near_ties", f"""WITH p AS (SELECT s_suppkey AS pid, 40 + s_suppkey % 7 / 1e6 AS lat, -3 + s_suppkey % 5 / 1e6 AS lon FROM supplier), {_NODES},
b AS (SELECT pid, {_H} AS d FROM p, n) SELECT pid, round(min(d), 4) AS distance_correction_m, min(d) <= 100 AS matched_on_road FROM b GROUP BY pid""")
def snap_near_ties(spark, sf_dir):
    """Nodes due north and due east of the points, all within half a percent of each other's distance: only the haversine tells which is nearest."""
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    points = table(spark, sf_dir, "supplier").select(s.alias("pid"), (40 + s % 7 / 1e6).alias("lat"), (-3 + s % 5 / 1e6).alias("lon"))
    north, east = F.degrees((100 + c / 2000) / 6371000.0), F.degrees((99.8 + c / 2000) / 6371000.0 / F.cos(F.radians(F.lit(40.0))))
    nodes = table(spark, sf_dir, "customer").select(c.alias("nid"), F.when(c % 2 == 0, 40 + north).otherwise(F.lit(40.0)).alias("lat"), F.when(c % 2 == 0, F.lit(-3.0)).otherwise(-3 + east).alias("lon"))
    out = spatial.snap_trajectory(points, nodes, "pid", "nid", "lat", "lon", 100.0)
    return out.select("pid", F.round("distance_correction_m", 4).alias("distance_correction_m"), "matched_on_road")


@query("audit_drops", f"WITH {FIXES} SELECT event_id, lat, lon * 30 AS lon FROM fixes WHERE fix = 0 AND lon * 30 BETWEEN -180 AND 180")
def audit_drops(spark, sf_dir):
    reason = F.when(F.col("fix") == 0, "gps_fix").when(F.col("hdop") > 5, "IMU spike")
    return filters.audit_drops(fixes(spark, sf_dir).select("event_id", reason.alias("reason"), "lat", (F.col("lon") * 30).alias("lon")), "reason", prefix="gps_", lat="lat", lon="lon").drop("reason")


@query("trip_centre", f"WITH {FIXES} SELECT user_id, count(*) AS n_points, min(value) AS si_min, max(value) AS si_max, round(avg(lat), 6) AS centre_lat, round(avg(lon), 6) AS centre_lon FROM fixes GROUP BY user_id")
def trip_centre(spark, sf_dir):
    return routes.trip_centre(fixes(spark, sf_dir), ["user_id"], "value").select("user_id", "n_points", "si_min", "si_max", r6("centre_lat", "centre_lat"), r6("centre_lon", "centre_lon"))


@query("legend_counts", f"WITH {FIXES}, r AS (SELECT CASE WHEN hdop / 6 < 0.7 THEN 'CRITICAL' WHEN hdop / 6 < 0.9 THEN 'HIGH' WHEN hdop / 6 < 1 THEN 'MEDIUM' ELSE 'LOW' END AS risk FROM fixes) SELECT risk, count(*) AS n, round(100 * count(*) / (SELECT count(*) FROM r), 6) AS percent FROM r GROUP BY risk")
def legend_counts(spark, sf_dir):
    return routes.legend_counts(fixes(spark, sf_dir).select(stability.risk_class(F.col("hdop") / 6).alias("risk")), "risk").select("risk", "n", r6("percent", "percent"))


@query("feature_crosses", f"WITH {FIXES} SELECT event_id, round(speed_kmh * hdop, 6) AS speed_x_phi, round(speed_kmh * speed_kmh, 6) AS speed_sq FROM fixes")
def feature_crosses(spark, sf_dir):
    return kinematics.feature_crosses(fixes(spark, sf_dir), "speed_kmh", "hdop").select("event_id", r6("speed_x_phi", "speed_x_phi"), r6("speed_sq", "speed_sq"))


@query("signal_gradient", f"""WITH {FIXES}, w AS (SELECT event_id, user_id, alt, lag(alt) OVER u AS b, lead(alt) OVER u AS a FROM fixes WINDOW u AS (PARTITION BY user_id ORDER BY event_id)),
g AS (SELECT *, CASE WHEN b IS NULL THEN a - alt WHEN a IS NULL THEN alt - b ELSE (a - b) / 2 END AS d FROM w)
SELECT event_id, round(d, 6) AS d, round(sum(d) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5, 6) AS smooth FROM g""")
def signal_gradient(spark, sf_dir):
    g = kinematics.gradient(fixes(spark, sf_dir).select("event_id", "user_id", "alt"), ["user_id"], ["event_id"], "alt", "d")
    return kinematics.centred_mean(g, ["user_id"], ["event_id"], "d", "smooth").select("event_id", r6("d", "d"), r6("smooth", "smooth"))


@query("absolute_imu_time", "SELECT event_id, epoch_us(ts) + event_id * 1500 AS t_us, round(event_id % 1000 * pi() / 180000, 9) AS omega FROM events")
def absolute_imu_time(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    t = F.unix_micros(kinematics.absolute_time(F.col("ts"), F.col("event_id") * 1500).cast("timestamp"))
    return e.select("event_id", t.alias("t_us"), F.round(kinematics.gyro_rad_s(F.col("event_id") % 1000), 9).alias("omega"))




@query("snap_trajectory", f"""WITH p AS (SELECT s_suppkey AS pid, CASE WHEN s_suppkey % 10 <> 0 THEN 40 + s_suppkey * 7919 % 1000 / 20000 END AS lat, -3 + s_suppkey * 6101 % 1000 / 20000 AS lon FROM supplier),
n AS (SELECT c_custkey AS nid, 40 + c_custkey * 4099 % 9973 / 199460 AS nlat, -3 + c_custkey * 5303 % 9967 / 199340 AS nlon FROM customer),
b AS (SELECT pid, lat, lon, nlat, nlon, {_H} AS d FROM p, n WHERE lat IS NOT NULL QUALIFY row_number() OVER (PARTITION BY pid ORDER BY d, nid) = 1)
SELECT p.pid, round(coalesce(nlat, p.lat), 7) AS lat_corrected, round(coalesce(nlon, p.lon), 7) AS lon_corrected, coalesce(d <= 50, false) AS matched_on_road, round(d, 4) AS distance_correction_m FROM p LEFT JOIN b ON b.pid = p.pid""")
def snap_trajectory(spark, sf_dir):
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    points = table(spark, sf_dir, "supplier").select(s.alias("pid"), F.when(s % 10 != 0, 40 + s * 7919 % 1000 / 20000).alias("lat"), (-3 + s * 6101 % 1000 / 20000).alias("lon"))
    nodes = table(spark, sf_dir, "customer").select(c.alias("nid"), (40 + c * 4099 % 9973 / 199460).alias("lat"), (-3 + c * 5303 % 9967 / 199340).alias("lon"))
    out = spatial.snap_trajectory(points, nodes, "pid", "nid", "lat", "lon", 50.0)
    return out.select("pid", F.round("lat_corrected", 7).alias("lat_corrected"), F.round("lon_corrected", 7).alias("lon_corrected"), "matched_on_road", F.round("distance_correction_m", 4).alias("distance_correction_m"))


@query("patch_fall_back", """WITH p AS (SELECT s_suppkey AS pid, (s_suppkey * 53 % 1000)::DOUBLE AS x, (s_suppkey * 29 % 1000)::DOUBLE AS y FROM supplier), o AS (SELECT (event_id * 37 % 1000)::DOUBLE AS ox, (event_id * 91 % 1000)::DOUBLE AS oy, value AS oz FROM events WHERE event_type = 'click' AND event_id * 37 % 1000 < 400),
r AS (SELECT (p_partkey % 50 * 20)::DOUBLE AS ox, (p_partkey // 50 * 20)::DOUBLE AS oy, CASE WHEN p_partkey % 7 > 0 THEN p_partkey::DOUBLE END AS oz FROM part),
a AS (SELECT pid, ox, oy, oz, 'cloud' AS origin FROM p JOIN o ON sqrt((ox - x) ** 2 + (oy - y) ** 2) <= 15),
b AS (SELECT pid, ox, oy, oz, 'raster' AS origin FROM p JOIN r ON abs(ox - x) <= 15 AND abs(oy - y) <= 15 WHERE oz IS NOT NULL AND pid NOT IN (SELECT pid FROM a))
SELECT * FROM a UNION ALL SELECT * FROM b""")
def patch_fall_back(spark, sf_dir):
    s, e, p = F.col("s_suppkey"), F.col("event_id"), F.col("p_partkey")
    points = table(spark, sf_dir, "supplier").select(s.alias("pid"), (s * 53 % 1000).cast("double").alias("x"), (s * 29 % 1000).cast("double").alias("y"))
    cloud = table(spark, sf_dir, "events").where((F.col("event_type") == "click") & (e * 37 % 1000 < 400)).select((e * 37 % 1000).cast("double").alias("ox"), (e * 91 % 1000).cast("double").alias("oy"), F.col("value").alias("oz"))
    raster = table(spark, sf_dir, "part").select((p % 50 * 20).cast("double").alias("ox"), (F.floor(p / 50) * 20).cast("double").alias("oy"), F.when(p % 7 > 0, p.cast("double")).alias("oz"))
    return spatial.patches_with_fall_back(points, cloud, raster, "pid", 15.0)


@query("device_averages", "SELECT c_nationkey AS device, count(*) AS models, round(avg(c_acctbal / 10000), 6) AS avg_r2, round(avg(c_custkey / 1000), 6) AS avg_rmse, count(*) FILTER (c_acctbal / 10000 >= 0.7) AS on_target FROM customer GROUP BY 1")
def device_averages(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("device"), (F.col("c_acctbal") / 10000).alias("holdout_r2"), (F.col("c_custkey") / 1000).alias("rmse"))
    return learning.device_averages(c).select("device", "models", r6("avg_r2", "avg_r2"), r6("avg_rmse", "avg_rmse"), "on_target")


@query("holdout_residuals", "SELECT l_orderkey, l_linenumber, l_extendedprice - 1500 * l_quantity AS residual FROM lineitem")
def holdout_residuals(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("prediction", 1500 * F.col("l_quantity"))
    return learning.holdout_table(li, "l_extendedprice").select("l_orderkey", "l_linenumber", "residual")
