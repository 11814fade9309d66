"""Queries of the report, feed and coverage operators on the driver's tables, each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraline.functions import stability
from terraline.operators import elevation, filters, learning, spatial
from terraline.plans import routes
from terraline.plans.streams import in_time, run
from terraline.plans.telemetry import FIXES, HOUR_US, events, fixes, query, r6
from terraline.sources import network, stages
from terraline.sources.tables import table
from terraline.streaming import operators as streaming


@query("quality_classes", """SELECT l_orderkey, l_linenumber, CASE WHEN l_tax <= 0.05 AND 1 - l_discount * 3 >= 0.9 THEN 'COINCIDEN BIEN' WHEN l_tax <= 0.1 AND 1 - l_discount * 3 >= 0.85 THEN 'COINCIDENCIA ACEPTABLE'
  WHEN l_tax <= 0.2 AND 1 - l_discount * 3 >= 0.7 THEN 'COINCIDENCIA MODERADA' ELSE 'NO COINCIDEN BIEN' END AS quality FROM lineitem""")
def quality_classes(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", stability.quality_class(F.col("l_tax"), 1 - F.col("l_discount") * 3).alias("quality"))


@query("acceleration", f"WITH {FIXES} SELECT event_id, round(sqrt((x / 100) ** 2 + (y / 100) ** 2 + (alt / 100) ** 2), 6) AS a FROM fixes")
def acceleration(spark, sf_dir):
    return fixes(spark, sf_dir).select("event_id", r6(stability.acceleration(F.col("x") / 100, F.col("y") / 100, F.col("alt") / 100), "a"))


@query("hover_texts", "SELECT o_orderkey, concat_ws('<br>', 'o_custkey: ' || o_custkey, CASE WHEN o_orderkey % 3 > 0 THEN 'rest: ' || o_orderkey % 3 END, 'o_orderstatus: ' || o_orderstatus) AS hover FROM orders")
def hover_texts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("rest", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderkey") % 3))
    return orders.select("o_orderkey", stages.hover_text({"o_custkey": "%d", "rest": "%d", "o_orderstatus": "%s"}).alias("hover"))


@query("colored_route", f"""WITH {FIXES}, m AS (SELECT user_id, event_id // 40 AS t, avg(lat) AS lat, avg(lon) AS lon, avg(hdop / 6) AS si FROM fixes GROUP BY 1, 2)
SELECT user_id, t, round(lat, 6) AS lat, round(lon, 6) AS lon, round(si, 6) AS si, CASE WHEN si < 0.7 THEN 'CRITICAL' WHEN si < 0.9 THEN 'HIGH' WHEN si < 1 THEN 'MEDIUM' ELSE 'LOW' END AS color,
  lag(t) OVER w IS NULL AS is_start, lead(t) OVER w IS NULL AS is_end FROM m WINDOW w AS (PARTITION BY user_id ORDER BY t)""")
def colored_route(spark, sf_dir):
    rows = fixes(spark, sf_dir).select("user_id", F.floor(F.col("event_id") / 40).alias("t"), "lat", "lon", (F.col("hdop") / 6).alias("si"))
    out = stages.colored_route(rows, ["user_id"], ["t"], "si", stability.risk_class(F.col("si")))
    return out.select("user_id", "t", r6("lat", "lat"), r6("lon", "lon"), r6("si", "si"), "color", "is_start", "is_end")


@query("merge_timelines", "SELECT event_id, ts, CASE WHEN event_type = 'click' THEN user_id END AS user_id, CASE WHEN event_type <> 'click' THEN value END AS value, CASE WHEN event_type = 'click' THEN 'gps' ELSE 'imu' END AS origin FROM events")
def merge_timelines(spark, sf_dir):
    e = events(spark, sf_dir)
    return routes.merge_timelines(e.where("event_type = 'click'").select("event_id", "ts", "user_id"), e.where("event_type <> 'click'").select("event_id", "ts", "value"), "ts")


@query("ground_truth", f"WITH {FIXES} SELECT event_id, value AS si_real, round(abs(tan(radians(event_id % 30))) / tan(radians(33.79)), 6) AS si_static, round(value - abs(tan(radians(event_id % 30))) / tan(radians(33.79)), 6) AS delta_si FROM fixes")
def ground_truth(spark, sf_dir):
    rows = fixes(spark, sf_dir).select("event_id", "value", (F.col("event_id") % 30).cast("double").alias("roll"))
    return routes.ground_truth(rows, "value", "roll", 33.79).select("event_id", "si_real", r6("si_static", "si_static"), r6("delta_si", "delta_si"))


@query("coverage_info", f"WITH {FIXES} SELECT floor(x / 100)::BIGINT AS tile, count(*) AS n_points, (max(x) - min(x)) * (max(y) - min(y)) AS area_m2 FROM fixes GROUP BY 1")
def coverage_info(spark, sf_dir):
    return elevation.coverage_info(fixes(spark, sf_dir).select(F.floor(F.col("x") / 100).alias("tile"), "x", "y"))


@query("tile_index", "SELECT (200 + p_partkey % 50)::INTEGER AS tx, (4100 + p_partkey % 40)::INTEGER AS ty, 'a/PNOA_' || (200 + p_partkey % 50) || '-' || (4100 + p_partkey % 40) || '_' || p_partkey || '.laz' AS path FROM part WHERE p_partkey % 5 > 0")
def tile_index(spark, sf_dir):
    k = F.col("p_partkey")
    name = F.when(k % 5 > 0, F.concat(F.lit("a/PNOA_"), (200 + k % 50).cast("string"), F.lit("-"), (4100 + k % 40).cast("string"), F.lit("_"), k.cast("string"), F.lit(".laz"))).otherwise(F.lit("a/notes.txt"))
    return network.tile_index(table(spark, sf_dir, "part").select(name.alias("path")))


@query("distinct_tiles", f"WITH {FIXES}, a AS (SELECT unnest(range(floor((x - 60) / 100)::INT, floor((x + 60) / 100)::INT + 1)) AS tx, y FROM fixes) SELECT DISTINCT tx::INTEGER AS tx, unnest(range(floor((y - 60) / 100)::INT + 1, floor((y + 60) / 100)::INT + 2))::INTEGER AS ty FROM a")
def distinct_tiles(spark, sf_dir):
    tx, ty = spatial.tile_keys(F.col("x"), F.col("y"), 60.0, 100.0)
    rows = fixes(spark, sf_dir).select("x", "y", F.col("x").alias("_x")).select("*", F.explode(tx).alias("tx")).select("*", F.explode(ty).alias("ty"))
    return filters.without_internal(rows).select("tx", "ty").distinct()


@query("fold_summary", """SELECT l_linenumber AS model, round(avg(l_discount), 6) AS r2_mean, round(stddev_pop(l_discount), 6) AS r2_std, min(l_discount) AS r2_min, max(l_discount) AS r2_max, round(avg(l_tax), 6) AS rmse_mean, round(avg(l_quantity), 6) AS mae_mean FROM lineitem GROUP BY 1""")
def fold_summary(spark, sf_dir):
    metrics = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("model"), F.col("l_discount").alias("r2"), F.col("l_tax").alias("rmse"), F.col("l_quantity").alias("mae"))
    return learning.fold_summary(metrics, ["model"]).select("model", r6("r2_mean", "r2_mean"), r6("r2_std", "r2_std"), "r2_min", "r2_max", r6("rmse_mean", "rmse_mean"), r6("mae_mean", "mae_mean"))


@query("stream_sessions", f"""WITH g AS (SELECT user_id, ts, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT user_id, ts, event_id,
  CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) >= 12 * {HOUR_US} THEN 1 ELSE 0 END AS brk FROM events))
SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 12 * {HOUR_US} AS end_us, count(*) AS n FROM g GROUP BY user_id, s""")
def stream_sessions(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    last = rows.agg(F.max("user_id")).first()[0]
    got = run(spark, lambda: streaming.gap_sessions(in_time(rows, "ts"), "user_id", "ts", "12 hours", "1 hour"))
    us = lambda c: F.unix_micros(F.col(c)).alias(f"{c}_us")
    return got.where(F.col("user_id") <= F.lit(last)).select("user_id", us("start"), us("end"), "n")
