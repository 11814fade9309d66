"""Queries of the telemetry operators on the driver's tables, each with its DuckDB oracle.

Roles: user_id is the device, ts the time, event_id the line, value the signal. Coordinates and quality fields are integers of
event_id, so both engines compute the same numbers; doubles are rounded to six places on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraline.functions import stability
from terraline.operators import asof, audit, filters, ordered
from terraline.sources.tables import table

HOUR_US = 3_600_000_000
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def r6(c, name: str):
    return F.round(c if not isinstance(c, str) else F.col(c), 6).alias(name)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as position fixes."""
    e = F.col("event_id")
    return events(spark, sf_dir).select(
        "event_id", "user_id", "ts", "value", ((e * 37) % 1000).cast("double").alias("x"), ((e * 91) % 1000).cast("double").alias("y"), ((e % 80) / 10).alias("hdop"),
        F.when(e % 7 == 0, 0).otherwise(1).alias("fix"), (3 + e % 9).alias("numsats"), (34 + (e % 130) / 10).alias("lat"), (-5 + (e % 60) / 10).alias("lon"), ((e % 400) * 10.0 - 50).alias("alt"), (F.col("value") * 3).alias("speed_kmh"),
    )


FIXES = """fixes AS (SELECT event_id, user_id, ts, value, ((event_id * 37) % 1000)::DOUBLE AS x, ((event_id * 91) % 1000)::DOUBLE AS y, (event_id % 80) / 10 AS hdop,
  CASE WHEN event_id % 7 = 0 THEN 0 ELSE 1 END AS fix, 3 + event_id % 9 AS numsats, 34 + (event_id % 130) / 10 AS lat, -5 + (event_id % 60) / 10 AS lon,
  (event_id % 400) * 10.0 - 50 AS alt, value * 3 AS speed_kmh FROM events)"""

ASOF = """l AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'click'),
r0 AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'view'),
r AS (SELECT * FROM r0 QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1),
b AS (SELECT l.event_id, l.user_id, l.ts, l.value, r.ts AS bt, r.event_id AS bi, r.value AS bv FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts),
f AS (SELECT b.*, r.ts AS ft, r.event_id AS fi, r.value AS fv FROM b ASOF LEFT JOIN r ON b.user_id = r.user_id AND b.ts <= r.ts),
d AS (SELECT *, epoch_us(ts) - epoch_us(bt) AS db, epoch_us(ft) - epoch_us(ts) AS df FROM f),
m AS (SELECT event_id, user_id, ts, value, CASE WHEN bt IS NOT NULL AND (ft IS NULL OR db <= df) THEN bi ELSE fi END AS ri,
  CASE WHEN bt IS NOT NULL AND (ft IS NULL OR db <= df) THEN bv ELSE fv END AS rv, CASE WHEN bt IS NOT NULL AND (ft IS NULL OR db <= df) THEN db ELSE df END AS gap FROM d)"""


def _streams(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", "user_id", "ts", "value", "event_type")
    return e.where("event_type = 'click'").drop("event_type"), e.where("event_type = 'view'").drop("event_type")


@query("asof_nearest_tolerance", f"WITH {ASOF} SELECT event_id, user_id, value, ri AS event_id_r, rv AS value_r FROM m WHERE gap <= 6 * {HOUR_US}")
def asof_nearest_tolerance(spark, sf_dir):
    left, right = _streams(spark, sf_dir)
    return asof.nearest_asof(left, right, ["user_id"], "ts", 6 * HOUR_US, ["event_id", "value"], "event_id").select("event_id", "user_id", "value", "event_id_r", "value_r")


@query("asof_left_fill", f"WITH {ASOF} SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 AND gap <= 24 * {HOUR_US} THEN rv WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value FROM m")
def asof_left_fill(spark, sf_dir):
    left, right = _streams(spark, sf_dir)
    left = left.withColumn("value", F.when(F.col("event_id") % 3 != 0, F.col("value")))
    return asof.fill_from(asof.nearest_asof(left, right, ["user_id"], "ts", 24 * HOUR_US, ["value"], "event_id", how="left"), ["value"]).select("event_id", "user_id", "value")


@query("asof_mean_by_key", f"WITH {ASOF} SELECT user_id, count(*) AS n, round(avg(rv), 6) AS mean_value FROM m WHERE gap <= 6 * {HOUR_US} GROUP BY user_id")
def asof_mean_by_key(spark, sf_dir):
    left, right = _streams(spark, sf_dir)
    return asof.nearest_asof(left, right, ["user_id"], "ts", 6 * HOUR_US, ["value"], "event_id").groupBy("user_id").agg(F.count("*").alias("n"), r6(F.avg("value_r"), "mean_value"))


REASONS = """tagged AS (SELECT *, CASE WHEN NOT coalesce(lat BETWEEN 35 AND 45 AND lon BETWEEN -10 AND 5, false) THEN 'gps_invalid_lat_lon'
  WHEN NOT coalesce(alt > 0 AND alt < 3000, false) THEN 'gps_invalid_altitude' WHEN speed_kmh < 0 OR speed_kmh > 200 THEN 'gps_invalid_speed'
  WHEN hdop > 5 THEN 'gps_hdop_gt_5.0' WHEN fix < 1 THEN 'gps_fix_lt_1' WHEN numsats < 4 THEN 'gps_satellites_lt_4' END AS drop_reason FROM fixes)"""


def _tagged(spark, sf_dir):
    return filters.tag(fixes(spark, sf_dir), filters.gps_rules())


@query("quality_filters", f"WITH {FIXES}, {REASONS} SELECT event_id, user_id, lat, lon, alt FROM tagged WHERE drop_reason IS NULL")
def quality_filters(spark, sf_dir):
    return filters.kept(_tagged(spark, sf_dir)).select("event_id", "user_id", "lat", "lon", "alt")


@query("drop_ledger", f"WITH {FIXES}, {REASONS} SELECT user_id::VARCHAR AS source_key, 'gps' AS stage, drop_reason AS reason, event_id, alt, hdop FROM tagged WHERE drop_reason IS NOT NULL")
def drop_ledger(spark, sf_dir):
    return filters.drop_ledger(filters.dropped(_tagged(spark, sf_dir)), "gps", "user_id").select("source_key", "stage", "reason", "event_id", "alt", "hdop")


_STEP_SQL = " UNION ALL ".join(
    f"SELECT {i + 1} AS step, '{n}' AS filter_name, n - ({' + '.join(['0', *[f'd{j}' for j in range(i)]])}) AS before_rows, d{i} AS dropped_rows, n - ({' + '.join([f'd{j}' for j in range(i + 1)])}) AS after_rows FROM c"
    for i, n in enumerate(["gps_invalid_lat_lon", "gps_invalid_altitude", "gps_invalid_speed", "gps_hdop_gt_5.0", "gps_fix_lt_1", "gps_satellites_lt_4"])
)


@query("filter_steps", f"WITH {FIXES}, {REASONS}, c AS (SELECT count(*) AS n, " + ", ".join(f"count(*) FILTER (drop_reason = '{n}') AS d{i}" for i, n in enumerate(["gps_invalid_lat_lon", "gps_invalid_altitude", "gps_invalid_speed", "gps_hdop_gt_5.0", "gps_fix_lt_1", "gps_satellites_lt_4"])) + f" FROM tagged) {_STEP_SQL}")
def filter_steps(spark, sf_dir):
    return filters.filter_steps(_tagged(spark, sf_dir), filters.gps_rules())


@query("drop_summary", f"WITH {FIXES}, {REASONS} SELECT 'gps' AS stage, drop_reason AS reason, count(*) AS dropped_rows, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM tagged WHERE drop_reason IS NOT NULL GROUP BY drop_reason")
def drop_summary(spark, sf_dir):
    ledger = filters.drop_ledger(filters.dropped(_tagged(spark, sf_dir)), "gps", "user_id")
    return filters.drop_summary(ledger).withColumn("pct", F.round("pct", 6))


@query("drop_observed_range", f"WITH {FIXES}, {REASONS} SELECT drop_reason AS reason, count(*) AS n, '[' || printf('%.4f', min(alt)) || ', ' || printf('%.4f', max(alt)) || ']' AS observed FROM tagged WHERE drop_reason IS NOT NULL GROUP BY drop_reason")
def drop_observed_range(spark, sf_dir):
    return filters.observed_range(filters.drop_ledger(filters.dropped(_tagged(spark, sf_dir)), "gps", "user_id"), "alt")


@query("jump_filter", f"WITH {FIXES}, d AS (SELECT *, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS a, sqrt((x - lead(x) OVER w) ** 2 + (y - lead(y) OVER w) ** 2) AS b FROM fixes WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) SELECT event_id, user_id, x, y FROM d WHERE NOT (coalesce(a > 400, false) OR coalesce(b > 400, false))")
def jump_filter(spark, sf_dir):
    return filters.kept(filters.jump_filter(fixes(spark, sf_dir), ["user_id"], ["event_id"], "x", "y", 400.0)).select("event_id", "user_id", "x", "y")


_NEAR = " + ".join(f"coalesce((sqrt((x - {f}(x, {k}) OVER w) ** 2 + (y - {f}(y, {k}) OVER w) ** 2) <= 50)::INT, 0)" for f in ("lag", "lead") for k in (1, 2))


@query("isolated_filter", f"WITH {FIXES}, d AS (SELECT *, {_NEAR} AS near FROM fixes WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) SELECT event_id, user_id, x, y FROM d WHERE near >= 1")
def isolated_filter(spark, sf_dir):
    return filters.kept(filters.isolated_filter(fixes(spark, sf_dir), ["user_id"], ["event_id"], "x", "y")).select("event_id", "user_id", "x", "y")


_SEG = """cut AS (SELECT event_id, user_id, sum(coalesce({b}::INT, 0)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, {e} FROM {t} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))),
n AS (SELECT *, count(*) OVER (PARTITION BY user_id, g) AS n, max(g) OVER (PARTITION BY user_id) AS last FROM cut)
SELECT event_id, user_id, dense_rank() OVER (PARTITION BY user_id ORDER BY g) AS segment_id FROM n WHERE last = 0 OR n {op}"""


@query("gap_segments", "WITH " + _SEG.format(b="brk", e=f"epoch_us(ts) - epoch_us(lag(ts) OVER w) > 24 * {HOUR_US} AS brk", t="events", op="> 10"))
def gap_segments(spark, sf_dir):
    by, order = ["user_id"], ["ts", "event_id"]
    gap = F.timestamp_diff("MICROSECOND", F.lag("ts").over(ordered.gap_window(by, order)), F.col("ts")) > 24 * HOUR_US
    return ordered.split_segments(events(spark, sf_dir), by, order, gap).select("event_id", "user_id", "segment_id")


@query("distance_segments", f"WITH {FIXES}, " + _SEG.format(b="brk", e="sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) > 800 AS brk", t="fixes", op=">= 5"))
def distance_segments(spark, sf_dir):
    by, order = ["user_id"], ["ts", "event_id"]
    return ordered.split_segments(fixes(spark, sf_dir), by, order, ordered.distance_break(by, order, "x", "y", 800.0), min_rows=5, inclusive=True).select("event_id", "user_id", "segment_id")


@query("step_distance", f"WITH {FIXES} SELECT event_id, round(sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2), 6) AS step_m FROM fixes WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")
def step_distance(spark, sf_dir):
    return ordered.step_distance(fixes(spark, sf_dir), ["user_id"], ["event_id"], "x", "y").select("event_id", r6("step_m", "step_m"))


_AXIS = """quantile_cont({c}, 0.25) OVER w AS q1_{c}, quantile_cont({c}, 0.5) OVER w AS q2_{c}, quantile_cont({c}, 0.75) OVER w AS q3_{c}, count({c}) OVER w AS n_{c}, mad({c}) OVER w AS mad_{c}"""
_FLAG = """coalesce(n_{c} >= 15 AND CASE WHEN q3_{c} - q1_{c} > 1e-6 THEN {c} < q1_{c} - 0.5 * (q3_{c} - q1_{c}) OR {c} > q3_{c} + 0.5 * (q3_{c} - q1_{c}) ELSE abs({c} - q2_{c}) > 6.0 * 1.4826 * mad_{c} END, false)"""


@query("rolling_iqr_outliers", f"WITH {FIXES}, s AS (SELECT event_id, user_id, ts, value AS a, x AS b, (event_id % 50 = 0)::INT::DOUBLE AS c FROM fixes), q AS (SELECT *, {', '.join(_AXIS.format(c=c) for c in 'abc')} FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING)), f AS (SELECT event_id, {', '.join(_FLAG.format(c=c) + f' AS f{c}' for c in 'abc')} FROM q) SELECT event_id, fa::INT + fb::INT + fc::INT AS flagged_axes_count, concat_ws('|', CASE WHEN fa THEN 'a' END, CASE WHEN fb THEN 'b' END, CASE WHEN fc THEN 'c' END) AS flagged_axes, fa::INT + fb::INT + fc::INT >= 2 AS outlier FROM f")
def rolling_iqr_outliers(spark, sf_dir):
    s = fixes(spark, sf_dir).select("event_id", "user_id", "ts", F.col("value").alias("a"), F.col("x").alias("b"), (F.col("event_id") % 50 == 0).cast("int").cast("double").alias("c"))
    return ordered.rolling_outliers(s, ["user_id"], ["ts", "event_id"], ["a", "b", "c"], iqr_k=0.5).select("event_id", "flagged_axes_count", "flagged_axes", "outlier")


@query("ring_mean", "SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) / 10, 6) AS ring_mean FROM events")
def ring_mean(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", r6(ordered.ring_mean(F.col("value"), ["user_id"], ["ts", "event_id"], 10), "ring_mean"))


_SI_CTE = """ring AS (SELECT event_id, user_id, value, (event_id % 200 - 100) * 1.0 AS ax, 1000.0 + event_id % 30 AS az, sum(value * 100) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) / 10 AS gym FROM events),
dev AS (SELECT * FROM (VALUES ('23', 1.15, 2.05, 1100.0, 2.03, 1.89, 2450.0, 54.0), ('24', 1.15, 2.0, 2500.0, 1.88, 5.00, 2215.0, 64.0), ('27', 1.50, 1.50, 1100.0, 0.96, 2.13, 1880.0, 45.0), ('28', 1.15, 2.05, 1100.0, 1.96, 1.86, 2200.0, 57.0)) t(device_id, k1, k2, k4_mm, d1_m, coeff, s_mm, alphav)),
joined AS (SELECT ring.*, dev.* FROM ring JOIN dev ON device_id = CASE user_id % 4 WHEN 0 THEN '23' WHEN 1 THEN '24' WHEN 2 THEN '27' ELSE '28' END),
terms AS (SELECT *, abs(atan(ax / az)) / atan((s_mm / 2) / sqrt((1000.0 * d1_m) ** 2 - (s_mm / 2) ** 2)) AS ta, (gym / (sqrt(coeff::DOUBLE * s_mm / 1000 * alphav / 4) * (360 / 6.28) * 1000)) ** 2 AS tb FROM joined),
si AS (SELECT *, 1 - k1 * ta - k2 * tb AS theory, 1 - 1.1 * ta - 2 * tb + (event_id % 7 - 3) * 0.01 AS measured FROM terms)"""


def _si(spark, sf_dir):
    from terraline.sources.network import device_join, device_registry

    e = F.col("event_id")
    d = F.when(F.col("user_id") % 4 == 0, "23").when(F.col("user_id") % 4 == 1, "24").when(F.col("user_id") % 4 == 2, "27").otherwise("28")
    s = events(spark, sf_dir).select("event_id", "user_id", "value", d.alias("device"), ((e % 200 - 100) * 1.0).alias("ax"), (1000.0 + e % 30).alias("az"), ordered.ring_mean(F.col("value") * 100, ["user_id"], ["ts", "event_id"], 10).alias("gym"))
    s = device_join(s, device_registry(spark), "device")
    one, zero = F.lit(1.0), F.lit(0.0)
    args = [F.col(c) for c in ("ax", "az", "gym")]
    rest = [F.col(c) for c in ("d1_m", "s_mm", "coeff", "alphav")]
    s = s.withColumn("ta", 1 - stability.si_theory(*args, one, zero, *rest)).withColumn("tb", 1 - stability.si_theory(*args, zero, one, *rest))
    s = s.withColumn("theory", stability.si_theory(*args, F.col("k1"), F.col("k2"), *rest))
    return s.withColumn("measured", 1 - 1.1 * F.col("ta") - 2 * F.col("tb") + (e % 7 - 3) * 0.01)


@query("si_theory", f"WITH {_SI_CTE} SELECT event_id, round(theory, 6) AS theory FROM si")
def si_theory(spark, sf_dir):
    return _si(spark, sf_dir).select("event_id", r6("theory", "theory"))


@query("si_compare_metrics", f"WITH {_SI_CTE} SELECT device_id, count(*) AS n, round(avg(abs(theory - measured)), 6) AS mae, round(sqrt(avg((theory - measured) ** 2)), 6) AS rmse, round(avg(theory - measured), 6) AS bias, round(corr(theory, measured), 6) AS r FROM si GROUP BY device_id")
def si_compare_metrics(spark, sf_dir):
    return audit.comparison_metrics(_si(spark, sf_dir).withColumnRenamed("device", "device_id"), "measured", "theory", ["device_id"]).select("device_id", "n", *[r6(c, c) for c in ("mae", "rmse", "bias", "r")])


@query("si_match_state", f"WITH {_SI_CTE} SELECT CASE WHEN event_id % 11 = 0 THEN 'missing' WHEN abs(measured - theory) <= 0.0200001 THEN 'match' ELSE 'mismatch' END AS state, count(*) AS n FROM si GROUP BY 1")
def si_match_state(spark, sf_dir):
    s = _si(spark, sf_dir).select(stability.match_state(F.when(F.col("event_id") % 11 != 0, F.col("measured")), F.col("theory"), 0.0200001).alias("state"))
    return s.groupBy("state").agg(F.count("*").alias("n"))


@query("k_least_squares", f"WITH {_SI_CTE}, s AS (SELECT sum(ta * ta) AS aa, sum(ta * tb) AS ab, sum(tb * tb) AS bb, sum(ta * (1 - measured)) AS ay, sum(tb * (1 - measured)) AS by_ FROM si) SELECT round((ay * bb - by_ * ab) / (aa * bb - ab * ab), 4) AS k1, round((by_ * aa - ay * ab) / (aa * bb - ab * ab), 4) AS k2 FROM s")
def k_least_squares(spark, sf_dir):
    got = audit.least_squares_2(_si(spark, sf_dir), 1 - F.col("measured"), F.col("ta"), F.col("tb"))
    return got.select(F.round("k1", 4).alias("k1"), F.round("k2", 4).alias("k2"))


@query("si_roll_classes", "WITH s AS (SELECT (event_id % 61) - 30 AS roll, (event_id % 41) - 20 AS ay FROM events), t AS (SELECT greatest(0.1, least(1.5, greatest(0.1, least(1.5, sin(radians(33.79) - radians(roll)) / sin(radians(33.79)))) + greatest(-1.0, least(1.0, (ay / 100 * 1.85) / (9.81 * 2.48 / 2))))) AS si FROM s) SELECT CASE WHEN si < 0.7 THEN 'CRITICAL' WHEN si < 0.9 THEN 'HIGH' WHEN si < 1.0 THEN 'MEDIUM' ELSE 'LOW' END AS risk, count(*) AS n, round(avg(si), 6) AS mean_si FROM t GROUP BY 1")
def si_roll_classes(spark, sf_dir):
    e = F.col("event_id")
    s = events(spark, sf_dir).select(stability.si_total((e % 61 - 30).cast("double"), (e % 41 - 20).cast("double")).alias("si"))
    return s.groupBy(stability.risk_class(F.col("si")).alias("risk")).agg(F.count("*").alias("n"), r6(F.avg("si"), "mean_si"))


@query("si_color", "WITH s AS (SELECT event_id, (event_id % 141 - 20) / 100 AS si FROM events), c AS (SELECT event_id, greatest(0.0, least(1.0, si)) AS s FROM s) SELECT event_id, CASE WHEN s < 0.5 THEN printf('#FF%02X00', floor(s * 2 * 255)::INT) ELSE printf('#%02X%02X00', floor((1 - s) * 2 * 255)::INT, 255 - floor((s - 0.5) * 2 * 85)::INT) END AS color FROM c")
def si_color(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", stability.si_color((F.col("event_id") % 141 - 20) / 100).alias("color"))


@query("linear_interpolate", """WITH s AS (SELECT event_id, user_id, CASE WHEN event_id % 5 IN (1, 2) THEN NULL ELSE value END AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
f AS (SELECT *, last_value(v IGNORE NULLS) OVER p AS av, last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER p AS ai, first_value(v IGNORE NULLS) OVER n AS bv, first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER n AS bi FROM s
  WINDOW p AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), n AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_id, round(coalesce(v, av + (bv - av) * (i - ai) / (bi - ai), av, bv), 6) AS value FROM f""")
def linear_interpolate(spark, sf_dir):
    s = events(spark, sf_dir).select("event_id", "user_id", "ts", F.when(~(F.col("event_id") % 5).isin(1, 2), F.col("value")).alias("value"))
    return ordered.interpolate(s, ["user_id"], ["ts", "event_id"], ["value"]).select("event_id", r6("value", "value"))


@query("consecutive_dedupe", "WITH s AS (SELECT event_id, user_id, event_type, lag(event_type) OVER w AS p, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) SELECT event_id, user_id, event_type FROM s WHERE n = 1 OR event_type IS DISTINCT FROM p")
def consecutive_dedupe(spark, sf_dir):
    return filters.consecutive_dedupe(events(spark, sf_dir).select("event_id", "user_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"], [F.col("event_type")]).select("event_id", "user_id", "event_type")


@query("first_dedupe", f"WITH {FIXES} SELECT event_id, x, y FROM fixes QUALIFY row_number() OVER (PARTITION BY x, y ORDER BY event_id) = 1")
def first_dedupe(spark, sf_dir):
    return filters.first_dedupe(fixes(spark, sf_dir).select("event_id", "x", "y"), ["x", "y"], ["event_id"])


@query("first_n_per_group", "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders QUALIFY rn <= 3")
def first_n_per_group(spark, sf_dir):
    return filters.first_n(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], 3).select("o_custkey", "o_orderkey", "rn")


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("latest_per_key", "SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY o_custkey")
def latest_per_key(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("o_orderkey"))


@query("middle_row_per_key", "SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE i = n // 2 + 1")
def middle_row_per_key(spark, sf_dir):
    w = Window.partitionBy("user_id")
    e = events(spark, sf_dir).select("user_id", "event_id", F.row_number().over(w.orderBy("ts", "event_id")).alias("i"), F.count("*").over(w).alias("n"))
    return e.where(F.col("i") == F.floor(F.col("n") / 2) + 1).select("user_id", "event_id")


@query("every_nth", "SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders) WHERE (i - 1) % 4 = 0")
def every_nth(spark, sf_dir):
    return filters.every_nth(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"], 4)


@query("row_slice", "SELECT o_custkey, o_orderkey, i AS slice_idx FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders) WHERE i BETWEEN 2 AND 6")
def row_slice(spark, sf_dir):
    return filters.row_slice(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"], 2, 5)


@query("patience", "WITH s AS (SELECT event_id, user_id, value, row_number() OVER w AS i, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) SELECT event_id, max(value) OVER u AS best_so_far, i - max(CASE WHEN b IS NULL OR value > b THEN i END) OVER u AS since_best FROM s WINDOW u AS (PARTITION BY user_id ORDER BY i ROWS UNBOUNDED PRECEDING)")
def patience(spark, sf_dir):
    return ordered.patience(events(spark, sf_dir).select("event_id", "user_id", "ts", "value"), ["user_id"], ["ts", "event_id"], "value").select("event_id", "best_so_far", "since_best")


@query("movement", f"""WITH {FIXES}, s AS (SELECT event_id, user_id, coalesce(x - lag(x) OVER w, lead(x) OVER w - x, 0.0) AS mx, coalesce(y - lag(y) OVER w, lead(y) OVER w - y, 0.0) AS my FROM fixes WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
t AS (SELECT event_id, CASE WHEN lag(mx) OVER w IS NULL OR lead(mx) OVER w IS NULL THEN mx ELSE (lag(mx) OVER w + mx + lead(mx) OVER w) / 3 END AS mx, CASE WHEN lag(my) OVER w IS NULL OR lead(my) OVER w IS NULL THEN my ELSE (lag(my) OVER w + my + lead(my) OVER w) / 3 END AS my FROM s WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT event_id, round(mx, 6) AS mx, round(my, 6) AS my, sqrt(mx ** 2 + my ** 2) > 0.5 AS has_move FROM t""")
def movement(spark, sf_dir):
    return ordered.movement(fixes(spark, sf_dir).select("event_id", "user_id", "x", "y"), ["user_id"], ["event_id"], "x", "y").select("event_id", r6("mx", "mx"), r6("my", "my"), "has_move")
