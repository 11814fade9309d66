"""The stages end to end: raw logs to cleaned, segmented, aligned rows; matching; terrain; training matrix."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraline.functions.geo import utm_forward, utm_inverse
from terraline.functions.naming import device_of, pair_key
from terraline.operators import asof, filters, matcher, ordered, spatial, terrain
from terraline.sources import logs, network


@dataclass(frozen=True)
class RouteConfig:
    gps: filters.GpsLimits = field(default_factory=filters.GpsLimits)
    axes: tuple[str, ...] = ("ax", "ay", "az", "gx", "gy", "gz")
    imu_outliers: bool = True
    tolerance_s: float = 1.0
    max_gap_m: float = 100.0
    min_segment_rows: int = 10
    min_rows: int = 10


def with_key(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumn("source_key", pair_key(F.col("file"), prefix)).where("source_key is not null")


def with_utm(df: DataFrame) -> DataFrame:
    x, y = utm_forward(F.col("lon"), F.col("lat"))
    return df.withColumns({"x_utm": x, "y_utm": y})


def clean_gps(points: DataFrame, cfg: RouteConfig = RouteConfig()) -> tuple[DataFrame, DataFrame]:
    """(kept fixes with UTM coordinates, ledger of the dropped ones)."""
    by, order = ["source_key"], ["line_no"]
    tagged = filters.tag(points, filters.gps_rules(cfg.gps))
    jumps = filters.jump_filter(with_utm(filters.kept(tagged)), by, order, "x_utm", "y_utm", cfg.gps.max_jump_m)
    lone = filters.isolated_filter(filters.kept(jumps), by, order, "x_utm", "y_utm", cfg.gps.neighbour_m, cfg.gps.window, cfg.gps.min_neighbours)
    ledger = filters.union_ledgers(*[filters.drop_ledger(filters.dropped(t), "gps", "source_key") for t in (tagged, jumps, lone)])
    return filters.kept(lone), ledger


def clean_imu(samples: DataFrame, cfg: RouteConfig = RouteConfig()) -> tuple[DataFrame, DataFrame]:
    timed = samples.where("timestamp is not null")
    if not cfg.imu_outliers:
        return timed, timed.limit(0)
    flagged = ordered.rolling_outliers(timed, ["source_key", "session"], ["timestamp", "line_no"], list(cfg.axes))
    rule = [filters.Rule("imu_rolling_outlier", F.col("outlier"))]
    tagged = filters.tag(flagged, rule)
    ledger = filters.drop_ledger(filters.dropped(tagged), "imu", "source_key", flagged_axes_count=F.col("flagged_axes_count"), flagged_axes=F.col("flagged_axes"))
    return filters.kept(tagged).drop("flagged_axes", "flagged_axes_count", "outlier"), ledger


def process_routes(gps_lines: DataFrame, imu_lines: DataFrame, cfg: RouteConfig = RouteConfig()) -> tuple[DataFrame, DataFrame]:
    """(rows, ledger). Each segment of a route is joined to all of the route's samples, so a sample may serve several segments;
    routes and segments of under min_rows rows go. Files without a partner are left out."""
    gps, gps_ledger = clean_gps(with_key(logs.parse_gps(gps_lines), "GPS"), cfg)
    imu, imu_ledger = clean_imu(with_key(logs.parse_imu(imu_lines), "ESTABILIDAD"), cfg)
    by, order = ["source_key"], ["line_no"]
    cut = ordered.split_segments(gps, by, order, ordered.distance_break(by, order, "x_utm", "y_utm", cfg.max_gap_m), cfg.min_segment_rows)
    segments = cut.select("source_key", "segment_id").distinct()
    samples = imu.drop("path", "file", "session").withColumnRenamed("line_no", "imu_line").join(segments, "source_key")
    cols = ["lat", "lon", "alt", "hdop", "fix", "numsats", "speed_kmh", "x_utm", "y_utm"]
    joined = asof.nearest_asof(samples, cut, ["source_key", "segment_id"], "timestamp", int(cfg.tolerance_s * 1_000_000), cols, "line_no", suffix="_gps")
    for c in cols:
        joined = joined.withColumnRenamed(f"{c}_gps", c)
    n = F.count("*").over(ordered.Window.partitionBy("source_key", "segment_id"))
    rows = joined.withColumn("__n", n).where(F.col("__n") >= cfg.min_rows).drop("__n")
    return rows, filters.union_ledgers(gps_ledger, imu_ledger)


def match_routes(rows: DataFrame, edges: DataFrame, cfg: matcher.MatchConfig = matcher.MatchConfig()) -> DataFrame:
    """Rows with lat/lon on the road, lat_raw/lon_raw and the road's attributes; rows without coordinates pass unchanged.
    edges: edge_id, coords (lon, lat), name, ref, highway."""
    x, y = utm_forward(F.col("p.lon"), F.col("p.lat"))
    flat = edges.select("edge_id", F.posexplode("coords").alias("i", "p")).select("edge_id", F.struct("i", x.alias("x"), y.alias("y")).alias("p"))
    planar = flat.groupBy("edge_id").agg(F.transform(F.array_sort(F.collect_list("p")), lambda q: F.struct(q["x"], q["y"])).alias("coords")).join(edges.drop("coords"), "edge_id")
    track = F.concat_ws("_seg", "source_key", F.col("segment_id").cast("string"))
    points = rows.where("lat is not null and lon is not null").select(track.alias("track"), F.col("imu_line").alias("ord"), F.col("x_utm").alias("x"), F.col("y_utm").alias("y"))
    lon, lat = utm_inverse(F.col("x"), F.col("y"))
    got = matcher.match_tracks(points, planar, cfg=cfg).select("track", "ord", lon.alias("__lon"), lat.alias("__lat"), "edge_id", "dist_to_road_m", F.col("name").alias("road_name"), F.col("ref").alias("road_ref"), "highway")
    out = rows.withColumns({"track": track, "ord": F.col("imu_line"), "lat_raw": F.col("lat"), "lon_raw": F.col("lon")}).join(got, ["track", "ord"], "left")
    moved = F.col("edge_id").isNotNull()
    return out.withColumns({"lat": F.when(moved, F.col("__lat")).otherwise(F.col("lat")), "lon": F.when(moved, F.col("__lon")).otherwise(F.col("lon"))}).drop("__lat", "__lon", "track", "ord")


def enrich_terrain(rows: DataFrame, cloud: DataFrame, registry: DataFrame, radius: float = 100.0, size: int = 256, device: str = "source_key") -> DataFrame:
    """Rows with the device's constants and terrain features; each distinct position is computed once. Gaps within a segment are
    interpolated, but for n_points_used. cloud: x, y, z."""
    named = network.device_join(rows.withColumn("__device", device_of(F.col(device))), registry, "__device").drop("__device")
    spots = named.where("x_utm is not null").select(F.xxhash64("x_utm", "y_utm").alias("spot"), F.col("x_utm").alias("x"), F.col("y_utm").alias("y")).distinct()
    pairs = spatial.radius_join(spots, terrain.counted_places(cloud.select(F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("z").alias("oz"))), radius)
    features = terrain.enrich_terrain(pairs, "spot", "long", size)
    out = named.withColumn("spot", F.xxhash64("x_utm", "y_utm")).join(features, "spot", "left").drop("spot")
    out = filters.finite_or_null(out, terrain.FEATURES).withColumn("phi_lidar_deg", F.degrees("phi_lidar"))
    return ordered.interpolate(out, ["source_key", "segment_id"], ["timestamp", "imu_line"], [*terrain.FEATURES, "phi_lidar_deg"])


def ground_truth(df: DataFrame, si_measured: str, roll_deg: str, critical_deg: float) -> DataFrame:
    """Inferred: si_real, si_static and their difference."""
    from terraline.functions.stability import si_static_risk

    return df.withColumn("si_real", F.col(si_measured)).withColumn("si_static", si_static_risk(F.col(roll_deg), F.lit(critical_deg))).withColumn("delta_si", F.col("si_real") - F.col("si_static"))


def enhanced_ground_truth(df: DataFrame, si_measured: str = "si", roll_deg: str = "roll", ay: str = "ay", omega_rad_s: str = "omega_rad_s", phi_rad: str = "phi_lidar", critical_deg: float = 33.79, fusion: float = 0.5) -> DataFrame:
    """Nine columns beside df; only their names are known, the formulas are ours: the static index from the roll, from the terrain's
    slope, and from both angles mixed by `fusion`; the dynamic one from the lateral acceleration; their sum as the prediction."""
    from terraline.functions.stability import si_dynamic, si_static_risk

    static = lambda deg: si_static_risk(deg, F.lit(critical_deg))
    slope = F.degrees(F.abs(F.col(phi_rad)))
    both = (1 - fusion) * F.abs(F.col(roll_deg)) + fusion * F.coalesce(slope, F.abs(F.col(roll_deg)))
    out = df.withColumns({"si_real": F.col(si_measured), "si_static_imu": static(F.col(roll_deg)), "si_static_lidar": static(slope), "si_static_fused": static(both), "si_dynamic_obs": si_dynamic(F.col(ay)), "omega_rad_s": F.col(omega_rad_s)})
    out = out.withColumn("si_pred_obs_w", F.col("si_static_fused") + F.abs("si_dynamic_obs"))
    return out.withColumns({"delta_si_static_fused": F.col("si_real") - F.col("si_static_fused"), "delta_si_pred_obs_w": F.col("si_real") - F.col("si_pred_obs_w")})


def trip_centre(df: DataFrame, by: list[str], si: str = "si") -> DataFrame:
    """Points, range of the index and the mean position of each trip, for maps."""
    return df.groupBy(*by).agg(F.count("*").alias("n_points"), F.min(si).alias("si_min"), F.max(si).alias("si_max"), F.avg("lat").alias("centre_lat"), F.avg("lon").alias("centre_lon"))


def legend_counts(df: DataFrame, risk: str) -> DataFrame:
    """Points and their share by class."""
    total = df.agg(F.count("*").alias("__t"))
    return df.groupBy(risk).agg(F.count("*").alias("n")).crossJoin(F.broadcast(total)).select(risk, "n", (100 * F.col("n") / F.col("__t")).alias("percent"))  # one row is joined


def merge_timelines(gps: DataFrame, imu: DataFrame, time: str = "timestamp") -> DataFrame:
    """Inferred: both sensors' rows on one timeline, with their origin."""
    return gps.withColumn("origin", F.lit("gps")).unionByName(imu.withColumn("origin", F.lit("imu")), allowMissingColumns=True).sort(time)
