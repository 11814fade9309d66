"""Elevation and patches from a cloud with a raster to fall back on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraline.operators.spatial import bilinear, knn_join, radius_join

SOURCES = ("auto", "laz", "tif", "both")


def elevation(points: DataFrame, id_col: str, cloud: DataFrame | None, raster: DataFrame | None, x0: float = 0.0, y0: float = 0.0, step: float = 1.0, source: str = "auto", radius: float = 1.0) -> DataFrame:
    """id_col and z: the cloud's mean within the radius, then the raster's bilinear value (auto), only one of them (laz, tif), or the
    mean of those there are (both). points: id_col, x, y; cloud: x, y, z; raster: row, col, z. No source at all raises."""
    if source not in SOURCES or cloud is None and raster is None:
        raise ValueError("no elevation source")
    out = points.select(id_col)
    if cloud is not None:
        near = radius_join(points.select(id_col, "x", "y"), cloud.select(F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("z").alias("oz")), radius)
        out = out.join(near.groupBy(id_col).agg(F.avg("oz").alias("laz")), id_col, "left")
    else:
        out = out.withColumn("laz", F.lit(None).cast("double"))
    if raster is not None:
        out = out.join(bilinear(points, raster, id_col, x0, y0, step).withColumnRenamed("z", "tif"), id_col, "left")
    else:
        out = out.withColumn("tif", F.lit(None).cast("double"))
    there = F.filter(F.array("laz", "tif"), lambda v: v.isNotNull())
    mean = F.when(F.size(there) > 0, F.aggregate(there, F.lit(0.0), lambda a, v: a + v) / F.size(there))
    return out.select(id_col, {"auto": F.coalesce("laz", "tif"), "laz": F.col("laz"), "tif": F.col("tif"), "both": mean}[source].alias("z"))


def covered(points: DataFrame, cloud: DataFrame, id_col: str, radius: float = 1.0) -> DataFrame:
    """points with covered: whether the cloud has a point within the radius."""
    hit = radius_join(points.select(id_col, "x", "y"), cloud.select(F.col("x").alias("ox"), F.col("y").alias("oy")), radius).select(id_col).distinct().withColumn("__hit", F.lit(True))
    return points.join(hit, id_col, "left").withColumn("covered", F.coalesce("__hit", F.lit(False))).drop("__hit")


def coverage_info(points: DataFrame, tile: str = "tile") -> DataFrame:
    """Points and bounding-box area of each tile."""
    return points.groupBy(tile).agg(F.count("*").alias("n_points"), ((F.max("x") - F.min("x")) * (F.max("y") - F.min("y"))).alias("area_m2"))


def nearest_grid(cloud: DataFrame, x0: float, y0: float, columns: int, rows: int, step: float = 1.0) -> DataFrame:
    """row, col and the z of the cloud's nearest point at every cell of a regular grid; z is null where the cloud has under four points."""
    cells = cloud.sparkSession.range(rows).select(F.col("id").cast("int").alias("row"), F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("col"))
    grid = cells.select((F.col("row").cast("long") * columns + F.col("col")).alias("cell"), "row", "col", (x0 + F.col("col") * step).alias("x"), (y0 + F.col("row") * step).alias("y"))
    points = cloud.select(F.monotonically_increasing_id().alias("__p"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("z"))
    if cloud.limit(4).count() < 4:
        return grid.select("row", "col", F.lit(None).cast("double").alias("z"))
    return knn_join(grid, points, 1, "cell", "__p", 2 * step).select("row", "col", "z")
