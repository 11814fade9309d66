"""Road networks and registries: GraphML text, WKT, device parameters, LAS point records, LAZ tile names."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from terraline.functions.naming import linestring, tile_of
from terraline.operators.ordered import numbered

# Road classes that are never matched.
EXCLUDED_HIGHWAYS = ["footway", "path", "cycleway", "pedestrian", "steps", "track", "bridleway", "corridor", "via_ferrata", "proposed", "construction", "raceway", "rest_area", "elevator", "bus_guideway"]

_NODE = T.StructType([T.StructField("_id", T.StringType()), T.StructField("data", T.ArrayType(T.StructType([T.StructField("_key", T.StringType()), T.StructField("_VALUE", T.StringType())])))])
_EDGE = T.StructType([T.StructField("_source", T.StringType()), T.StructField("_target", T.StringType()), *_NODE.fields])
_KEY = T.StructType([T.StructField("_id", T.StringType()), T.StructField("_attr.name", T.StringType())])


def read_graphml(spark: SparkSession, path: str, excluded: list[str] = EXCLUDED_HIGHWAYS) -> DataFrame:
    """edge_id (dense from 0 over the edges kept, in file order), coords (array<struct<lon, lat>>), name, ref, highway."""
    xml = lambda tag, schema: spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)
    keys = {r["_attr.name"]: r["_id"] for r in xml("key", _KEY).collect()}  # the file's attribute names
    value = lambda name: F.get(F.filter("data", lambda d: d["_key"] == keys.get(name, name)), F.lit(0))["_VALUE"]
    nodes = xml("node", _NODE).select(F.col("_id").alias("id"), value("x").try_cast("double").alias("lon"), value("y").try_cast("double").alias("lat"))
    edges = xml("edge", _EDGE).select(F.monotonically_increasing_id().alias("ord"), "_source", "_target", linestring(value("geometry")).alias("wkt"), value("name").alias("name"), value("ref").alias("ref"), value("highway").alias("highway"))
    end = lambda side: nodes.select(F.col("id").alias(side), F.struct("lon", "lat").alias(f"{side}_at"))
    both = edges.join(end("_source"), "_source", "left").join(end("_target"), "_target", "left")
    coords = F.coalesce("wkt", F.filter(F.array("_source_at", "_target_at"), lambda p: p.isNotNull() & p["lon"].isNotNull() & p["lat"].isNotNull()))
    kept = both.withColumns({"coords": coords, "__all": F.lit(0)}).where((F.size("coords") >= 2) & ~F.coalesce(F.col("highway").isin(excluded), F.lit(False)))
    return numbered(kept, "__all", ["ord"], "edge_id").select("edge_id", "coords", "name", "ref", "highway")


def network_bounds(edges: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    p = edges.select(*by, F.explode("coords").alias("p"))
    return p.groupBy(*by).agg(F.min("p.lon").alias("min_lon"), F.max("p.lon").alias("max_lon"), F.min("p.lat").alias("min_lat"), F.max("p.lat").alias("max_lat"))


def covering_networks(bounds: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Networks whose bounds contain the box (min_lon, max_lon, min_lat, max_lat)."""
    return bounds.where((F.col("min_lon") <= box[0]) & (F.col("max_lon") >= box[1]) & (F.col("min_lat") <= box[2]) & (F.col("max_lat") >= box[3]))


def files_like(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern names, in order; none where there is no such folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return sorted(f.getPath().toString() for f in found or [])


def network_for_box(spark: SparkSession, box: tuple[float, float, float, float], local: str | None = None, cache: str | None = None, excluded: list[str] = EXCLUDED_HIGHWAYS) -> DataFrame:
    """The edges of the first network whose bounds contain the box (min_lon, max_lon, min_lat, max_lat): the local file if there is one,
    then net_*.graphml of the cache folder by name. Without one a LookupError is raised; nothing is downloaded."""
    files = [*(files_like(spark, local) if local else []), *(files_like(spark, f"{cache.rstrip('/')}/net_*.graphml") if cache else [])]
    for path in files:  # a network is read only if those before it don't do
        edges = read_graphml(spark, path, excluded)
        if not covering_networks(network_bounds(edges), box).isEmpty():
            return edges
    raise LookupError(f"none of {len(files)} networks covers {box}")


# The stability constants of the known devices.
DEVICES = [
    ("23", 1.15, 2.05, 1100.0, 2.03, 1.89, 2450.0, 54.0),
    ("24", 1.15, 2.0, 2500.0, 1.88, 5.00, 2215.0, 64.0),
    ("27", 1.50, 1.50, 1100.0, 0.96, 2.13, 1880.0, 45.0),
    ("28", 1.15, 2.05, 1100.0, 1.96, 1.86, 2200.0, 57.0),
]
CONSTANTS = ["k1", "k2", "k4_mm", "d1_m", "coeff", "s_mm", "alphav"]


def device_registry(spark: SparkSession, rows: list[tuple] = DEVICES) -> DataFrame:
    return spark.createDataFrame(rows, "device_id string, " + ", ".join(f"{c} double" for c in CONSTANTS))


def device_join(df: DataFrame, registry: DataFrame, device: str) -> DataFrame:
    """The seven constants beside every row; an unknown device or a missing constant raises when the row is read."""
    got = df.join(registry.withColumnRenamed("device_id", "__d"), df[device] == F.col("__d"), "left")
    known = F.lit(True)
    for c in CONSTANTS:
        known = known & F.col(c).isNotNull()
    checked = F.when(known, F.col(CONSTANTS[0])).otherwise(F.raise_error(F.concat(F.lit("no constants for device "), F.coalesce(F.col(device), F.lit("null")))).cast("double"))
    return got.withColumn(CONSTANTS[0], checked).drop("__d")


def tile_index(files: DataFrame, path: str = "path") -> DataFrame:
    """tx, ty and path of files named with a tile."""
    tx, ty = tile_of(F.col(path))
    return files.select(tx.alias("tx"), ty.alias("ty"), F.col(path)).where("tx is not null")


LAS_SCHEMA = "x double, y double, z double, classification int, tile string"


class LasSource(DataSource):
    """format("las"): point records of .las 1.2 to 1.4 files; option path is one file or several, comma-separated. Compressed .laz raises."""

    @classmethod
    def name(cls) -> str:
        return "las"

    def schema(self) -> str:
        return LAS_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return LasReader([p for p in self.options["path"].split(",") if p])


class LasReader(DataSourceReader):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        path = partition.value
        with open(path.removeprefix("file:"), "rb") as f:
            data = f.read()
        if data[:4] != b"LASF":
            raise ValueError(f"{path} is no LAS file")
        kind, size = data[104], int.from_bytes(data[105:107], "little")
        if kind & 0xC0:
            raise ValueError(f"{path} is compressed; unpack it to .las first")
        start, n = int.from_bytes(data[96:100], "little"), int.from_bytes(data[107:111], "little")
        if data[25] >= 4 and not n:
            n = int.from_bytes(data[247:255], "little")
        scale, offset = np.frombuffer(data, "<f8", 3, 131), np.frombuffer(data, "<f8", 3, 155)
        names = np.dtype({"names": ["x", "y", "z", "cls"], "formats": ["<i4", "<i4", "<i4", "u1"], "offsets": [0, 4, 8, 16 if kind >= 6 else 15], "itemsize": size})
        rec = np.frombuffer(data, names, n, start)
        cls = rec["cls"] if kind >= 6 else rec["cls"] & 31
        x, y, z = (rec[c] * scale[k] + offset[k] for k, c in enumerate("xyz"))
        yield from zip(x.tolist(), y.tolist(), z.tolist(), cls.astype(int).tolist(), [path] * n, strict=True)


def ground_points(points: DataFrame, tile: str = "tile") -> DataFrame:
    """Class 2 points; all points of a tile that has none."""
    n = points.groupBy(tile).agg(F.max((F.col("classification") == 2).cast("int")).alias("__has"))
    return points.join(n, tile).where((F.col("__has") == 0) | (F.col("classification") == 2)).drop("__has")
