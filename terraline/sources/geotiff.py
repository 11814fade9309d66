"""format("geotiff"): band 1 of an uncompressed single-sample GeoTIFF as (row, col, x, y, z); x and y are cell centres, nodata is null."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "row int, col int, x double, y double, z double, path string"
_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 11: 4, 12: 8}
_NAMES = {1: "B", 3: "H", 4: "I", 11: "f", 12: "d"}


class GeoTiffSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "geotiff"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return GeoTiffReader([p for p in self.options["path"].split(",") if p])


def tags_of(data: bytes) -> tuple[str, dict[int, tuple]]:
    """Byte order and the first directory's numeric and text tags."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack_from(f"{order}H", data, 2)[0] != 42:
        raise ValueError("no TIFF file")
    at = struct.unpack_from(f"{order}I", data, 4)[0]
    out: dict[int, tuple] = {}
    for k in range(struct.unpack_from(f"{order}H", data, at)[0]):
        tag, kind, n = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * k)
        place = at + 10 + 12 * k
        if _SIZES.get(kind, 1) * n > 4:
            place = struct.unpack_from(f"{order}I", data, place)[0]
        if kind == 2:
            out[tag] = (data[place : place + n].rstrip(b"\0 ").decode("latin-1"),)
        elif kind in _NAMES:
            out[tag] = struct.unpack_from(f"{order}{n}{_NAMES[kind]}", data, place)
    return order, out


class GeoTiffReader(DataSourceReader):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        path = partition.value
        with open(path.removeprefix("file:"), "rb") as f:
            data = f.read()
        order, tags = tags_of(data)
        if tags.get(259, (1,))[0] != 1 or tags.get(277, (1,))[0] != 1 or 322 in tags:
            raise ValueError(f"{path}: only uncompressed strips of one sample are read")
        width, height = tags[256][0], tags[257][0]
        kind = {1: "u", 2: "i", 3: "f"}[tags.get(339, (1,))[0]]
        raw = b"".join(data[a : a + n] for a, n in zip(tags[273], tags[279], strict=True))
        z = np.frombuffer(raw, f"{order}{kind}{tags[258][0] // 8}", width * height).reshape(height, width).astype(float)
        step_x, step_y = tags[33550][:2]
        col0, row0, _, x0, y0 = tags[33922][:5]
        nodata = float(tags[42113][0]) if 42113 in tags else None
        for r in range(height):
            y = y0 - (r + 0.5 - row0) * step_y
            for c in range(width):
                v = float(z[r, c])
                yield r, c, x0 + (c + 0.5 - col0) * step_x, y, None if v == nodata or np.isnan(v) else v, path


def raster_stats(cells: DataFrame, by: list[str] = ["path"]) -> DataFrame:  # noqa: B006
    """Statistics of the cells with a value, the number without, and the bounds of the centres."""
    return cells.groupBy(*by).agg(
        F.count("z").alias("n_cells"), F.count(F.when(F.col("z").isNull(), 1)).alias("n_nodata"), F.min("z").alias("z_min"), F.max("z").alias("z_max"), F.avg("z").alias("z_mean"), F.stddev_pop("z").alias("z_std"),
        F.min("x").alias("x_min"), F.max("x").alias("x_max"), F.min("y").alias("y_min"), F.max("y").alias("y_max"),
    )
