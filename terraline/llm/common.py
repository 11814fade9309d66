"""What the operators share: shipping the code, tables in the shared folder, Arrow batches."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_MADE: dict[str, tuple[SparkSession, list[str]]] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as a zip of its sources."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(), f"{top.name}_src.zip")
    with zipfile.ZipFile(path, "w") as out:
        for p in sorted(top.rglob("*.py")):
            out.write(p, p.relative_to(top.parent))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def scratch(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where that is unset and all run on this machine (tests)."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return base or f"file://{tempfile.gettempdir()}/terraline-{spark.sparkContext.applicationId}"


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete tables that materialize() wrote and nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def _at_exit(app: str) -> None:
    spark, paths = _MADE.pop(app, (None, []))
    try:
        if spark is not None and spark.sparkContext._jsc is not None:
            discard(spark, *paths)
    except Exception:  # the JVM may be gone already; the shared folder is the cluster's to clean
        return


def new_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    if app not in _MADE:
        _MADE[app] = (spark, [])
        atexit.register(_at_exit, app)
    path = f"{scratch(spark)}/terraline/{name}-{uuid.uuid4().hex}"
    _MADE[app][1].append(path)
    return path


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write df to the shared folder and read it back: lineage ends there, and a lost executor costs only its own tasks."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_shuffles(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of a plan that is done when the driver collects its garbage, which may be rounds later: collect it now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Numbered(dict):
    """Keys get the next number when they are first looked up."""

    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


_HELD: dict = {}


def only(kind: str, key, build):
    """The one large object that a worker process holds: another kind or key replaces it, so operators never add up."""
    if (kind, key) not in _HELD:
        _HELD.clear()
        gc.collect()
        settle()
        _HELD[kind, key] = build()
    return _HELD[kind, key]


def settle() -> None:
    """Give memory that a task no longer needs back to the system, so that idle workers stay small."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the column's bytes stay near the limit; one row may exceed it."""
    for batch in batches:
        n, start, size = batch.num_rows, 0, 0
        if batch.column(column).nbytes <= limit:
            if n:
                yield batch
            continue
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        for i in range(n):
            if size and size + lengths[i] > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += int(lengths[i])
        if start < n:
            yield batch.slice(start)
    settle()


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return batch.column(column).cast(pa.binary()).to_pylist()
