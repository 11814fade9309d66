"""Tables at rest in the folder that all executors share, where a plan needs one twice or lineage must end; and this package on the executors."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or one of our own where that is unset and all run on this machine (tests)."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return base or f"file://{tempfile.gettempdir()}/terraline-{spark.sparkContext.applicationId}"


def at_rest(df: DataFrame, name: str) -> DataFrame:
    """df written once and read again: a lost executor costs only its own tasks."""
    spark = df.sparkSession
    path = f"{folder(spark)}/terraline/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SENT: set[str] = set()


def send_code(spark: SparkSession) -> None:
    """This package as a zip to the executors, once per application, for tasks that run functions of it."""
    sc = spark.sparkContext
    if sc.applicationId in _SENT:
        return
    top = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(), f"{top.name}_code.zip")
    with zipfile.ZipFile(path, "w") as out:
        for p in sorted(top.rglob("*.py")):
            out.write(p, p.relative_to(top.parent))
    sc.addPyFile(path)
    _SENT.add(sc.applicationId)
