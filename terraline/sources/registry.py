"""Device registries in YAML files: a device_id, and the sections stability_model, terrain and hardware of plain values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from terraline.sources.network import CONSTANTS

# The sections a device must have, and the constants its model must have.
SECTIONS = ["stability_model", "terrain", "hardware"]
REQUIRED = ["k1", "k2", "d1_m", "s_mm", "coeff", "alphav"]


def read_registry(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, device_id, the constants, and valid: all sections and required constants are there. Files without a device_id are
    left out; later files (by path) replace earlier ones of the same device."""
    whole = spark.read.format("binaryFile").load(path).select("path", F.split(F.decode("content", "UTF-8"), r"\r?\n").alias("l"))
    lines = whole.select("path", F.posexplode("l").alias("no", "raw")).select("path", "no", F.rtrim(F.regexp_replace("raw", r"(^|\s)#.*$", "")).alias("line")).where(F.col("line").rlike(r"^\s*[\w-]+\s*:"))
    key = F.regexp_extract("line", r"^\s*([\w-]+)\s*:", 1)
    value = F.regexp_replace(F.trim(F.regexp_extract("line", r":\s*(.*)$", 1)), r"^([\"'])(.*)\1$", "$2")
    pairs = lines.select("path", "no", (~F.col("line").rlike(r"^\s")).alias("top"), key.alias("key"), value.alias("value"))
    # a file is a page of settings: its lines are one small group
    entry = F.struct("no", "top", "key", "value")
    files = pairs.groupBy("path").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    tops = F.filter("e", lambda x: x["top"])
    named = lambda name: F.get(F.filter("e", lambda x: x["top"] & (x["key"] == name)), F.lit(0))
    after = F.array_min(F.transform(F.filter(tops, lambda x: x["no"] > named("stability_model")["no"]), lambda x: x["no"]))
    inside = lambda x: ~x["top"] & (x["no"] > named("stability_model")["no"]) & (x["no"] < F.coalesce(after, F.lit(2**31 - 1)))
    constant = lambda c: F.get(F.filter("e", lambda x: inside(x) & (x["key"] == c)), F.lit(0))["value"].try_cast("double")
    got = files.select("path", F.nullif(named("device_id")["value"], F.lit("")).alias("device_id"), *[constant(c).alias(c) for c in CONSTANTS], F.transform(tops, lambda x: x["key"]).alias("sections")).where("device_id is not null")
    valid = F.size(F.array_except(F.array(*map(F.lit, SECTIONS)), "sections")) == 0
    for c in REQUIRED:
        valid = valid & F.col(c).isNotNull()
    last = got.groupBy("device_id").agg(F.max_by(F.struct("path", *CONSTANTS, valid.alias("valid")), "path").alias("r"))
    return last.select("r.path", "device_id", *[f"r.{c}" for c in CONSTANTS], "r.valid")


def device_config(registry: DataFrame, device: str) -> Row:
    """The registry's row of a device, with or without its letters (`DOBACK`); a ValueError that names the known ones where it has none."""
    name = str(device).replace("DOBACK", "").strip()
    found = registry.where(F.col("device_id") == name).first()
    if found is None:
        known = [r["device_id"] for r in registry.select("device_id").distinct().orderBy("device_id").collect()]  # a fleet's devices
        raise ValueError(f"no configuration for device {name}; there are {known}")
    return found
