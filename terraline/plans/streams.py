"""Queries that run as streams over the given tables: the rows are dealt to files in order of time, a few micro-batches each."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraline import scratch
from terraline.plans.analytics import _edges
from terraline.plans.telemetry import _SEG, FIXES, fixes, query
from terraline.streaming import tracks

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


FILE_ROWS = 100_000  # rows a file, so that a stretch is written and read by many tasks


def in_time(df: DataFrame, time: str, parts: int = 4, file_rows: int = FILE_ROWS) -> DataFrame:
    """A stream of df's rows, the files of one stretch of time after the other; the last row, of no key that df has, is a year ahead, so that all others pass the watermark.

    A trigger takes as many files as a stretch has: each has the same number, if need be empty ones, so that no trigger runs ahead."""
    spark = df.sparkSession
    folder = f"{scratch.folder(spark)}/terraline/stream-{uuid.uuid4().hex}"
    bounds = df.agg(F.min(F.unix_micros(time)).alias("a"), F.max(F.unix_micros(time)).alias("b"), F.max("user_id").alias("k"), F.count("*").alias("n")).first()
    low, high, key, n = (0, 0, 0, 0) if bounds["a"] is None else bounds
    files = max(1, -(-n // (parts * file_rows)))
    place = F.floor((F.unix_micros(time) - low) * parts / (high - low + 1))
    ahead = spark.range(1).select(*[F.lit(0).cast(f.dataType).alias(f.name) if f.name not in (time, "user_id") else F.timestamp_micros(F.lit(high + 366 * 86_400_000_000)).alias(time) if f.name == time else F.lit(key + 1).cast(f.dataType).alias("user_id") for f in df.schema])
    for k, rows in enumerate([*(df.where(place == k) for k in range(parts)), ahead]):
        at = f"{folder}/{k}"
        (rows.repartition(files) if files > 1 and k < parts else rows.coalesce(1)).write.parquet(at)
        for _ in range(files - len(spark.read.schema(df.schema).parquet(at).inputFiles())):
            rows.limit(0).coalesce(1).write.mode("append").parquet(at)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", "true").parquet(folder)


def run(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """The rows of a stream that has read all there is, at rest."""
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKS)
    try:
        folder = f"{scratch.folder(spark)}/terraline/rows-{uuid.uuid4().hex}"
        stream = build()
        stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}-at").trigger(availableNow=True).start(folder).awaitTermination()
        return spark.read.schema(stream.schema).parquet(folder)
    finally:
        spark.conf.set(STORE, before)


def _timed(spark, sf_dir) -> DataFrame:
    return fixes(spark, sf_dir).select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "x", "y")


@query("stream_segments", f"WITH {FIXES}, " + _SEG.format(b="brk", e="sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) > 800 AS brk", t="fixes", op="> 4"))
def stream_segments(spark, sf_dir):
    rows = _timed(spark, sf_dir)
    got = run(spark, lambda: tracks.segment_stream(in_time(rows, "ts"), "user_id", "event_id", "ts", "x", "y", 800.0, 4, "1 hour", "60 days"))
    return got.select("event_id", "user_id", "segment_id")


@query("stream_map_match")
def stream_map_match(spark, sf_dir):
    rows = _timed(spark, sf_dir)
    edges = _edges(spark, sf_dir)
    last = rows.agg(F.max("user_id")).first()[0]
    got = run(spark, lambda: tracks.match_stream(in_time(rows, "ts"), edges, "user_id", "event_id", "ts", delay="1 hour", expire="60 days"))
    return got.where(F.col("user_id") <= F.lit(last))
