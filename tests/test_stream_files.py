"""Streams of the given tables: a stretch of time is many files, and a trigger takes a whole stretch, however uneven they are."""

import glob

from pyspark.sql import functions as F

from terraline.plans import streams
from terraline.streaming import tracks


def test_stretches_of_many_files(spark):
    n = F.col("id")
    at = F.timestamp_seconds(1_600_000_000 + F.when(n < 390, n * 60).otherwise(n * 86_400))
    df = spark.range(400).select((n % 3).alias("user_id"), n.alias("event_id"), at.alias("ts"), n.cast("double").alias("x"), F.lit(0.0).alias("y"))
    made = []

    def build():
        stream = streams.in_time(df, "ts", file_rows=20)
        made.append(stream._jdf.queryExecution().analyzed().toString())
        return tracks.segment_stream(stream, "user_id", "event_id", "ts", "x", "y", 1e9, 4, "1 hour", "600 days")

    got = [r["event_id"] for r in streams.run(spark, build).where("user_id < 3").collect()]
    assert sorted(got) == list(range(400))  # no row is late
    folder = made[0].split("FileSource[")[1].split("]")[0].removeprefix("file:") if "FileSource[" in made[0] else None
    if folder:
        sizes = {len(glob.glob(f"{folder}/{k}/*.parquet")) for k in range(5)}
        assert sizes == {5}
