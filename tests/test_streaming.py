"""Streams give the same rows as the batch forms."""

import datetime as dt

from pyspark.sql import functions as F

from terraline.operators import filters
from terraline.streaming import operators as streams

T0 = dt.datetime(2025, 1, 1)


def run(stream, spark, name, mode="append"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None
    return spark.table(name)


def test_rules_and_counts(spark, tmp_path):
    rows = [(i, T0 + dt.timedelta(seconds=10 * i), float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, ts timestamp, hdop double")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    rules = [filters.Rule("hdop", F.col("hdop") > 4)]
    got = run(streams.rule_filter(stream, rules), spark, "tagged")
    assert got.where("drop_reason is null").count() == filters.kept(filters.tag(df, rules)).count()
    counts = run(streams.drop_counts(streams.rule_filter(stream, rules), "ts"), spark, "counts", "complete")
    assert counts.agg(F.sum("n")).first()[0] == 16


def test_ring_mean(spark, tmp_path):
    df = spark.createDataFrame([(1, i, float(i)) for i in range(6)], "k int, i int, v double")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    got = run(streams.ring_mean(stream, "k", "i", "v", 3), spark, "rings").orderBy("i").collect()
    assert [r["ring_mean"] for r in got] == [0.0, 1 / 3, 1.0, 2.0, 3.0, 4.0]


def test_tolerance_join(spark, tmp_path):
    left = spark.createDataFrame([(1, 10, T0), (1, 11, T0 + dt.timedelta(seconds=5))], "k int, id int, t timestamp")
    right = spark.createDataFrame([(1, 1, T0 + dt.timedelta(seconds=1)), (1, 2, T0 - dt.timedelta(seconds=1))], "k int, rid int, rt timestamp")
    left.write.parquet(str(tmp_path / "l"))
    right.write.parquet(str(tmp_path / "r"))
    pairs = streams.tolerance_join(spark.readStream.schema(left.schema).parquet(str(tmp_path / "l")), spark.readStream.schema(right.schema).parquet(str(tmp_path / "r")), "k", "t", "rt")
    got = run(pairs, spark, "pairs")
    near = streams.nearest_of_pairs(got, "id", "t", "rt", "rid").collect()
    assert got.count() == 2 and [(r["id"], r["rid"]) for r in near] == [(10, 2)]
