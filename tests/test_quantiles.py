"""Percentiles spread over tasks against the built-in aggregate, which holds a group in one task."""

import math

import pytest
from pyspark.sql import functions as F

from terraline.operators.quantiles import with_percentiles

QUANTILES = [0.0, 0.02, 0.25, 0.5, 0.9, 0.95, 1.0]


@pytest.mark.parametrize("by", [[], ["g"], ["g", "h"]])
def test_against_percentile(spark, by):
    rows = [("hot", i % 3, float((i * 7919) % 997) ** 1.5 - 200.0) for i in range(3000)] + [("ties", 0, 5.0)] * 40 + [(None, 1, float(i)) for i in range(5)]
    rows += [("none", 0, None), ("one", None, -0.0), ("mixed", 0, None), ("mixed", 0, 1e300), ("mixed", 0, float("nan"))]
    df = spark.createDataFrame(rows, "g string, h int, v double").repartition(5)
    want = df.groupBy(*by).agg(F.percentile("v", F.array(*map(F.lit, QUANTILES))).alias("p"))
    got = with_percentiles(df.groupBy(*by).agg(F.count("*").alias("n")), df, F.col("v"), QUANTILES, by, parts=7)
    assert got.columns == [*by, "n", "p"]
    plain = lambda d: {tuple(r[b] for b in by): r["p"] and [x if x is None or not math.isnan(x) else "nan" for x in r["p"]] for r in d.collect()}
    assert plain(got) == plain(want)


def test_no_rows(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert with_percentiles(df.agg(F.count("*").alias("n")), df, F.col("v"), [0.5]).first()["p"] == [None]
    assert with_percentiles(df.groupBy("g").agg(F.count("*").alias("n")), df, F.col("v"), [0.5], ["g"]).count() == 0
