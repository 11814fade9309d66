"""The search for the nearest looks at few pairs where many places are nearly as near, and where many rows stand in one place; results by brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraline.operators import spatial


@pytest.fixture
def pairs(monkeypatch):
    """Row counts of the pairs that the searches join."""
    found, real = [], spatial.spread_join

    def counted(*a, **k):
        out = real(*a, **k)
        found.append(out.count())
        return out

    monkeypatch.setattr(spatial, "spread_join", counted)
    return found


def test_near_ties_meet_few_nodes(spark, pairs):
    n = F.col("id")
    points = spark.range(600).select(n.alias("pid"), (40 + n % 7 / 1e6).alias("lat"), (-3 + n % 5 / 1e6).alias("lon"))
    nodes = spark.range(1, 4001).select(n.alias("nid"), (40 + F.degrees((100 + n / 2000) / 6_371_000.0)).alias("lat"), F.lit(-3.0).alias("lon"))
    got = spatial.snap_trajectory(points, nodes, "pid", "nid", "lat", "lon", 100.0).collect()
    assert 0 < sum(pairs) < 35 * 500  # 600 x 4,000 where every point meets every node that is about as near
    lats = np.radians(40 + np.degrees((100 + np.arange(1, 4001) / 2000) / 6_371_000.0))
    for r in got:
        a, b = math.radians(40 + r["pid"] % 7 / 1e6), math.radians(r["pid"] % 5 / 1e6)
        h = np.sin((lats - a) / 2) ** 2 + np.cos(a) * np.cos(lats) * np.sin(b / 2) ** 2
        assert r["distance_correction_m"] == pytest.approx(float((2 * 6_371_000.0 * np.arcsin(np.sqrt(h))).min()), abs=1e-6)
    assert len(got) == 600


def test_copies_of_places_meet_once(spark, pairs):
    n = F.col("id")
    points = spark.range(2000).select(n.alias("pid"), (n * 53 % 50).cast("double").alias("x"), (n * 29 % 50).cast("double").alias("y"))
    others = spark.range(3000).select(n.alias("oid"), (n * 37 % 50).cast("double").alias("ox"), (n * 9 % 50).cast("double").alias("oy"))
    got = {}
    for r in spatial.knn_join(points, others, 3, "pid", "oid", 8.0).collect():
        got.setdefault(r["pid"], {})[r["rank"]] = (r["oid"], r["dist"])
    assert 0 < sum(pairs) < 50 * 150  # 50 places; not 2,000 x 3,000
    o = np.arange(3000)
    for p in range(2000):
        d = np.hypot(o * 37 % 50 - (p * 53 % 50), o * 9 % 50 - (p * 29 % 50))
        want = np.lexsort((o, d))[:3]
        assert [got[p][i + 1][0] for i in range(3)] == want.tolist()


def test_rows_without_a_place_are_no_neighbours(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 1.0), (3, float("nan"), 1.0), (1, 0.0, 0.0)], "id int, x double, y double")
    others = spark.createDataFrame([(1, 3.0, 4.0), (2, None, 0.0), (3, float("nan"), 0.0), (4, float("inf"), 0.0)], "oid int, ox double, oy double")
    got = [(r["id"], r["oid"], r["dist"], r["rank"]) for r in spatial.knn_join(points, others, 2, "id", "oid", 1.0).collect()]
    assert got == [(1, 1, 5.0, 1)] * 2
