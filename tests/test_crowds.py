"""Joins of crowded cells, exact nearest places on the globe, written conditions and ranks of many columns, against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraline.operators import audit, filters, spatial


@pytest.mark.parametrize("crowd", [20_000, 50])
def test_radius_join_of_a_crowded_cell(spark, crowd):
    rng = np.random.default_rng(1)
    a = np.vstack([rng.uniform(0, 5, (400, 2)), rng.uniform(-300, 300, (200, 2))])
    b = np.vstack([rng.uniform(0, 5, (300, 2)), rng.uniform(-300, 300, (200, 2))])
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(a)], "id int, x double, y double")
    others = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(b)], "oid int, ox double, oy double")
    got = sorted((r["id"], r["oid"]) for r in spatial.radius_join(points, others, 12.0, crowd=crowd).select("id", "oid").collect())
    far = np.hypot(a[:, None, 0] - b[None, :, 0], a[:, None, 1] - b[None, :, 1])
    assert got == sorted(zip(*(x.tolist() for x in np.nonzero(far <= 12.0)), strict=True)) and len(got) > 100_000


def test_crowded_keys_are_spread_evenly(spark):
    """One key with 40,000 rows on a side: every task of the join gets near the same number of rows."""
    left = spark.range(40_000).select(F.lit(1).alias("k"), F.col("id").alias("a"))
    right = spark.range(300).select(F.lit(1).alias("k"), F.col("id").alias("b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = spatial.spread_join(left, right, ["k"], crowd=500)
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 40_000 * 300 and max(sizes) <= 4 * sorted(sizes)[len(sizes) // 2] and len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("k", [1, 5, 1000])
def test_nearest_in_crowds_and_voids(spark, k):
    rng = np.random.default_rng(k)
    b = np.vstack([rng.normal(0, 0.01, (3000, 2)), np.repeat([[7.0, 7.0]], 700, axis=0), rng.uniform(-5000, 5000, (60, 2))])[: 4000 if k < 1000 else 700]
    a = np.vstack([rng.normal(0, 0.02, (40, 2)), rng.uniform(-5000, 5000, (40, 2)), [[7.0, 7.0], [1e6, 1e6]]])
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(a)], "id int, x double, y double")
    others = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(b)], "oid int, ox double, oy double")
    got = {}
    for r in spatial.knn_join(points, others, k, "id", "oid", 100.0).collect():
        got.setdefault(r["id"], {})[r["rank"]] = (r["oid"], r["dist"])
    for i, p in enumerate(a):
        d = np.hypot(b[:, 0] - p[0], b[:, 1] - p[1])
        want = sorted(range(len(b)), key=lambda j, d=d: (d[j], j))[:k]
        mine = [got[i][q + 1] for q in range(len(want))]
        assert np.allclose([m[1] for m in mine], d[want], rtol=1e-12) and len(got[i]) == len(want)
        assert {m[0] for m in mine} == set(want) or len({round(x, 9) for x in d}) < len(d)


def test_quadtree_divides_only_crowded_cells(spark):
    rng = np.random.default_rng(0)
    b = np.vstack([rng.uniform(0, 1, (5000, 2)), rng.uniform(1000, 9000, (300, 2))])
    others = spark.createDataFrame([(float(x), float(y)) for x, y in b], "ox double, oy double")
    cells = spatial.pyramid(others, ["ox", "oy"], 100.0, 8, 200).toPandas()
    lowest = cells["__level"].min()
    assert lowest < -5 and cells[cells["__level"] == lowest]["__n"].max() <= 200
    assert cells[cells["__level"] == -1]["__n"].sum() == 5000 and (cells[cells["__level"] >= 0].groupby("__level")["__n"].sum() == 5300).all()


def haversine(a, b, c, d):
    h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6_371_000.0 * math.asin(math.sqrt(min(1.0, h)))


def test_nearest_node_is_the_nearest_by_the_haversine(spark):
    lat, lon = 40.0, -3.0
    north = [(k, lat + math.degrees((100.0 + k * 0.001) / 6_371_000), lon) for k in range(12)]
    east = [(100 + k, lat, lon + math.degrees((99.8 + k * 0.001) / 6_371_000 / math.cos(math.radians(lat)))) for k in range(12)]
    rng = np.random.default_rng(3)
    wide = [(1000 + i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(-89, 89, 200), rng.uniform(-180, 180, 200), strict=True))]
    nodes = north + east + wide + [(5000, 10.0, 179.9999), (5001, None, 3.0)]
    points = [(0, lat, lon), (1, 10.0, -179.9999), (2, 89.9, 10.0), (3, -89.9, 0.0), (4, None, 1.0)] + [(10 + i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(-80, 80, 40), rng.uniform(-180, 180, 40), strict=True))]
    got = spatial.snap_trajectory(spark.createDataFrame(points, "id int, lat double, lon double"), spark.createDataFrame(nodes, "node int, lat double, lon double"), "id", "node", "lat", "lon")
    got = {r["id"]: r for r in got.collect()}
    assert got[0]["distance_correction_m"] == pytest.approx(99.8, abs=1e-6) and got[0]["matched_on_road"]
    assert got[1]["lon_corrected"] == 179.9999 and got[1]["matched_on_road"] and got[4]["lat_corrected"] is None and got[4]["matched_on_road"] is False
    for i, a, b in points:
        if a is not None:
            best = min((haversine(a, b, c, d), n) for n, c, d in nodes if c is not None)
            assert got[i]["distance_correction_m"] == pytest.approx(best[0], rel=1e-9, abs=1e-6)


def test_conditions(spark):
    df = spark.createDataFrame([(1, "A&B", 1.0, 5.0), (2, "a | b == c", 2.0, None), (3, "x", None, 7.0), (4, "it's", 4.0, 8.0)], "n int, name string, v double, `two words` double")
    ids = lambda text: [r["n"] for r in filters.where_text(df, text).orderBy("n").collect()]
    for text, want in [
        ("name == 'A&B'", [1]), ('name == "a | b == c"', [2]), ("~(n > 1)", [1]), ("not n > 1", [1]), ("n in [1, 2]", [1, 2]), ("n not in [1, 2]", [3, 4]), ("1 < n <= 3", [2, 3]), ("n > 1 & n < 4", [2, 3]),
        ("n == 1 | n == 4 & v > 3", [1, 4]), ("`two words` > 5", [3, 4]), ("v != 1", [2, 3, 4]), ("~(v > 1)", [1, 3]), ("(n > 1) && (n < 3) || n == 4", [2, 4]), ("name in ['x', \"it's\"]", [3, 4]), ("abs(n - 3) < 1.5 and v * 2 ** 2 >= 8", [2, 4]),
        ("n in [-1, 4]", [4]), ("-n < -3", [4]), ("n % 2 == 0", [2, 4]), ("v / 0 > 1", []),
    ]:
        assert ids(text) == want, text
    for text in ("n[0] > 1", "n.v > 1", "lambda: 1"):
        with pytest.raises(ValueError):
            ids(text)


def test_ranks_of_many_columns(spark):
    rng = np.random.default_rng(2)
    n = 300
    table = {f"c{i}": [None if rng.random() < 0.1 else float(np.round(x, 1)) for x in rng.normal(size=n)] for i in range(41)}
    table["c3"][5], table["c4"] = float("nan"), [1.0] * n
    table["c5"] = [None] * n
    target = [None if rng.random() < 0.05 else float(np.round(x)) for x in rng.normal(0, 3, n)]
    df = spark.createDataFrame(list(zip(*table.values(), target, strict=True)), ", ".join(f"{c} double" for c in table) + ", t double")
    out = audit.spearman(df, list(table), "t")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation") < 12  # whatever the number of columns
    got = {r["feature"]: r["rho"] for r in out.collect()}
    import pandas as pd

    pdf = pd.DataFrame(table | {"t": target}, dtype=float)
    for c in table:
        both = pdf[[c, "t"]].dropna().rank()
        want = both[c].corr(both["t"]) if len(both) else float("nan")
        assert got[c] is None if math.isnan(want) else got[c] == pytest.approx(want, abs=1e-9)


def test_ranks_keep_rows_without_a_value(spark):
    df = spark.createDataFrame([(1, 3.0), (2, None), (3, 3.0), (4, 1.0)], "i int, v double")
    assert sorted((r["i"], r["k"]) for r in audit.rank_average(df, "v", "k").collect()) == [(1, 2.5), (2, None), (3, 2.5), (4, 1.0)]
