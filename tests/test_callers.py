"""Operators whose results aren't SQL: samples, importances, artifacts on disk, the session."""

import numpy as np
from pyspark.sql import functions as F

from terraline import session
from terraline.operators import filters, learning
from terraline.sources import stages


def test_seeded_sample(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), "id")
    one = filters.seeded_sample(df, ["g"], "id", 20)
    rows = sorted(map(tuple, one.collect()))
    assert len(rows) == 60 and rows == sorted(map(tuple, filters.seeded_sample(df.repartition(7), ["g"], "id", 20).collect()))
    assert rows != sorted(map(tuple, filters.seeded_sample(df, ["g"], "id", 20, seed=1).collect()))


def test_importances(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(float(a), float(b), float(10 * a)) for a, b in rng.random((300, 2))], "a double, b double, y double")
    fitted = learning.fit(df, ["a", "b"], "y", learning.Run("random_forest", {"numTrees": 5, "maxDepth": 4}))
    loss = learning.permutation_importance(fitted, df, ["a", "b"], "y")
    assert loss["a"] > 0.5 > abs(loss["b"]) and learning.importances(fitted, ["a", "b"])[0][0] == "a"


def test_artifacts_on_disk(spark, tmp_path):
    csvs = spark.createDataFrame([("r1_dropped", "p1"), ("r2_outliers", "p2")], "stem string, path string")
    jsons = spark.createDataFrame([("r1_summary", "j1"), ("r3_summary", "j3")], "stem string, path string")
    assert sorted(map(tuple, stages.pair_artifacts(csvs, jsons).collect())) == [("r1", "p1", "j1"), ("r2", "p2", None), ("r3", None, "j3")]
    (tmp_path / "tiles.txt").write_text("# head\n\n a \nb\n")
    assert [r["tile"] for r in stages.tile_list(spark, str(tmp_path / "tiles.txt")).collect()] == ["a", "b"]
    stages.write_csv(spark.createDataFrame([(1, "x,y")], "a int, b string"), str(tmp_path / "out"))
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "out")).collect()] == [("1", "x,y")]
    assert stages.resolve_column(csvs, ["PATH", "stem"]) == "stem" and stages.resolve_column(csvs, ["PATH"]) == "path" and stages.resolve_column(csvs, ["z"]) is None


def test_session_settings(spark):
    assert session.get_session().conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
