"""Motion, registries, model bundles and the enhanced ground truth."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraline.operators import kinematics, learning
from terraline.plans import routes
from terraline.sources import registry


def test_kalman():
    still = kinematics.Kalman()
    for _ in range(10):
        still.predict(0, 0, 0.1)
        still.update(100.0, 200.0, 0.0)
    assert abs(still.x[0] - 100) < 5 and abs(still.x[1] - 200) < 5 and abs(still.x[2]) < 0.5
    moving = kinematics.Kalman()
    for i in range(100):
        moving.predict(0, 0, 0.1)
        moving.update(100.0 + i, 200.0, 10.0)
    assert 9 < moving.x[2] < 11 and moving.x[0] > 105 and (np.linalg.eigvalsh(moving.P) > 0).all()
    moving.x = np.array([100.0, 200.0, 5.0, 0.1])
    J = moving.jacobian(0.1)
    for j in range(4):
        ends = []
        for d in (1e-6, -1e-6):
            k = kinematics.Kalman()
            k.x = np.array([100.0, 200.0, 5.0, 0.1])
            k.x[j] += d
            k.predict(0, 0, 0.1)
            ends.append(k.x)
        assert np.allclose((ends[0] - ends[1]) / 2e-6, J[:, j], atol=1e-6)


def test_kalman_tracks(spark):
    rows = [(k, 0.1 * i, 100.0 + i, None if i == 5 else 200.0, 10.0, 1.0, 0.0, 0.0) for k in ("a", "b") for i in range(60)]
    df = spark.createDataFrame(rows, "k string, t double, x double, y double, v double, h double, a double, w double").repartition(5)
    got = kinematics.kalman_track(df, "k", "t", "x", "y", "v", "h", "a", "w").toPandas().sort_values(["k", "t"])
    assert len(got) == 120
    want, last = kinematics.Kalman(), 0.0
    for _, t, x, y, v, h, a, w in rows[:60]:
        want.predict(a, w, t - last)
        last = t
        if y is not None:
            want.update(x, y, v, h)
    for k in ("a", "b"):
        assert np.allclose(got[got["k"] == k].iloc[-1][["ekf_x", "ekf_y", "ekf_speed", "ekf_heading"]].to_numpy(float), want.x)


def test_registry(spark, tmp_path):
    body = 'device_id: "27"  # unit\nname: x\n\nstability_model:\n  k1: 1.50  # note\n  k2: 1.5\n  k4_mm: 1100\n  d1_m: 0.96\n  coeff: 2.13\n  s_mm: 1880\n  alphav: 45\n\nterrain:\n  vehicle_track: 1880\nhardware:\n  k1: 9\n'
    (tmp_path / "a.yaml").write_text(body)
    (tmp_path / "b.yaml").write_text(body.replace("27", "28").replace("  coeff: 2.13\n", ""))
    (tmp_path / "c.yaml").write_text("name: nobody\n")
    (tmp_path / "d.yaml").write_text("")
    got = {r["device_id"]: r for r in registry.read_registry(spark, str(tmp_path)).collect()}
    assert set(got) == {"27", "28"} and got["27"]["valid"] and not got["28"]["valid"]
    assert (got["27"]["k1"], got["27"]["d1_m"], got["27"]["alphav"], got["28"]["coeff"]) == (1.5, 0.96, 45.0, None)


def test_enhanced_ground_truth(spark):
    df = spark.range(30).select(F.col("id"), F.lit(0.4).alias("si"), (F.col("id") / 3).alias("roll"), (F.col("id") * 10.0).alias("ay"), F.lit(0.1).alias("omega_rad_s"), F.radians(2 + F.sin("id")).alias("phi_lidar"))
    names = ["si_real", "si_static_imu", "si_static_lidar", "si_static_fused", "si_dynamic_obs", "si_pred_obs_w", "delta_si_static_fused", "delta_si_pred_obs_w", "omega_rad_s"]
    a, b = (routes.enhanced_ground_truth(df.withColumn("phi_lidar", F.col("phi_lidar") * k)).select(names).toPandas() for k in (1, 2))
    assert np.isfinite(a.to_numpy(float)).all() and np.abs(a["si_static_fused"] - b["si_static_fused"]).mean() > 1e-4


def test_bundle(spark, tmp_path):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(x), float(y), float(x * 2 + y)) for x, y in rng.random((80, 2))], "a double, b double, t double")
    fitted = learning.fit(df, ["a", "b"], "t", learning.Run("random_forest", {"numTrees": 3}))
    trials = spark.createDataFrame([(0, 0.5, 0.6), (1, 0.7, 0.6)], "trial int, holdout_r2 double, cv_r2 double")
    learning.save_bundle(fitted, trials, str(tmp_path / "m"))
    assert [r["trial"] for r in spark.read.option("header", True).csv(f"{tmp_path}/m/leaderboard").collect()] == ["1", "0"]
    from pyspark.ml.regression import RandomForestRegressionModel

    again = RandomForestRegressionModel.load(f"{tmp_path}/m/model")
    assert again.getNumTrees == 3
    out = learning.holdout_table(learning.predict(fitted, df), "t").first()
    assert out["residual"] == pytest.approx(out["t"] - out["prediction"])


def test_holdout_by_group(spark):
    df = spark.range(1000).select((F.col("id") % 50).alias("g"))
    train, held = learning.holdout_by_group(df, "g", 0.2)
    a, b = {r["g"] for r in train.collect()}, {r["g"] for r in held.collect()}
    assert len(b) == 10 and not a & b and len(a) == 40
