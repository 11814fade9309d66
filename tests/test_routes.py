"""Stages end to end on hand-built logs, artifacts and rasters."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraline.operators import elevation, filters
from terraline.plans import routes
from terraline.sources import geotiff, logs, network, stages


def write_logs(folder):
    gps = ["GPS;14/08/2025 08:00:00;UNIT027;1;0", "head"]
    for i in range(40):
        lat, lon = 40.5 + i * 1e-4, -3.6
        gps.append(f"Hora Raspberry-10:00:{i:02d},14/08/2025,Hora GPS-08:00:{i:02d},{lat},{lon},650,{9.0 if i == 7 else 1.0},1,8,30.0")
    imu = ["ESTABILIDAD;14/08/2025 08:00:00;UNIT027;Sesion:1;", "ax;ay;az;"]
    for i in range(1, 40):
        imu += [";".join([str(0.1 * i)] * 19), f"08:00:{i:02d}"]
    (folder / "GPS_UNIT027_20250814.txt").write_text("\n".join(gps), encoding="latin-1")
    (folder / "ESTABILIDAD_UNIT027_20250814.txt").write_text("\n".join(imu), encoding="latin-1")


def test_raw_to_matched_to_terrain(spark, tmp_path):
    write_logs(tmp_path)
    raw = logs.lines(spark, str(tmp_path))
    rows, ledger = routes.process_routes(raw.where("file like 'GPS%'"), raw.where("file like 'EST%'"), routes.RouteConfig(imu_outliers=False))
    rows = rows.persist()
    assert rows.count() == 39 and {r["reason"] for r in ledger.collect()} == {"gps_hdop_gt_5.0"}
    assert [r["n_rows"] for r in stages.route_report(rows).collect()] == [39]
    edges = spark.createDataFrame([(5, [(-3.6001, 40.49), (-3.6001, 40.52)], "main", "M1", "primary")], "edge_id long, coords array<struct<lon: double, lat: double>>, name string, ref string, highway string")
    got = routes.match_routes(rows, edges)
    r = got.orderBy("imu_line").first()
    assert got.where("edge_id = 5").count() == 39 and r["lon"] == pytest.approx(-3.6001, abs=1e-6) and r["lon_raw"] == -3.6 and r["road_name"] == "main"
    box = rows.agg(F.min("x_utm"), F.min("y_utm")).first()
    cloud = spark.createDataFrame([(box[0] + 6.0 * i, box[1] + 12.0 * j, 600.0 + i) for i in range(-12, 12) for j in range(-6, 45)], "x double, y double, z double")
    full = routes.enrich_terrain(rows, cloud, network.device_registry(spark), radius=30.0, size=16).collect()
    assert len(full) == 39 and all(r["k1"] == 1.5 and r["z_range"] > 0 for r in full)


def test_formatted_scans(spark, tmp_path):
    write_logs(tmp_path)
    raw = logs.lines(spark, str(tmp_path))
    g = logs.parse_gps_formatted(raw.where("file like 'GPS%'"))
    assert g.count() == 40 and g.first()["speed_ms"] == pytest.approx(30 / 3.6)
    i = logs.parse_imu_formatted(raw.where("file like 'EST%'"))
    assert i.count() == 39 and i.where("risk is null").count() == 0
    assert logs.imu_values(raw.where("file like 'EST%'")).count() == 39
    k = logs.imu_row_classes(raw.where("file like 'EST%'")).first()
    assert (k["data_rows"], k["marker_rows"], k["header_rows"]) == (39, 39, 1)
    assert logs.loose_row_count(raw.where("file like 'GPS%'")).first()["n_rows"] == 40
    assert logs.pair_files(raw.where("file like 'GPS%'").select("path").distinct(), raw.where("file like 'EST%'").select("path").distinct()).count() == 1


def test_stage_files_and_artifacts(spark, tmp_path):
    for n, body in (("A_seg2", "x,n_points_used\n1,0\n"), ("A", "x,n_points_used\n1,3\n2,\n"), ("B", "x\n5\n")):
        (tmp_path / f"{n}.csv").write_text(body)
    files = stages.listing(spark, f"{tmp_path}/*.csv")
    assert [r["stem"] for r in stages.segment_files(files, "A").collect()] == ["A", "A_seg2"]
    assert stages.select_files(files, ["A"]).count() == 2 and stages.select_files(files, most=1).count() == 1
    df = stages.read_union(spark, [[f"{tmp_path}/A.csv", f"{tmp_path}/A_seg2.csv"], f"{tmp_path}/B.csv"])
    assert df.count() == 4
    seen = {r["source_file"]: r["has_values"] for r in stages.has_feature_values(df, ["n_points_used"]).collect()}
    assert seen == {"A.csv": True, "A_seg2.csv": False, "B.csv": False}
    assert {(r["base"], r["files"], r["n_rows"]) for r in stages.rows_by_base(df).collect()} == {("A", 2, 3), ("B", 1, 1)}
    (tmp_path / "t.json").write_text(json.dumps([{"trial": 0, "model": "m", "cv_fold_r2s": [0.5, 0.7], "holdout_r2": 0.8}, {"trial": 1, "model": "m", "cv_r2": 0.9, "holdout_r2": 0.6}]))
    trials = stages.read_trials(spark, str(tmp_path / "t.json"))
    assert [r["trial"] for r in stages.leaderboard(trials).collect()] == [0, 1] and stages.leaderboard(trials).first()["cv_r2"] == pytest.approx(0.6)
    best = stages.best_by_model(trials).first()
    assert best["trial"] == 0 and best["meets_target"]
    (tmp_path / "s.json").write_text(json.dumps({"filter_steps": [{"source_key": "a", "stage": "gps", "filter_name": "f", "before_rows": 5, "dropped_rows": 0, "after_rows": 5}]}))
    steps = stages.read_filter_steps(spark, str(tmp_path / "s.json"))
    empty = spark.createDataFrame([], "stage string, reason string, dropped_rows long, pct double")
    assert stages.explain_discards(empty, steps).first()["dropped_rows"] == 0


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("k", 1, 1.5), ("k", 2, 2.5)], "source_key string, segment_id int, v double")
    stages.write_stage(df, f"{tmp_path}/stage")
    assert spark.read.parquet(f"{tmp_path}/stage").where("segment_id = 2").count() == 1
    stages.write_fixed(df, f"{tmp_path}/fixed", {"source_key": "%s", "v": "%.2f"})
    assert {r[0] for r in spark.read.text(f"{tmp_path}/fixed").collect()} == {"k;1.50", "k;2.50"}
    ledger = filters.drop_ledger(df.withColumn("drop_reason", F.lit("r")), "gps", "source_key")
    stages.write_ledger(ledger.drop("source_key").withColumn("source_key", F.lit("k")), f"{tmp_path}/ledger")
    assert spark.read.json(f"{tmp_path}/ledger/summary").first()["pct"] == 100.0
    assert sum(r["n"] for r in stages.histogram(df, "v").collect()) == 2 and stages.color_limits(df, "v").count() == 1


def write_tiff(path, z, nodata=-9999.0):
    h, w = z.shape
    body = z.astype("<f4").tobytes()
    text = f"{nodata}".encode() + b"\0"
    extra = struct.pack("<3d", 2.0, 2.0, 0.0) + struct.pack("<6d", 0, 0, 0, 100.0, 200.0, 0) + text
    start = 8 + len(body)
    at = start + len(extra)
    entries = [(256, 4, 1, w), (257, 4, 1, h), (258, 3, 1, 32), (259, 3, 1, 1), (273, 4, 1, 8), (277, 3, 1, 1), (279, 4, 1, len(body)), (339, 3, 1, 3), (33550, 12, 3, start), (33922, 12, 6, start + 24), (42113, 2, len(text), start + 72)]
    path.write_bytes(b"II" + struct.pack("<HI", 42, at) + body + extra + struct.pack("<H", len(entries)) + b"".join(struct.pack("<HHII", *e) for e in entries) + b"\0" * 4)


def test_geotiff_and_elevation(spark, tmp_path):
    z = np.arange(30, dtype=float).reshape(5, 6)
    z[4, 5] = -9999
    write_tiff(tmp_path / "d.tif", z)
    spark.dataSource.register(geotiff.GeoTiffSource)
    cells = spark.read.format("geotiff").option("path", str(tmp_path / "d.tif")).load().persist()
    s = geotiff.raster_stats(cells).first()
    assert (s["n_cells"], s["n_nodata"], s["z_max"], s["x_min"], s["y_max"]) == (29, 1, 28.0, 101.0, 199.0)
    points = spark.createDataFrame([(1, 104.0, 196.0), (2, 111.0, 191.0), (3, 500.0, 0.0)], "id int, x double, y double")
    cloud = spark.createDataFrame([(111.2, 191.0, 50.0), (110.8, 191.0, 52.0)], "x double, y double, z double")
    got = {r["id"]: r["z"] for r in elevation.elevation(points, "id", cloud, cells, 101.0, 199.0, 2.0).collect()}
    assert got == {1: pytest.approx(10.5), 2: 51.0, 3: None}
    assert [r["covered"] for r in elevation.covered(points, cloud, "id").orderBy("id").collect()] == [False, True, False]
    with pytest.raises(ValueError):
        elevation.elevation(points, "id", None, None)


def test_nearest_grid(spark):
    cloud = spark.createDataFrame([(0.1, 0.0, 1.0), (2.0, 0.1, 2.0), (0.0, 3.0, 3.0), (2.1, 3.0, 4.0)], "x double, y double, z double")
    got = {(r["row"], r["col"]): r["z"] for r in elevation.nearest_grid(cloud, 0.0, 0.0, 3, 4).collect()}
    assert len(got) == 12 and (got[0, 0], got[0, 2], got[3, 0], got[3, 2]) == (1.0, 2.0, 3.0, 4.0)
    assert elevation.nearest_grid(cloud.limit(3), 0.0, 0.0, 3, 4).where("z is not null").count() == 0
