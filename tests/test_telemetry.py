"""Golden cases of the telemetry operators, and pandas or brute-force versions on seeded rows."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terraline.functions import geo, naming, stability
from terraline.operators import asof, audit, filters, learning, matcher, ordered, spatial, terrain
from terraline.plans import registry
from terraline.sources import logs, network

T0 = dt.datetime(2025, 10, 1, 12)


def at(s):
    return T0 + dt.timedelta(seconds=s)


def stream(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_asof_tolerance_and_ties(spark):
    left = stream(spark, [(1, at(0.5), 0.2), (1, at(5), 0.3), (2, at(0), 0.1)], "k int, ts timestamp_ntz, si double")
    right = stream(spark, [(1, 1, at(0), 10.0), (1, 2, at(2), 20.0), (1, 3, at(0), 11.0)], "k int, id int, ts timestamp_ntz, lat double")
    got = asof.nearest_asof(left, right, ["k"], "ts", 1_000_000, ["lat"], "id").collect()
    assert [(r["si"], r["lat_r"]) for r in got] == [(0.2, 11.0)]  # of equal times the last
    kept = asof.nearest_asof(left, right, ["k"], "ts", 1_000_000, ["lat"], "id", how="left").collect()
    assert len(kept) == 3
    tie = stream(spark, [(1, at(1), 0.0)], "k int, ts timestamp_ntz, si double")
    assert asof.nearest_asof(tie, right, ["k"], "ts", 1_000_000, ["lat"], "id").first()["lat_r"] == 11.0  # the earlier


def test_asof_against_pandas(spark):
    rng = np.random.default_rng(0)
    l_ = pd.DataFrame({"k": rng.integers(0, 3, 200), "ts": [at(int(x)) for x in rng.integers(0, 2000, 200)], "id": range(200)})
    r = pd.DataFrame({"k": rng.integers(0, 3, 80), "ts": [at(int(x)) for x in rng.integers(0, 2000, 80)], "rid": range(80)})
    got = asof.nearest_asof(spark.createDataFrame(l_, "k long, ts timestamp_ntz, id long"), spark.createDataFrame(r, "k long, ts timestamp_ntz, rid long"), ["k"], "ts", 30_000_000, ["rid"], "rid").toPandas()
    want = {}
    for row in l_.itertuples():
        own = r[r.k == row.k]
        best = min(((abs((x.ts - row.ts).total_seconds()), x.ts, -x.rid) for x in own.itertuples()), default=None)
        if best and best[0] <= 30:
            want[row.id] = -best[2]
    assert dict(zip(got["id"], got["rid_r"], strict=True)) == want


def test_asof_across_stretches_of_time(spark, monkeypatch):
    """One hot key, stretches of 16 s: partners across their bounds, a null time and equal distances."""
    monkeypatch.setattr(asof, "LEAST_US", 16_000_000)
    rng = np.random.default_rng(5)
    l_ = [(1, at(float(x)), i) for i, x in enumerate(rng.integers(0, 1200, 300) / 4)] + [(1, None, 300), (None, at(3), 301)]
    r = [(1, at(float(x)), i) for i, x in enumerate(rng.integers(0, 1200, 150) / 4)] + [(None, at(3.5), 150)]
    got = asof.nearest_asof(spark.createDataFrame(l_, "k long, ts timestamp_ntz, id long"), spark.createDataFrame(r, "k long, ts timestamp_ntz, rid long"), ["k"], "ts", 1_000_000, ["rid"], "rid", how="left").collect()
    want = {}
    for k, ts, i in l_:
        best = min(((abs((t - ts).total_seconds()), t, -j) for key, t, j in r if key == k and ts is not None), default=None)
        want[i] = -best[2] if best and best[0] <= 1 else None
    assert len(got) == len(l_) and {x["id"]: x["rid_r"] for x in got} == want


def test_filters_partition_the_rows(spark):
    rows = [(i, 40.0 if i % 3 else None, -3.0, 650.0, 30.0 + 10 * i, 1.0, 1, 8) for i in range(30)]
    df = stream(spark, rows, "id int, lat double, lon double, alt double, speed_kmh double, hdop double, fix int, numsats int")
    tagged = filters.tag(df, filters.gps_rules())
    assert filters.kept(tagged).count() + filters.dropped(tagged).count() == 30
    steps = filters.filter_steps(tagged, filters.gps_rules()).orderBy("step").collect()
    assert steps[0]["dropped_rows"] == 10 and steps[-1]["after_rows"] == filters.kept(tagged).count()
    assert all(a["after_rows"] == b["before_rows"] for a, b in zip(steps, steps[1:], strict=False))


def test_isolated_and_jump(spark):
    df = stream(spark, [(1, 0, 0.0, 0.0), (1, 1, 1.0, 0.0), (1, 2, 2.0, 0.0), (1, 3, 1000.0, 0.0)], "k int, n int, x double, y double")
    assert filters.kept(filters.isolated_filter(df, ["k"], ["n"], "x", "y", 5.0, 1, 1)).count() == 3
    assert {r["n"] for r in filters.kept(filters.jump_filter(df, ["k"], ["n"], "x", "y", 100.0)).collect()} == {0, 1}


def test_segments(spark):
    rows = [(1, i, float(i)) for i in range(12)] + [(1, 12 + i, 2000.0 + i) for i in range(10)] + [(2, 0, 0.0)]
    df = stream(spark, rows, "k int, n int, x double").withColumn("y", F.lit(0.0))
    got = ordered.split_segments(df, ["k"], ["n"], ordered.distance_break(["k"], ["n"], "x", "y", 1000.0))
    assert {(r["k"], r["segment_id"]): r["count"] for r in got.groupBy("k", "segment_id").count().collect()} == {(1, 1): 12, (2, 1): 1}


def test_interpolate_against_pandas(spark):
    rng = np.random.default_rng(1)
    v = np.where(rng.random(100) < 0.5, np.nan, rng.random(100))
    df = stream(spark, [(1, i, None if np.isnan(x) else float(x)) for i, x in enumerate(v)], "k int, i int, v double")
    got = [r["v"] for r in ordered.interpolate(df, ["k"], ["i"], ["v"]).orderBy("i").collect()]
    assert np.allclose(got, pd.Series(v).interpolate("linear", limit_direction="both"))


def test_utm_and_bearing(spark):
    e, n = geo.utm_forward(F.lit(-3.0), F.lit(40.0))
    r = spark.range(1).select(e.alias("e"), n.alias("n"), geo.bearing_deg(F.lit(1.0), F.lit(0.0)).alias("b"), geo.angular_diff(F.lit(350.0), F.lit(10.0)).alias("d")).first()
    assert r["e"] == pytest.approx(500_000) and r["n"] == pytest.approx(4_427_757.2, abs=0.1) and r["b"] == 90 and r["d"] == pytest.approx(20)


def test_stability(spark):
    c = [stability.si_color(F.lit(x)) for x in (0.0, 1.0, -1.0, 2.0)]
    r = spark.range(1).select(*[x.alias(f"c{i}") for i, x in enumerate(c)], stability.critical_angle_deg(F.lit(2.48), F.lit(1.85)).alias("a"), stability.si_static_risk(F.lit(0.0), F.lit(33.8)).alias("z"), stability.si_static_risk(F.lit(33.8), F.lit(33.8)).alias("o")).first()
    assert [r[f"c{i}"] for i in range(4)] == ["#FF0000", "#00AA00", "#FF0000", "#00AA00"]
    assert 33 < r["a"] < 34 and r["z"] == 0 and r["o"] == pytest.approx(1)


def test_names(spark):
    df = stream(spark, [("GPS_UNIT024_20251001.txt",), ("GPS_UNIT024_realtime.txt",), ("x",)], "n string")
    assert [r[0] for r in df.select(naming.pair_key(F.col("n"), "GPS")).collect()] == ["UNIT024_20251001", None, None]
    r = spark.range(1).select(naming.normalize_device(F.lit("23"), "UNIT"), naming.base_name(F.lit("A_seg12")), naming.device_of(F.lit("UNIT027_1")), naming.loose_double(F.lit(" 1,5 "))).first()
    assert tuple(r) == ("UNIT023", "A", "27", 1.5)


def test_tile_names(spark):
    r = spark.range(1).select(
        naming.normalize_tile_name(F.lit(" a_1.las ")).alias("n"), naming.tile_variants(F.lit("a-1")).alias("v"), naming.tile_variants(F.lit(" ")).alias("e"),
        naming.disposition_file(F.lit('attachment; filename="x.laz"; size=3')).alias("f"), naming.disposition_file(F.lit("inline")).alias("z"),
    ).first()
    assert r["n"] == "A-1.LAZ" and r["v"] == ["A-1.LAZ", "A_1.LAZ", "a-1", "a-1.laz", "a_1.laz"] and r["e"] == [] and r["f"] == "x.laz" and r["z"] is None


def test_gps_log(spark, tmp_path):
    good = "Hora Raspberry-10:33:29,14/08/2025,Hora GPS-08:33:27,40.54,-3.62,650,1.2,1,8,35.0"
    body = ["GPS;14/08/2025 10:33:28;UNIT027;34;0", "head", good, "", "sin datos GPS,,,,,,,,,", "a,b,c", good.replace(",1,8,", ",1.0,8,"), good.replace("14/08/2025", "99/99/2025")]
    (tmp_path / "GPS_UNIT027_1.txt").write_text("\n".join(body), encoding="latin-1")
    raw = logs.lines(spark, str(tmp_path))
    rows = logs.parse_gps(raw).collect()
    assert len(rows) == 1 and rows[0]["timestamp"] == dt.datetime(2025, 8, 14, 8, 33, 27) and rows[0]["line_no"] == 2
    k = logs.gps_row_classes(raw).first()
    assert (k["raw_rows"], k["no_fix_rows"], k["malformed_rows"]) == (5, 1, 1)


def imu_times(spark, folder, body):
    folder.mkdir()
    (folder / "ESTABILIDAD_UNIT023_1.txt").write_text("\n".join(body), encoding="latin-1")
    return logs.parse_imu(logs.lines(spark, str(folder))).orderBy("line_no").collect()


def test_imu_log_clock(spark, tmp_path):
    row, day = ";".join(["1.0"] * 19), lambda h, m, s, us=0, d=20: dt.datetime(2025, 10, d, h, m, s, us)
    body = ["ESTABILIDAD;20/10/2025 23:59:57;UNIT023;Sesion:1;", "ax;ay;az;", row, row, "23:59:59", row, "00:00:00", "00:00:00", row + ";7.0", "1;2", row]
    rows = imu_times(spark, tmp_path / "a", body)
    assert [r["timestamp"] for r in rows] == [day(23, 59, 57, 500_000), day(23, 59, 58), day(0, 0, 0, d=21), day(0, 0, 1, 500_000, 21), day(0, 0, 2, d=21)]
    assert rows[3]["extra"] == {"col_19": 7.0} and rows[0]["k3"] == 1.0
    # a time that doesn't exist and a head without a date are skipped, a dated head begins anew
    body = ["ESTABILIDAD;20/10/2025 10:00:00;U;", "ax;", row, "25:61:61", row, "10:00:04", row, "ESTABILIDAD;no date;", row, "ESTABILIDAD;20/10/2025 12:00:00;", row, "12:00:09", row, row, row, row]
    got = [r["timestamp"] for r in imu_times(spark, tmp_path / "b", body)]
    assert got == [day(10, 0, 0, 500_000), day(10, 0, 1), day(10, 0, 4, 500_000), day(10, 0, 5), day(12, 0, 1), *(day(12, 0, 9 + k // 4, 250_000 * (k % 4)) for k in (1, 2, 3, 4))]
    # rows before the first date count from it, markers there don't; no date at all leaves nothing
    assert [r["timestamp"] for r in imu_times(spark, tmp_path / "c", ["x", "ax;", row, "09:00:00", row, "ESTABILIDAD;20/10/2025 12:00:00;", row])] == [day(12, 0, 0, 500_000), day(12, 0, 1), day(12, 0, 1)]
    assert imu_times(spark, tmp_path / "d", ["x", "ax;", row, "09:00:00", row]) == []


def test_graphml_and_wkt(spark, tmp_path):
    text = """<?xml version="1.0"?><graphml><key id="d0" for="node" attr.name="x" attr.type="string"/><key id="d1" for="node" attr.name="y" attr.type="string"/>
<key id="d2" for="edge" attr.name="highway" attr.type="string"/><key id="d3" for="edge" attr.name="geometry" attr.type="string"/><graph>
<node id="1"><data key="d0">-3.0</data><data key="d1">40.0</data></node><node id="2"><data key="d0">-3.1</data><data key="d1">40.1</data></node>
<edge source="1" target="2"><data key="d2">footway</data></edge><edge source="1" target="2"><data key="d2">primary</data></edge>
<edge source="1" target="2"><data key="d2">service</data><data key="d3">LINESTRING (-3 40, -3.05 40.02, -3.1 40.1)</data></edge></graph></graphml>"""
    (tmp_path / "n.graphml").write_text(text)
    got = network.read_graphml(spark, str(tmp_path / "n.graphml")).orderBy("edge_id").collect()
    assert [(r["edge_id"], r["highway"], len(r["coords"])) for r in got] == [(0, "primary", 2), (1, "service", 3)]


def test_devices(spark):
    df = stream(spark, [("27",)], "d string")
    r = network.device_join(df, network.device_registry(spark), "d").first()
    assert (r["k1"], r["d1_m"], r["alphav"]) == (1.5, 0.96, 45.0)
    with pytest.raises(Exception, match="no constants"):
        network.device_join(stream(spark, [("99",)], "d string"), network.device_registry(spark), "d").collect()


def test_las(spark, tmp_path):
    rec = np.zeros(3, np.dtype([("x", "<i4"), ("y", "<i4"), ("z", "<i4"), ("i", "<u2"), ("f", "u1"), ("cls", "u1"), ("rest", "V4")]))
    rec["x"], rec["cls"] = [1, 2, 3], [2, 1, 2]
    head = bytearray(227)
    head[:4], head[24], head[25] = b"LASF", 1, 2
    head[96:100], head[104], head[105:107], head[107:111] = (227).to_bytes(4, "little"), 0, rec.itemsize.to_bytes(2, "little"), (3).to_bytes(4, "little")
    head[131:155] = np.array([0.5, 1, 1], "<f8").tobytes()
    (tmp_path / "a.las").write_bytes(bytes(head) + rec.tobytes())
    spark.dataSource.register(network.LasSource)
    points = spark.read.format("las").option("path", str(tmp_path / "a.las")).load()
    assert sorted(r["x"] for r in network.ground_points(points).collect()) == [0.5, 1.5]


def test_knn_reaches_far_points(spark):
    p = stream(spark, [(1, 0.0, 0.0), (2, 5000.0, 0.0)], "id int, x double, y double")
    o = stream(spark, [(i, float(i), 0.0) for i in range(4)], "oid int, ox double, oy double")
    got = spatial.knn_join(p, o, 2, "id", "oid", 1.0).collect()
    assert {(r["id"], r["oid"], r["rank"]) for r in got} == {(1, 0, 1), (1, 1, 2), (2, 3, 1), (2, 2, 2)}


def test_streamed_tracks_match_gathered_tracks(spark):
    rng = np.random.default_rng(4)
    edges = spark.createDataFrame([(k, [(float(k % 5) * 40, -50.0 + k), (float(k % 5) * 40 + 9, 260.0 - k)]) for k in range(10)], "edge_id long, coords array<struct<x: double, y: double>>")
    walk = [(t, i, float(x), float(y)) for t, n in (("a", 60), ("b", 1), (None, 25), ("c", 40)) for i, (x, y) in enumerate(np.cumsum(rng.normal(3, 9, (n, 2)), 0))]
    walk += [("c", 100 + i, 5000.0, 5000.0) for i in range(3)] + [("c", 110 + i, 40.0, 20.0 + 9 * i) for i in range(8)]  # far off, then back
    points = spark.createDataFrame(walk, "track string, ord long, x double, y double").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # tracks cross batches
    try:
        rows = lambda **kw: sorted(map(tuple, matcher.match_tracks(points, edges, cfg=matcher.MatchConfig(max_dist_m=60.0, **kw)).collect()), key=repr)
        got = rows()
        assert len(got) == len(walk) and {r[0] is None for r in got} == {True, False}
        assert got == rows(smooth_min_run=2, smooth_passes=0)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_matcher(spark):
    edges = stream(spark, [(0, [(0.0, 0.0), (500.0, 0.0)], "main"), (1, [(0.0, 40.0), (500.0, 40.0)], "side"), (2, [(0.0, 9000.0), (1.0, 9000.0)], "far")], "edge_id long, coords array<struct<x: double, y: double>>, name string")
    points = stream(spark, [("t", i, 20.0 * i, 3.0 + (i == 5) * 18.5) for i in range(12)] + [("t", 12, 0.0, 5000.0)], "track string, ord int, x double, y double")
    got = matcher.match_tracks(points, edges).orderBy("ord").collect()
    assert [r["edge_id"] for r in got] == [0] * 12 + [None]  # hysteresis holds the road at the outlier
    assert all(r["dist_to_road_m"] <= 150 for r in got[:-1]) and got[0]["y"] == 0.0 and got[-1]["y"] == 5000.0


def test_smoothing_needs_short_runs():
    assert matcher.smooth([1, 1, 2, 1, 1], min_run=1) == [1, 1, 2, 1, 1]
    assert matcher.smooth([1, 1, 2, 1, 1], min_run=2) == [1, 1, 1, 1, 1]
    assert matcher.smooth([1, 1, 2, 3, 3], 2, 2) == [1, 1, 1, 3, 3]
    assert matcher.smooth([1, 1, None, 1, 5], 2, 2) == [1, 1, 1, 1, 1]
    assert matcher.smooth([4, 5], 2, 2) == [4, 5] and matcher.smooth([], 2, 2) == []


def test_smoothed_rows_are_projected(spark):
    edges = spark.createDataFrame([(1, [(0.0, 0.0), (100.0, 0.0)]), (2, [(48.0, 300.0), (52.0, 300.0)])], "edge_id long, coords array<struct<x: double, y: double>>")
    points = spark.createDataFrame([("t", i, x, y) for i, (x, y) in enumerate([(10.0, 1.0), (30.0, 1.0), (50.0, 290.0), (70.0, 1.0), (90.0, 1.0)])], "track string, ord int, x double, y double")
    got = {r["ord"]: r for r in matcher.match_tracks(points, edges, cfg=matcher.MatchConfig(max_dist_m=50.0, smooth_min_run=2)).collect()}
    assert (got[2]["edge_id"], got[2]["x"], got[2]["y"], got[2]["dist_to_road_m"], got[2]["y_raw"]) == (1, 50.0, 0.0, 290.0, 290.0)
    plain = {r["ord"]: r["edge_id"] for r in matcher.match_tracks(points, edges, cfg=matcher.MatchConfig(max_dist_m=50.0)).collect()}
    assert plain == {0: 1, 1: 1, 2: 2, 3: 1, 4: 1}


def test_terrain_fall_backs(spark):
    cells = [("flat", r, c, float(c)) for r in range(3) for c in range(4)] + [("gap", r, c, None if r == 1 else float(c)) for r in range(3) for c in range(4)] + [("tiny", 0, c, 1.0 if c else None) for c in range(3)]
    df = spark.createDataFrame(cells, "g string, row int, col int, z double")
    phi = {r["g"]: r["phi_lidar"] for r in terrain.phi_lidar(df, ["g"]).collect()}
    grid = np.array([[0, 1, 2, 3], [1.5] * 4, [0, 1, 2, 3]])
    assert phi["flat"] == pytest.approx(np.pi / 4) and phi["gap"] == pytest.approx(terrain._slopes(grid).mean())
    rough = {r["g"]: r["ruggedness"] for r in terrain.ruggedness(df, ["g"]).collect()}
    assert rough["flat"] == pytest.approx(9 / 17) and rough["tiny"] == 0.0


def test_terrain_plane():
    rng = np.random.default_rng(42)
    x, y = np.r_[rng.random(200) * 100, 0, 0, 100, 100], np.r_[rng.random(200) * 100, 0, 100, 0, 100]  # the corners, so that the hull is the box
    got = terrain.patch_features(x, y, 600 + 0.1 * x, 32)
    assert got["phi_lidar"] == pytest.approx(np.arctan(0.1 * np.ptp(x) / 31), rel=1e-3) and got["z_range"] > 5
    assert terrain.patch_features(x[:5], y[:5], x[:5], 32) is None


def test_sobel_of_a_ramp(spark):
    cells = stream(spark, [(0, r, c, 2.0 * c) for r in range(5) for c in range(5)], "g int, row int, col int, z double")
    mid = {(r["row"], r["col"]): r for r in terrain.sobel(cells, ["g"]).collect()}[2, 2]
    assert abs(mid["gx"]) == pytest.approx(2.0) and mid["gy"] == pytest.approx(0.0)


def test_folds_and_search(spark):
    df = spark.range(400).select(F.col("id"), (F.col("id") % 20).alias("g"), (F.col("id") % 7).cast("double").alias("x"), ((F.col("id") % 7) * 2.0).alias("y"))
    dealt = learning.group_folds(df, "g", 4)
    assert dealt.groupBy("g").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
    with pytest.raises(ValueError):
        learning.group_folds(df, "g", 30)
    train, held = learning.holdout_by_group(df, "g")
    assert train.count() + held.count() == 400 and held.select("g").distinct().count() == 4
    trials = [{"trial": 0, "cv_r2": 0.9, "gap": 0.5, "cv_std": 0, "holdout_r2": 0.9}, {"trial": 1, "cv_r2": 0.8, "gap": 0.0, "cv_std": 0, "holdout_r2": 0.8}]
    assert learning.best_trial(trials, learning.SearchLimits())["trial"] == 1


def test_rank_average(spark):
    df = stream(spark, [(x,) for x in (3.0, 1.0, 3.0, 2.0)], "v double")
    assert sorted((r["v"], r["k"]) for r in audit.rank_average(df, "v", "k").collect()) == [(1.0, 1.0), (2.0, 2.0), (3.0, 3.5), (3.0, 3.5)]


def test_clock_fold_against_brute_force(spark):
    rng = np.random.default_rng(17)
    rows = [(k, i, int(c), 0, 1_700_000_000 + k) for k, n in ((1, 6000), (2, 1), (3, 50)) for i, c in enumerate(rng.integers(0, 86_400, n))]
    df = spark.createDataFrame(rows, "k int, i int, c long, n long, a long").repartition(7)
    got = {(r["k"], r["pos"]): (r["begin"], r["t"]) for r in ordered.clock_fold(df, ["k"], ["i"], "a", "c", "n").collect()}
    now: dict = {}
    for k, i, c, _, a in rows:
        begin = now.get(k, a)
        t = begin - begin % 86_400 + c
        t = t + 86_400 if t < begin - 43_200 else t
        now[k] = t if t > begin else begin + 1
        assert got[k, i] == (begin, now[k])
    assert len(got) == len(rows)


def test_clock_fold_reads_all_events(spark, tmp_path):
    spark.createDataFrame([(i, i % 5, "click" if i % 3 == 0 else "view") for i in range(1000)], "event_id long, user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    assert registry.queries()["clock_fold"](spark, f"file://{tmp_path}").count() == 666


def test_dense_patches_are_whole(spark):
    places = [(i * 7 % 101, i * 13 % 97) for i in range(60)]
    rows = [(1, float(x), float(y), 0.1 * x + (50.0 if i == 31 else 0.0)) for i, (x, y) in enumerate(places)]
    many = spark.createDataFrame(rows, "pid long, ox double, oy double, oz double")
    bad = spark.createDataFrame([(1, 5.0, 5.0, float("nan")), (1, 5.0, 5.0, None)], "pid long, ox double, oy double, oz double")
    once = terrain.enrich_terrain(many, "pid", "long", 16).first()
    dense = terrain.enrich_terrain(many.crossJoin(spark.range(200)).drop("id").unionByName(bad), "pid", "long", 16).first()
    assert dense["n_points_used"] == 60 * 200 and once["n_points_used"] == 60
    assert all(dense[f] == once[f] for f in terrain.FEATURES)


def test_swept_triangles_are_delaunay():
    rng = np.random.default_rng(3)
    x, y = rng.random(400) * 200, rng.random(400) * 100
    tri = terrain.triangulate(x, y)
    a, b, c = tri.T
    area = np.abs((x[b] - x[a]) * (y[c] - y[a]) - (x[c] - x[a]) * (y[b] - y[a])).sum() / 2
    edges, times = np.unique(np.sort(np.concatenate([tri[:, [0, 1]], tri[:, [1, 2]], tri[:, [2, 0]]]), axis=1), axis=0, return_counts=True)
    assert area > 0.9 * 200 * 100 and times.max() == 2 and len(tri) == 2 * 400 - 2 - (times == 1).sum()
    for t in tri[::7]:
        m = np.array([[x[t[1]] - x[t[0]], y[t[1]] - y[t[0]]], [x[t[2]] - x[t[0]], y[t[2]] - y[t[0]]]])
        mid = np.linalg.solve(2 * m, (m * m).sum(1)) + [x[t[0]], y[t[0]]]
        assert (np.hypot(x - mid[0], y - mid[1]) >= np.hypot(x[t[0]] - mid[0], y[t[0]] - mid[1]) - 1e-6).all()


def test_terrain_grid_of_the_reference(spark):
    rng = np.random.default_rng(9)
    x, y = rng.random(40) * 100, rng.random(40) * 100
    z = 0.2 * x + np.sin(y / 9)
    got = terrain.enrich_terrain(spark.createDataFrame([(1, *map(float, p)) for p in zip(x, y, z, strict=True)], "pid long, ox double, oy double, oz double"), "pid", "long").first()
    order = np.lexsort((y, x))
    want = terrain.patch_features(x[order], y[order], z[order], 256)
    assert all(got[f] == pytest.approx(want[f], rel=1e-9) for f in terrain.FEATURES)
