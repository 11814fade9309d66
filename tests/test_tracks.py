"""Map matching in blocks, and its streaming form, against the sequential rule; distance-gap segments on a stream; the Kalman filter."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraline.functions.geo import planar
from terraline.operators import kinematics, matcher, ordered
from terraline.streaming import tracks

T0 = dt.datetime(2025, 1, 1)
EDGES = "edge_id long, coords array<struct<x: double, y: double>>"
POINTS = "track string, ord long, x double, y double"


def roads(spark, rng, n=25):
    lines = [(k, [(float(x), float(y)) for x, y in np.cumsum(np.vstack([rng.uniform(0, 400, 2), rng.normal(0, 60, (int(rng.integers(1, 6)), 2))]), 0)]) for k in range(n)]
    lines += [(100, [(10.0, 10.0), (10.0, 10.0)]), (101, [(0.0, 0.0), (0.0, 390.0)]), (102, [(0.0, 0.0), (0.0, 390.0)])]  # no length; twins
    return lines, spark.createDataFrame(lines, EDGES)


def walks(rng, sizes):
    return [(t, i, float(x), float(y)) for t, n in sizes for i, (x, y) in enumerate(np.cumsum(np.vstack([rng.uniform(0, 300, 2), rng.normal(1.5, 9, (n - 1, 2))]), 0) % 700)]


def brute(rows, lines, cfg):
    """The rule row by row, by numpy over all edges."""
    out = {}
    for track in {r[0] for r in rows}:
        mine = sorted(r[1:] for r in rows if r[0] == track)
        xy = np.array([r[1:] for r in mine])
        step = np.diff(xy, axis=0, prepend=xy[:1])
        if len(mine) > 1:
            step[0] = step[1]
        move = step.copy()
        move[1:-1] = (step[:-2] + step[1:-1] + step[2:]) / 3 if len(mine) > 2 else step[1:-1]
        chooser = matcher.Chooser(cfg)
        for (no, x, y), (mx, my) in zip(mine, move, strict=True):
            found = []
            for edge, coords in lines:
                best, hit = None, False
                for i, ((ax, ay), (bx, by)) in enumerate(zip(coords, coords[1:], strict=False)):
                    dx, dy = bx - ax, by - ay
                    length = math.hypot(dx, dy)
                    t = 0.0 if length**2 < 1e-12 else max(0.0, min(1.0, ((x - ax) * dx + (y - ay) * dy) / (dx * dx + dy * dy)))
                    qx, qy = ax + t * dx, ay + t * dy
                    best = min(best or (math.inf,), (math.hypot(x - qx, y - qy), i, qx, qy, dx, dy), key=lambda b: b[:2])
                    if length >= 1e-3:
                        n = max(2, math.ceil(length * 0.25))
                        hit |= any(math.hypot(x - ax - j / (n - 1) * dx, y - ay - j / (n - 1) * dy) <= cfg.max_dist_m for j in range(n))
                if hit:
                    d, _, qx, qy, dx, dy = best
                    turn = 0.0
                    if math.hypot(mx, my) > 0.5 and math.hypot(dx, dy) > 0.1:
                        a = abs(math.degrees(math.atan2(mx, my)) - math.degrees(math.atan2(dx, dy))) % 360
                        turn = min(1.0, min(a, 360 - a) / 90)
                    found.append((edge, d / cfg.max_dist_m * (1 - cfg.dir_weight) + turn * cfg.dir_weight, qx, qy))
            k = chooser.pick([f[0] for f in found], [f[1] for f in found])
            out[track, no] = (found[k][0], round(found[k][2], 6), round(found[k][3], 6)) if k >= 0 else (None, x, y)
    return out


@pytest.fixture(scope="module")
def world(spark):
    rng = np.random.default_rng(11)
    lines, edges = roads(spark, rng)
    rows = walks(rng, [("a", 70), ("b", 1), (None, 30), ("c", 2), ("d", 45)])
    return rows, lines, edges, matcher.MatchConfig(max_dist_m=60.0)


def as_dict(df):
    return {(r["track"], r["ord"]): (r["edge_id"], round(r["x"], 6), round(r["y"], 6)) for r in df.collect()}


@pytest.mark.parametrize(("block", "run_up"), [(512, 32), (16, 4), (5, 2)])
def test_blocks_give_the_sequential_rows(spark, world, block, run_up):
    rows, lines, edges, cfg = world
    got = matcher.match_tracks(spark.createDataFrame(rows, POINTS).repartition(7), edges, cfg=cfg, block=block, run_up=run_up)
    assert got.count() == len(rows)
    want = brute(rows, lines, cfg)
    assert len({v[0] for v in want.values()}) > 8 and as_dict(got) == want


def test_lock_step_is_the_chooser():
    rng = np.random.default_rng(5)
    cfg = matcher.MatchConfig(hysteresis=0.3)
    n = rng.integers(0, 5, 400)
    n[rng.random(400) < 0.1] = 0
    end = np.cumsum(n)
    edge = np.concatenate([np.sort(rng.choice(8, k, replace=False)) for k in n]).astype(np.int64)
    score = rng.integers(0, 6, len(edge)) / 8  # ties
    first = np.array([0, 150, 151, 300])
    last = np.array([150, 151, 300, 400])
    empty = np.zeros((4, cfg.history), np.int64)
    picked, _, _, recent, held = matcher.lock_step(edge, score, end - n, end, first, first, last, empty, np.zeros(4, np.int64), cfg)
    for a, z, r, h in zip(first, last, recent, held, strict=True):
        chooser = matcher.Chooser(cfg)
        for i in range(a, z):
            s = slice(end[i] - n[i], end[i])
            k = chooser.pick(edge[s].tolist(), score[s].tolist())
            assert picked[i] == (-1 if k < 0 else s.start + k)
        assert r[:h].tolist() == chooser.recent


def test_numbered(spark):
    rows = [(k, v) for k, n in (("a", 500), (None, 30), ("b", 1)) for v in range(n)]
    got = ordered.numbered(spark.createDataFrame(rows, "k string, v long").repartition(9), "k", ["v"]).collect()
    assert len(got) == len(rows) and all(r["pos"] == r["v"] for r in got)


# ------------------------------------------------------------------------------------------------ streams


def batches(spark, folder, rows, schema, cuts, rng, disorder):
    """rows (with a time ts) as files, one a micro-batch; up to `disorder` seconds out of order; a last row far ahead moves the watermark."""
    rows = sorted(rows, key=lambda r: (r[2].timestamp() + rng.uniform(0, disorder)))
    edges = [0, *sorted(rng.choice(len(rows), cuts, replace=False).tolist()), len(rows)] if cuts else [0, len(rows)]
    parts = [rows[a:b] for a, b in zip(edges, edges[1:], strict=False)] + [[("end", 0, T0 + dt.timedelta(days=2), 1e6, 1e6)]]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{i:04d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def run(stream, spark, name, folder):
    q = stream.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    q.awaitTermination(240)
    assert q.exception() is None
    return spark.table(name).where("track != 'end'")


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


STREAM = "track string, ord long, ts timestamp, x double, y double"


@pytest.mark.parametrize("cuts", [0, 4, 9])
def test_matching_a_stream(spark, tmp_path, world, rocks, cuts):
    rows, lines, edges, cfg = world
    rng = np.random.default_rng(cuts)
    rows = [r for r in rows if r[0] is not None]
    timed = [(t, i, T0 + dt.timedelta(seconds=3 * i), x, y) for t, i, x, y in rows] + [("a", 999, None, 1.0, 1.0), (None, 1, T0, 1.0, 1.0)]
    timed = [r if r[2] else (*r[:2], T0 + dt.timedelta(days=9), None, None) for r in timed if r[1] != 999]
    stream = batches(spark, str(tmp_path / "in"), timed, STREAM, cuts, rng, 15)
    got = as_dict(run(tracks.match_stream(stream, edges, cfg=cfg, delay="20 seconds"), spark, f"matched{cuts}", tmp_path))
    assert got == brute(rows, lines, cfg)


@pytest.mark.parametrize("cuts", [0, 6])
def test_segments_of_a_stream(spark, tmp_path, rocks, cuts):
    rng = np.random.default_rng(cuts)
    rows = []
    for t, n in (("a", 80), ("b", 5), ("c", 40), ("d", 1)):
        jump = np.where(rng.random(n) < (0.12 if t in "ac" else 0), 500.0, 1.0)
        rows += [(t, i, T0 + dt.timedelta(seconds=i), float(x), 0.0) for i, x in enumerate(np.cumsum(jump))]
    stream = batches(spark, str(tmp_path / "in"), rows, STREAM, cuts, rng, 5)
    got = run(tracks.segment_stream(stream, "track", "ord", "ts", "x", "y", 100.0, 4, delay="10 seconds"), spark, f"cut{cuts}", tmp_path)
    df = spark.createDataFrame(rows, STREAM)
    want = ordered.split_segments(df, ["track"], ["ord"], ordered.distance_break(["track"], ["ord"], "x", "y", 100.0), 4)
    pick = ["track", "ord", "x", "segment_id"]
    assert sorted(map(tuple, got.select(pick).collect())) == sorted(map(tuple, want.select(pick).collect())) and want.select("track").distinct().count() == 4


def test_silent_tracks_are_closed(spark, tmp_path, rocks):
    rows = [("a", i, T0 + dt.timedelta(seconds=i if i < 6 else 4000 + i), float(i), 0.0) for i in range(12)]
    stream = batches(spark, str(tmp_path / "in"), rows, STREAM, 3, np.random.default_rng(0), 0)
    got = run(tracks.segment_stream(stream, "track", "ord", "ts", "x", "y", 0.5, 0, expire="5 minutes"), spark, "closed", tmp_path).collect()
    assert [r["segment_id"] for r in sorted(got, key=lambda r: r["ord"])] == [1, 2, 3, 4, 5, 6, 1, 2, 3, 4, 5, 6]  # later rows are a new track


# ------------------------------------------------------------------------------------------------ filter


def test_filter_starts_at_the_first_fix(spark):
    rows = [("e", float(t), 440000.0 + 10 * t, 4475000.0, 10.0, 1.0, 0.0, 0.0) for t in range(40)]
    rows += [("n", 1.7e9 + t, 440000.0, 4475000.0 + 10 * t, None if t % 3 else 10.0, 1.0, 0.0, 0.0) for t in range(40)]
    rows += [("n", None, None, None, 10.0, 1.0, 0.0, 0.0), ("w", 0.0, None, None, None, None, None, None)]
    rows += [("w", 1.0 + t, 440000.0 - 10 * t, 4475000.0, 10.0, None, None, None) for t in range(40)]
    df = spark.createDataFrame(rows, "k string, t double, x double, y double, v double, h double, a double, w double").repartition(3)
    got = kinematics.kalman_track(df, "k", "t", "x", "y", "v", "h", "a", "w").toPandas().sort_values(["k", "t"], na_position="first")
    assert len(got) == len(rows)
    for k, heading, at in (("e", 0.0, lambda t: (440000 + 10 * t, 4475000)), ("n", math.pi / 2, lambda t: (440000, 4475000 + 10 * (t - 1.7e9))), ("w", math.pi, lambda t: (440000 - 10 * (t - 1), 4475000))):
        mine = got[(got["k"] == k) & got["ekf_x"].notna()]
        assert len(mine) == 40
        off = [math.hypot(r.ekf_x - at(r.t)[0], r.ekf_y - at(r.t)[1]) for r in mine.itertuples()]
        assert max(off) < 6 and max(off[5:]) < 1
        assert mine["ekf_heading"].between(-math.pi, math.pi).all() and abs(abs(mine["ekf_heading"].iloc[-1]) - heading) < 0.05 and abs(mine["ekf_speed"].iloc[-1] - 10) < 0.2


def test_a_place_is_searched_once(spark, monkeypatch):
    """Points that stand still meet the network once for each place, not once for each row; what is chosen stays the same."""
    edges = spark.createDataFrame([(1, [(0.0, 0.0), (500.0, 0.0)]), (2, [(0.0, 40.0), (500.0, 40.0)])], "edge_id long, coords array<struct<x: double, y: double>>")
    rows = [("a", i, 100.0 * (i // 100), 5.0 if i < 200 else 38.0) for i in range(300)] + [("b", 0, 9000.0, 9000.0), ("b", 1, None, None)]
    met = []
    real = matcher.reachable
    monkeypatch.setattr(matcher, "reachable", lambda points, *a, **kw: met.append(points.count()) or real(points, *a, **kw))
    got = {(r["track"], r["ord"]): r["edge_id"] for r in matcher.match_tracks(spark.createDataFrame(rows, "track string, ord long, x double, y double"), edges, block=64).collect()}
    assert max(met) <= 5
    assert len(got) == 302 and got["a", 0] == got["a", 199] == 1 and got["b", 0] is None and got["b", 1] is None
