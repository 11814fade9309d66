"""Large patches, tile by tile, against one triangulation of all their places."""

import numpy as np
import pytest

from terraline.operators import terrain


def cloud(rng, shape, n):
    p = rng.uniform(-50, 50, (4 * n, 2))
    if shape == "disc":
        p = p[np.hypot(*p.T) < 50]
    if shape == "void":  # a hole in the middle, and a crowd in a corner
        p = np.vstack([p[np.hypot(*p.T) > 25][: n // 2], rng.normal(40, 0.5, (n // 2, 2))])
    if shape == "line":
        p = np.column_stack([p[:, 0], p[:, 0] * 0.3 + rng.normal(0, 0.2, len(p))])
    p = np.unique(p[:n], axis=0)
    return p[:, 0], p[:, 1], np.sin(p[:, 0] / 7) * 3 + p[:, 1] * 0.1 + rng.normal(0, 0.1, len(p))


def test_nodes_find_their_triangles():
    rng = np.random.default_rng(0)
    x, y, z = cloud(rng, "disc", 400)
    gx = gy = np.linspace(-55, 55, 40)
    tri = terrain.triangulate(x, y)
    at = terrain.containing(x, y, tri, gx, gy, pairs=100)
    assert (at == terrain.containing(x, y, tri, gx, gy)).all() and (at < 0).any()
    plane = terrain.heights(x, y, 2 * x - y, tri, at, gx, gy)
    want = 2 * gx[None, :] - gy[:, None]
    assert np.allclose(plane[at >= 0], want[at >= 0]) and np.isnan(plane[at < 0]).all()
    inside = np.hypot(*np.meshgrid(gx, gy)) < 40
    assert (at[inside] >= 0).all()


@pytest.mark.parametrize("shape", ["disc", "void"])
def test_tiles_are_one_triangulation(spark, shape):
    rng = np.random.default_rng(len(shape))
    x, y, z = cloud(rng, shape, 900)
    size = 32
    whole = terrain.grid_from_points(x, y, z, terrain.axis(x.min(), x.max(), size), terrain.axis(y.min(), y.max(), size)).astype(np.float32)
    df = spark.createDataFrame([(7, *map(float, p)) for p in zip(x, y, z, strict=True)], "pid long, ox double, oy double, oz double").repartition(3)
    got = terrain.tiled_grids(df, "pid", "long", size, 150).toPandas()
    assert len(got) == size * size and not got.duplicated(["row", "col"]).any()
    grid = got.pivot(index="row", columns="col", values="z").to_numpy()
    assert (np.isnan(grid) == np.isnan(whole)).mean() > 0.999  # nodes on the rim itself may fall either way
    both = ~np.isnan(grid) & ~np.isnan(whole)
    assert both.sum() > 40 and np.allclose(grid[both], whole[both], atol=1e-5)


def test_features_of_large_and_small_patches(spark):
    rng = np.random.default_rng(4)
    rows = []
    for pid, n in ((1, 700), (2, 60), (3, 5)):
        x, y, z = cloud(rng, "disc", n)
        rows += [(pid, *map(float, p)) for p in zip(x, y, z, strict=True)]
    rows += [(1, float("nan"), 0.0, 0.0), (1, 0.0, None, 0.0), *rows[:200]]
    df = spark.createDataFrame(rows, "pid long, ox double, oy double, oz double").repartition(3)
    one = {r["pid"]: r for r in terrain.enrich_terrain(df, "pid", "long", 32).collect()}
    cut = {r["pid"]: r for r in terrain.enrich_terrain(df, "pid", "long", 32, tile=200).collect()}
    assert set(cut) == {1, 2, 3} and cut[1]["n_points_used"] == one[1]["n_points_used"] == 900 and cut[3]["tri"] is None
    for c in terrain.FEATURES:
        assert cut[1][c] == pytest.approx(one[1][c], rel=1e-4, abs=1e-6) and cut[2][c] == one[2][c]


def test_repeated_places_make_no_more_pairs(spark, monkeypatch):
    """Copies of the points and of the cloud's points change only n_points_used; what is joined is places."""
    rng = np.random.default_rng(6)
    x, y, z = cloud(rng, "disc", 200)
    other = spark.createDataFrame([tuple(map(float, p)) for p in zip(x, y, z, strict=True)] + [(0.0, 0.0, float("nan")), (None, 1.0, 1.0)], "ox double, oy double, oz double")
    points = spark.createDataFrame([(i, 5.0 * (i % 3), 0.0) for i in range(12)] + [(99, 5000.0, 0.0), (100, None, 1.0)], "pid long, x double, y double")
    pairs = []
    real = terrain.spatial.radius_join
    monkeypatch.setattr(terrain.spatial, "radius_join", lambda *a, **kw: pairs.append(real(*a, **kw).count()) or real(*a, **kw))
    one = {r["pid"]: r for r in terrain.patches_around(points, other, 20.0, "pid", 16).collect()}
    many = {r["pid"]: r for r in terrain.patches_around(points, other.crossJoin(spark.range(7)).drop("id"), 20.0, "pid", 16).collect()}
    plain = {r["pid"]: r for r in terrain.enrich_terrain(real(points, other, 20.0), "pid", "long", 16).collect()}
    assert pairs[0] == pairs[1] <= 3 * 200
    assert set(one) == set(many) == set(plain) == set(range(12))
    for i, r in plain.items():
        assert one[i] == r and many[i]["n_points_used"] == 7 * r["n_points_used"] and many[i][:-1] == r[:-1]
