"""Terrain statistics of elevation grids (long form: row, col, z) and of point patches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terraline import scratch
from terraline.operators import spatial

FEATURES = ["phi_lidar", "tri", "ruggedness", "z_min", "z_max", "z_mean", "z_std", "z_range"]


def dem_stats(cells: DataFrame, by: list[str]) -> DataFrame:
    """Elevation statistics of the finite cells, tri (population deviation, 0 where there is none)."""
    z = F.when(~F.isnan("z"), F.col("z"))
    got = cells.groupBy(*by).agg(F.count(z).alias("n_cells"), F.min(z).alias("z_min"), F.max(z).alias("z_max"), F.avg(z).alias("z_mean"), F.stddev_pop(z).alias("z_std"))
    return got.withColumn("z_range", F.col("z_max") - F.col("z_min")).withColumn("tri", F.coalesce("z_std", F.lit(0.0)))


def ruggedness(cells: DataFrame, by: list[str]) -> DataFrame:
    """Mean absolute difference of neighbours along rows and columns; gaps count as the grid's mean; 0 for a grid of under four cells or of gaps alone."""
    z = F.when(~F.isnan("z"), F.col("z"))
    filled = cells.withColumn("__z", F.coalesce(z, F.avg(z).over(Window.partitionBy(*by))))
    across = F.abs(F.col("__z") - F.lag("__z").over(Window.partitionBy(*by, "row").orderBy("col")))
    down = F.abs(F.col("__z") - F.lag("__z").over(Window.partitionBy(*by, "col").orderBy("row")))
    both = filled.select(*by, across.alias("__a"), down.alias("__d"))
    got = both.groupBy(*by).agg(F.count("*").alias("n"), F.sum("__a").alias("a"), F.count("__a").alias("na"), F.sum("__d").alias("d"), F.count("__d").alias("nd"))
    total = (F.coalesce("a", F.lit(0.0)) + F.coalesce("d", F.lit(0.0))) / (F.col("na") + F.col("nd"))
    return got.select(*by, F.when((F.col("n") < 4) | (F.col("na") + F.col("nd") == 0), F.lit(0.0)).otherwise(total).alias("ruggedness"))


def phi_lidar(cells: DataFrame, by: list[str], resolution: float = 1.0) -> DataFrame:
    """atan of the slope of the centre row (rows // 2), gaps as the row's mean. A grid of one column, or whose centre row is a gap
    throughout, takes the mean slope of all its cells instead."""
    rows = F.max("row").over(Window.partitionBy(*by)) + 1
    z = F.when(~F.isnan("z"), F.col("z"))
    centre = cells.withColumn("__r", F.floor(rows / 2)).where(F.col("row") == F.col("__r"))
    filled = centre.withColumn("__z", F.coalesce(z, F.avg(z).over(Window.partitionBy(*by))))
    fitted = filled.groupBy(*by).agg(F.atan(F.regr_slope("__z", F.col("col") * resolution)).alias("__phi"))
    rest = cells.join(fitted.where("__phi is not null").select(*by), by, "left_anti")
    mean = sobel(rest, by, resolution).groupBy(*by).agg(F.avg(F.abs("slope")).alias("__mean"))
    return cells.select(*by).distinct().join(fitted, by, "left").join(mean, by, "left").select(*by, F.coalesce("__phi", "__mean").alias("phi_lidar"))


def sobel(cells: DataFrame, by: list[str], resolution: float = 1.0) -> DataFrame:
    """Sobel gradient of every cell (gaps count as the grid's mean, outside as 0): gx, gy, slope, aspect. Kernels are flipped, as in a convolution."""
    finite = F.when(~F.isnan("z"), F.col("z"))
    cells = cells.withColumn("z", F.coalesce(finite, F.avg(finite).over(Window.partitionBy(*by))))
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("dr"), F.lit(j).alias("dc")) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("o")
    sent = cells.select(*by, "row", "col", "z", around).select(*by, (F.col("row") + F.col("o.dr")).alias("row"), (F.col("col") + F.col("o.dc")).alias("col"), "z", (-F.col("o.dr")).alias("r"), (-F.col("o.dc")).alias("c"))
    weight = lambda a, b: F.when(F.col(a) == 0, F.lit(0)).otherwise(-F.col(a)) * F.when(F.col(b) == 0, F.lit(2)).otherwise(F.lit(1))
    here = F.max((F.col("r") == 0) & (F.col("c") == 0))
    got = sent.groupBy(*by, "row", "col").agg((F.sum(weight("c", "r") * F.col("z")) / (8 * resolution)).alias("gx"), (F.sum(weight("r", "c") * F.col("z")) / (8 * resolution)).alias("gy"), here.alias("__here")).where("__here").drop("__here")
    return got.withColumn("slope", F.atan(F.sqrt(F.col("gx") ** 2 + F.col("gy") ** 2))).withColumn("aspect", F.atan2("gy", "gx"))


def _circle_right(px: np.ndarray, py: np.ndarray, tri: np.ndarray) -> np.ndarray:
    """Largest x of each triangle's circumscribed circle, infinite for a flat one."""
    a, b, c = tri.T
    bx, by, cx, cy = px[b] - px[a], py[b] - py[a], px[c] - px[a], py[c] - py[a]
    d = 2 * (bx * cy - by * cx)
    with np.errstate(divide="ignore", invalid="ignore"):
        u = (cy * (bx * bx + by * by) - by * (cx * cx + cy * cy)) / d
        v = (bx * (cx * cx + cy * cy) - cx * (bx * bx + by * by)) / d
        right = px[a] + u + np.hypot(u, v)
    return np.where(np.isfinite(right), right, np.inf)


def triangulate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Delaunay triangles (rows of three point numbers) by incremental insertion."""
    n = len(x)
    if n < 3:
        return np.zeros((0, 3), np.int64)
    span = max(np.ptp(x), np.ptp(y), 1e-9)
    cx, cy = x.mean(), y.mean()
    px, py = np.r_[x, cx - 1e3 * span, cx, cx + 1e3 * span], np.r_[y, cy - 1e3 * span, cy + 1e3 * span, cy - 1e3 * span]
    tri, done, grown = np.array([[n, n + 1, n + 2]]), [], 64
    for p in np.lexsort((y, x)).tolist():
        if len(tri) > grown:  # points come from left to right: a triangle whose circle lies behind the sweep is final
            behind = _circle_right(px, py, tri) < px[p] - 1e-6 * span
            done.append(tri[behind])
            tri = tri[~behind]
            grown = 2 * len(tri) + 64
        a, b, c = tri.T
        ax, ay, bx, by, qx, qy = px[a] - px[p], py[a] - py[p], px[b] - px[p], py[b] - py[p], px[c] - px[p], py[c] - py[p]
        det = (ax * ax + ay * ay) * (bx * qy - qx * by) - (bx * bx + by * by) * (ax * qy - qx * ay) + (qx * qx + qy * qy) * (ax * by - bx * ay)
        side = (px[b] - px[a]) * (py[c] - py[a]) - (px[c] - px[a]) * (py[b] - py[a])
        bad = det * np.sign(side) > 1e-12
        if not bad.any():
            continue
        edges = np.sort(np.concatenate([tri[bad][:, [0, 1]], tri[bad][:, [1, 2]], tri[bad][:, [2, 0]]]), axis=1)
        rim, times = np.unique(edges, axis=0, return_counts=True)
        rim = rim[times == 1]
        tri = np.concatenate([tri[~bad], np.column_stack([rim, np.full(len(rim), p)])])
    tri = np.concatenate([*done, tri])
    return tri[(tri < n).all(axis=1)]


def containing(x: np.ndarray, y: np.ndarray, tri: np.ndarray, gx: np.ndarray, gy: np.ndarray, pairs: int = 1 << 20) -> np.ndarray:
    """For each node of a grid (rows gy, columns gx) the first triangle that contains it, -1 outside all. Triangles and the nodes of
    their boxes are compared `pairs` at a time."""
    found = np.full(len(gy) * len(gx), len(tri))
    cx, cy = x[tri], y[tri]
    area = (cy[:, 1] - cy[:, 2]) * (cx[:, 0] - cx[:, 2]) + (cx[:, 2] - cx[:, 1]) * (cy[:, 0] - cy[:, 2])
    left, low = np.searchsorted(gx, cx.min(axis=1) - 1e-9), np.searchsorted(gy, cy.min(axis=1) - 1e-9)
    wide, high = np.searchsorted(gx, cx.max(axis=1) + 1e-9, "right") - left, np.searchsorted(gy, cy.max(axis=1) + 1e-9, "right") - low
    n = np.where(np.abs(area) < 1e-12, 0, wide * high)
    for part in np.split(np.arange(len(tri)), np.flatnonzero(np.diff(np.cumsum(n) // pairs)) + 1):
        t = np.repeat(part, n[part])
        if not len(t):
            continue
        at = np.arange(len(t)) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
        row, col = low[t] + at // wide[t], left[t] + at % wide[t]
        u, v = gx[col] - cx[t, 2], gy[row] - cy[t, 2]
        w0 = ((cy[t, 1] - cy[t, 2]) * u + (cx[t, 2] - cx[t, 1]) * v) / area[t]
        w1 = ((cy[t, 2] - cy[t, 0]) * u + (cx[t, 0] - cx[t, 2]) * v) / area[t]
        inside = (w0 >= -1e-9) & (w1 >= -1e-9) & (1 - w0 - w1 >= -1e-9)
        np.minimum.at(found, row[inside] * len(gx) + col[inside], t[inside])
    return np.where(found < len(tri), found, -1).reshape(len(gy), len(gx))


def heights(x: np.ndarray, y: np.ndarray, z: np.ndarray, tri: np.ndarray, at: np.ndarray, gx: np.ndarray, gy: np.ndarray) -> np.ndarray:
    """Linear interpolation at the nodes of a grid, each within the triangle `at` it; NaN where that is -1."""
    out = np.full(at.shape, np.nan)
    row, col = np.nonzero(at >= 0)
    if len(row):
        (ax, bx, cx), (ay, by, cy) = x[tri[at[row, col]]].T, y[tri[at[row, col]]].T
        d = (by - cy) * (ax - cx) + (cx - bx) * (ay - cy)
        w0 = ((by - cy) * (gx[col] - cx) + (cx - bx) * (gy[row] - cy)) / d
        w1 = ((cy - ay) * (gx[col] - cx) + (ax - cx) * (gy[row] - cy)) / d
        out[row, col] = (np.column_stack([w0, w1, 1 - w0 - w1]) * z[tri[at[row, col]]]).sum(axis=1)
    return out


def grid_from_points(x: np.ndarray, y: np.ndarray, z: np.ndarray, gx: np.ndarray, gy: np.ndarray) -> np.ndarray:
    """Linear interpolation over the triangulation at a grid; NaN outside the hull."""
    tri = triangulate(x, y)
    return heights(x, y, z, tri, containing(x, y, tri, gx, gy), gx, gy)


def _slopes(dem: np.ndarray) -> np.ndarray:
    """Sobel slope of every cell of a grid without gaps, outside as 0."""
    z = np.pad(dem, 1)
    dx, dy = z[:, 2:] - z[:, :-2], z[2:] - z[:-2]
    gx, gy = dx[:-2] + 2 * dx[1:-1] + dx[2:], dy[:, :-2] + 2 * dy[:, 1:-1] + dy[:, 2:]
    return np.arctan(np.hypot(gx, gy) / 8)


def patch_features(x: np.ndarray, y: np.ndarray, z: np.ndarray, size: int, least_points: int = 10, least_cells: int = 25, n_points: int | None = None) -> dict[str, float] | None:
    """Terrain features of one patch: a size x size grid over its box (10 m wide at least), then the grid statistics.
    n_points counts the points where x, y, z are different places only."""
    if (len(x) if n_points is None else n_points) < least_points:
        return None
    half_x, half_y = max(np.ptp(x), 10.0) / 2, max(np.ptp(y), 10.0) / 2
    mx, my = (x.min() + x.max()) / 2, (y.min() + y.max()) / 2
    dem = grid_from_points(x, y, z, np.linspace(mx - half_x, mx + half_x, size), np.linspace(my - half_y, my + half_y, size)).astype(np.float32)
    good = np.isfinite(dem)
    if good.sum() < least_cells:
        return None
    v = dem[good].astype(np.float64)
    row = dem[size // 2].astype(np.float64)
    some = np.isfinite(row)
    if some.any():
        row = np.where(some, row, row[some].mean())
        phi = float(np.arctan(np.polyfit(np.arange(size, dtype=float), row, 1)[0]))
    else:
        phi = float(np.abs(_slopes(np.where(good, dem, v.mean()).astype(np.float64))).mean())
    filled = np.where(good, dem, v.mean()).astype(np.float64)
    steps = np.concatenate([np.abs(np.diff(filled, axis=1)).ravel(), np.abs(np.diff(filled, axis=0)).ravel()])
    return {"phi_lidar": phi, "tri": float(v.std()), "ruggedness": float(steps.mean()), "z_min": float(v.min()), "z_max": float(v.max()), "z_mean": float(v.mean()), "z_std": float(v.std()), "z_range": float(np.ptp(v))}


TILE, MOST_TILES = 2000, 64  # places a tile aims at, tiles a side at most


def axis(low: float, high: float, size: int) -> np.ndarray:
    half, mid = max(high - low, 10.0) / 2, (low + high) / 2
    return np.linspace(mid - half, mid + half, size)


def tile_of(places: np.ndarray, grid: np.ndarray, tiles: int) -> np.ndarray:
    return np.clip(np.floor((places - grid[0]) / (grid[-1] - grid[0]) * tiles), 0, tiles - 1).astype(int)


def final_triangles(x: np.ndarray, y: np.ndarray, tri: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """Which triangles no place in the boxes (x0, x1, y0, y1) can change: their circumscribed circles touch none of them."""
    a, b, c = tri.T
    bx, by, cx, cy = x[b] - x[a], y[b] - y[a], x[c] - x[a], y[c] - y[a]
    d = 2 * (bx * cy - by * cx)
    with np.errstate(divide="ignore", invalid="ignore"):
        u, v = (cy * (bx * bx + by * by) - by * (cx * cx + cy * cy)) / d, (bx * (cx * cx + cy * cy) - cx * (bx * bx + by * by)) / d
    mx, my, r2 = x[a] + u, y[a] + v, (u * u + v * v) * (1 + 1e-9)
    out = np.isfinite(r2)
    for x0, x1, y0, y1 in boxes:
        dx, dy = np.maximum(np.maximum(x0 - mx, mx - x1), 0), np.maximum(np.maximum(y0 - my, my - y1), 0)
        out &= ~(dx * dx + dy * dy <= r2)
    return out


def beyond_hull(x: np.ndarray, y: np.ndarray, tri: np.ndarray, boxes: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Which of the places (u, v) lie outside the hull whatever is in the boxes: behind a rim edge that has all boxes before it."""
    out = np.zeros(len(u), bool)
    if not len(tri):
        return out
    sides = np.concatenate([tri[:, [0, 1, 2]], tri[:, [1, 2, 0]], tri[:, [2, 0, 1]]])
    _, first, times = np.unique(np.sort(sides[:, :2], axis=1), axis=0, return_index=True, return_counts=True)
    for a, b, c in sides[first[times == 1]]:
        dx, dy = x[b] - x[a], y[b] - y[a]
        inner = np.sign(dx * (y[c] - y[a]) - dy * (x[c] - x[a]))
        side = lambda px, py, a=a, dx=dx, dy=dy, inner=inner: inner * (dx * (py - y[a]) - dy * (px - x[a]))
        if inner and all((side(boxes[:, i], boxes[:, j]) >= 0).all() for i in (0, 1) for j in (2, 3)):
            out |= side(u, v) < 0
    return out


def tile_grid(points: pd.DataFrame, info: pd.Series, size: int) -> pd.DataFrame:
    """row, col, z and done of a tile's open nodes, from the places of the tile and those around it."""
    gx, gy = axis(info["x0"], info["x1"], size), axis(info["y0"], info["y1"], size)
    tiles = int(info["tiles"])
    col, row = (np.flatnonzero(tile_of(g, g, tiles) == info[c]) for g, c in ((gx, "i"), (gy, "j")))
    nodes = np.ravel_multi_index(np.meshgrid(row, col, indexing="ij"), (size, size)).ravel()
    x, y, z = (points[c].to_numpy(float) for c in ("ox", "oy", "oz"))
    order = np.lexsort((y, x))
    x, y, z = x[order], y[order], z[order]
    boxes = np.array([[b["x0"], b["x1"], b["y0"], b["y1"]] for b in info["boxes"] if max(abs(b["i"] - info["i"]), abs(b["j"] - info["j"])) > info["ring"]], float).reshape(-1, 4)
    tri = triangulate(x, y)
    at = containing(x, y, tri, gx[col], gy[row])
    got = heights(x, y, z, tri, at, gx[col], gy[row]).astype(np.float32).ravel()
    if not len(boxes):
        done = np.ones(len(nodes), bool)
    else:
        sure = np.r_[final_triangles(x, y, tri, boxes), False] if len(tri) else np.zeros(1, bool)
        done = sure[at.ravel()]
        none = np.flatnonzero(at.ravel() < 0)
        done[none] = beyond_hull(x, y, tri, boxes, gx[nodes[none] % size], gy[nodes[none] // size])
    out = pd.DataFrame({"row": nodes // size, "col": nodes % size, "z": got.astype(float), "done": done})
    return out if info["todo"] is None else out[np.isin(nodes, info["todo"])]


def tiled_grids(places: DataFrame, id_col: str, id_type: str, size: int, tile: int = TILE) -> DataFrame:
    """id_col, row, col, z: the elevation grids (NaN outside the hull) of large patches, each over the whole patch's triangulation.

    places: id_col, ox, oy, oz, a row a place. A patch is cut into tiles of about `tile` places. A tile triangulates its places and
    those of the tiles around it; a node is final if the circle about its triangle touches no box of places elsewhere, as then no
    other place can change that triangle, or if an edge of the rim has it behind and all places before it. Tiles with open nodes go
    again with twice the ring. So a task holds a tile's surroundings, and the result is that of one triangulation (where more than
    three places lie on one circle, either diagonal may be taken).
    """
    box = lambda: (F.min("ox").alias("x0"), F.max("ox").alias("x1"), F.min("oy").alias("y0"), F.max("oy").alias("y1"))
    spans = places.groupBy(id_col).agg(*box())

    def fraction(c: str, low: str, high: str):
        half = F.greatest(F.col(high) - F.col(low), F.lit(10.0)) / 2
        return (F.col(c) - ((F.col(low) + F.col(high)) / 2 - half)) / (2 * half)

    at = lambda c, low, high, n: F.greatest(F.lit(0), F.least(n - 1, F.floor(fraction(c, low, high) * n))).cast("int")
    fine = F.lit(MOST_TILES)
    here = places.join(spans, id_col)
    cells = scratch.at_rest(here.groupBy(id_col, at("ox", "x0", "x1", fine).alias("i"), at("oy", "y0", "y1", fine).alias("j")).agg(F.count("*").alias("n")), "tile-cells")
    cuts = [2**k for k in range(int(np.log2(MOST_TILES)) + 1)]
    each = cells.select("*", F.explode(F.array(*map(F.lit, cuts))).alias("tiles")).groupBy(id_col, "tiles", F.floor(F.col("i") * F.col("tiles") / MOST_TILES), F.floor(F.col("j") * F.col("tiles") / MOST_TILES)).agg(F.sum("n").alias("n"))
    enough = each.groupBy(id_col, "tiles").agg(F.max("n").alias("n")).groupBy(id_col).agg(F.coalesce(F.min(F.when(F.col("n") <= tile, F.col("tiles"))), fine).alias("tiles"))
    tiled = here.join(enough, id_col)
    tiled = scratch.at_rest(tiled.select(id_col, "ox", "oy", "oz", at("ox", "x0", "x1", F.col("tiles")).alias("i"), at("oy", "y0", "y1", F.col("tiles")).alias("j")), "tile-places")
    boxes = tiled.groupBy(id_col, "i", "j").agg(*box()).groupBy(id_col).agg(F.collect_list(F.struct("i", "j", "x0", "x1", "y0", "y1")).alias("boxes"))  # MOST_TILES squared at most
    patches = spans.join(enough, id_col).join(boxes, id_col)
    numbers = F.sequence(F.lit(0), F.col("tiles") - 1)
    open_tiles = patches.select(id_col, F.explode(numbers).alias("i"), "tiles").select(id_col, "i", F.explode(numbers).alias("j")).withColumn("todo", F.lit(None).cast("array<long>"))
    schema = f"{id_col} {id_type}, i int, j int, row long, col long, z double, done boolean"
    most = enough.agg(F.max("tiles")).first()[0]
    ring, grids = 1, None

    def run(points: pd.DataFrame, info: pd.DataFrame) -> pd.DataFrame:
        one = info.iloc[0]
        got = tile_grid(points, one, size)
        return got.assign(**{id_col: one[id_col], "i": one["i"], "j": one["j"]})[[id_col, "i", "j", "row", "col", "z", "done"]]

    while most is not None:
        info = open_tiles.join(patches, id_col).withColumn("ring", F.lit(ring))
        around = lambda c: F.explode(F.sequence(F.greatest(F.lit(0), F.col(c) - F.lit(ring)), F.least(F.col("tiles") - 1, F.col(c) + F.lit(ring)))).alias(f"s{c}")  # noqa: B023, E731
        wanted = info.select(id_col, "i", "j", "tiles", around("i")).select(id_col, "i", "j", "si", around("j"))
        source = tiled.select(F.col(id_col).alias("__id"), F.col("i").alias("__i"), F.col("j").alias("__j"), "ox", "oy", "oz")
        points = wanted.join(source, (F.col(id_col) == F.col("__id")) & (F.col("si") == F.col("__i")) & (F.col("sj") == F.col("__j"))).select(F.col(id_col).alias("__p"), F.col("i").alias("__ti"), F.col("j").alias("__tj"), "ox", "oy", "oz")
        out = scratch.at_rest(points.groupBy("__p", "__ti", "__tj").cogroup(info.groupBy(id_col, "i", "j")).applyInPandas(run, schema), "tile-grid")
        new = out.where("done").select(id_col, "row", "col", "z")
        grids = new if grids is None else grids.unionByName(new)
        if ring >= most or out.where("not done").isEmpty():
            break
        open_tiles = scratch.at_rest(out.where("not done").groupBy(id_col, "i", "j").agg(F.collect_list(F.col("row") * size + F.col("col")).alias("todo")), "open-tiles")
        ring *= 2
    return places.sparkSession.createDataFrame([], f"{id_col} {id_type}, row long, col long, z double") if grids is None else grids


def grid_features(cells: DataFrame, by: list[str], least_cells: int = 25) -> DataFrame:
    """The features of whole grids, by the operators above; none for grids with fewer finite cells."""
    finite = dem_stats(cells, by).where(F.col("n_cells") >= least_cells).drop("n_cells")
    return finite.join(ruggedness(cells, by), by).join(phi_lidar(cells, by), by).select(*by, *FEATURES)


def enrich_terrain(pairs: DataFrame, id_col: str, id_type: str, size: int = 256, tile: int = TILE) -> DataFrame:
    """Features of each point's patch, from all its finite points. pairs: id_col and the patch's ox, oy, oz (from radius_join), and
    n where a row stands for n points (see counted_places).

    Equal positions are counted before they are gathered (of several elevations at one place the lowest stands for it in the
    grid). A patch of up to `tile` places is one group; a larger one is triangulated tile by tile (see tiled_grids), and its grid is
    summed up by Spark. Which ones are larger is counted by a job.
    """
    whole = [F.col(c).cast("double").alias(c) for c in ("ox", "oy", "oz")]
    finite = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")) for c in ("ox", "oy", "oz")]
    places = pairs.select(id_col, *whole, *(["n"] if "n" in pairs.columns else [])).where(finite[0] & finite[1] & finite[2])
    places = places.groupBy(id_col, "ox", "oy").agg(F.min("oz").alias("oz"), (F.sum("n") if "n" in pairs.columns else F.count("*")).alias("n"))
    schema = f"{id_col} {id_type}, " + ", ".join(f"{f} double" for f in FEATURES) + ", n_points_used long"

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, n = pdf.sort_values(["ox", "oy"]), int(pdf["n"].sum())
        got = patch_features(pdf["ox"].to_numpy(float), pdf["oy"].to_numpy(float), pdf["oz"].to_numpy(float), size, n_points=n) or {}
        return pd.DataFrame([{id_col: pdf[id_col].iloc[0], **{f: got.get(f) for f in FEATURES}, "n_points_used": n}])

    scratch.send_code(pairs.sparkSession)
    places = scratch.at_rest(places, "places")
    large = places.groupBy(id_col).agg(F.count("*").alias("__places"), F.sum("n").alias("n_points_used")).where(F.col("__places") > tile)
    large = scratch.at_rest(large.drop("__places"), "large-patches")
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a number, as patches are few bytes but much work, and would be put into one task
    if large.isEmpty():
        return places.repartition(parts, id_col).groupBy(id_col).applyInPandas(one, schema)
    small = places.join(large.select(id_col), id_col, "left_anti").repartition(parts, id_col).groupBy(id_col).applyInPandas(one, schema)
    grids = scratch.at_rest(tiled_grids(places.join(large.select(id_col), id_col, "left_semi").drop("n"), id_col, id_type, size, tile), "grids")
    return small.unionByName(large.join(grid_features(grids, [id_col]), id_col, "left").select(id_col, *FEATURES, "n_points_used"))


def counted_places(cloud: DataFrame) -> DataFrame:
    """ox, oy, oz, n: the finite points of a cloud, a row a place, with the lowest elevation and the number of points there."""
    whole = [F.col(c).cast("double").alias(c) for c in ("ox", "oy", "oz")]
    finite = [F.abs(F.col(c)) < float("inf") for c in ("ox", "oy", "oz")]
    return cloud.select(*whole).where(finite[0] & finite[1] & finite[2]).groupBy("ox", "oy").agg(F.min("oz").alias("oz"), F.count("*").alias("n"))


def patches_around(points: DataFrame, cloud: DataFrame, radius: float, id_col: str, size: int = 256, tile: int = TILE) -> DataFrame:
    """id_col and the features of the patch around each point (id_col, x, y) that has points of the cloud (ox, oy, oz) within the radius.

    Points of one place share a patch, which is computed once, and meet the cloud's places, not its rows: the pairs grow with the
    places on both sides, not with the rows that repeat them.
    """
    spots = spatial.places(points, ["x", "y"])
    features = enrich_terrain(spatial.radius_join(spots, counted_places(cloud), radius), "__spot", "long", size, tile)
    return points.select(id_col, "x", "y").distinct().join(spots, ["x", "y"]).join(features, "__spot").select(id_col, *FEATURES, "n_points_used")
