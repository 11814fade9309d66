"""Spatial joins as bucket equi-joins: cells of the radius's size, the query side exploded to 3 x 3 cells, an exact recheck."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraline import scratch
from terraline.functions.geo import EARTH_M, haversine_m, planar, project_on_segment


def cell(c: Column, size: float | Column) -> Column:
    return F.floor(c / size).cast("long")


CROWD = 20_000  # rows of a cell that one task joins, on each side
_BROADCAST = 500_000  # crowded keys that are broadcast at most: some 20 MB


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], on: Column | None = None, crowd: int = CROWD) -> DataFrame:
    """Inner equi-join on keys (of one name on both sides; kept once) whose crowded keys are cut on both sides.

    Rows are counted by key. A key with a rows on the left and b on the right becomes ceil(a / crowd) times ceil(b / crowd) blocks:
    a row draws its number on its own side and stands in each block of the other side's numbers, so each pair meets once, in a block
    of bounded size. The number is a hash of the whole row, so that a task that runs again deals alike (equal rows stay together). The counts are a job while the plan is built; the crowded keys, at most a row for `crowd` rows, are broadcast if they are few.
    """
    n = left.groupBy(*keys).agg(F.count("*").alias("__a")).join(right.groupBy(*keys).agg(F.count("*").alias("__b")), keys).where((F.col("__a") > crowd) | (F.col("__b") > crowd))
    cuts = scratch.at_rest(n.select(*keys, F.ceil(F.col("__a") / crowd).alias("__m"), F.ceil(F.col("__b") / crowd).alias("__n")), "crowded")
    many = cuts.count()
    if not many:
        return left.join(right, keys) if on is None else left.join(right, keys).where(on)
    cuts = F.broadcast(cuts) if many <= _BROADCAST else cuts

    def dealt(side: DataFrame, own: str, other: str, names: tuple[str, str]) -> DataFrame:
        wide = side.join(cuts, keys, "left").withColumns({c: F.coalesce(c, F.lit(1).cast("long")) for c in ("__m", "__n")})
        drawn = F.pmod(F.xxhash64(*side.columns), F.col(own))
        return wide.withColumn(names[0], drawn).withColumn(names[1], F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))).drop("__m", "__n")

    pairs = dealt(left, "__m", "__n", ("__i", "__j")).join(dealt(right, "__n", "__m", ("__j", "__i")), [*keys, "__i", "__j"]).drop("__i", "__j")
    return pairs if on is None else pairs.where(on)


def radius_join(points: DataFrame, others: DataFrame, radius: float, x: str = "x", y: str = "y", ox: str = "ox", oy: str = "oy", crowd: int = CROWD) -> DataFrame:
    """Pairs within the radius (inclusive) with dist. points' and others' columns must have different names. Crowded cells are cut (see spread_join)."""
    left = _around(points, [x, y], F.lit(float(radius)))
    right = others.withColumns({"__c0": cell(F.col(ox), radius), "__c1": cell(F.col(oy), radius)})
    dist = planar(F.col(x), F.col(y), F.col(ox), F.col(oy))
    return spread_join(left, right, ["__c0", "__c1"], dist <= radius, crowd).withColumn("dist", dist).drop("__c0", "__c1")


def within_radius(others: DataFrame, points: DataFrame, radius: float, id_col: str, x: str = "x", y: str = "y", ox: str = "ox", oy: str = "oy") -> DataFrame:
    """The rows of others that have a point within the radius."""
    hit = radius_join(points.select(x, y), others.select(id_col, ox, oy), radius, x, y, ox, oy).select(id_col).distinct()
    return others.join(hit, id_col, "left_semi")


def _cells(axes: list[str], size: Column) -> dict[str, Column]:
    return {f"__c{i}": cell(F.col(c), size) for i, c in enumerate(axes)}


def _around(rows: DataFrame, axes: list[str], size: Column) -> DataFrame:
    """rows once for each of the 3 cells a dimension around them: __c0, __c1 and so on."""
    for i, c in enumerate(axes):
        rows = rows.withColumn(f"__c{i}", F.explode(F.array(*[cell(F.col(c), size) + k for k in (-1, 0, 1)])))
    return rows


def pyramid(others: DataFrame, axes: list[str], size: float, top: int, leaf: int) -> DataFrame:
    """level, __c0.., __n and the box __lo0, __hi0.. of the rows: by cell, at every level from 0 (cells of `size`) to top (each twice as wide as the one below), and
    below 0 wherever a cell holds more than `leaf` rows, until none does (or the rows of one place are left): an adaptive quadtree."""
    names, ends = [f"__c{i}" for i in range(len(axes))], [f"__{e}{i}" for i in range(len(axes)) for e in ("lo", "hi")]
    boxes = [f(c).alias(f"__{e}{i}") for i, c in enumerate(axes) for e, f in (("lo", F.min), ("hi", F.max))]
    count = lambda df, width: scratch.at_rest(df.groupBy(*[cell(F.col(c), width).alias(n) for c, n in zip(axes, names, strict=True)]).agg(F.count("*").alias("__n"), *boxes), "cells")
    wider = [(F.min if e.startswith("__lo") else F.max)(e).alias(e) for e in ends]
    up = lambda df, low, high: df.select(F.explode(F.sequence(F.lit(low), F.lit(high))).alias("__level"), *names, "__n", *ends).select("__level", *[F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("__level") - low)).cast("long").alias(c) for c in names], "__n", *ends).groupBy("__level", *names).agg(F.sum("__n").alias("__n"), *wider)
    base = count(others, size)
    found, level = up(base, 0, top), 0
    while level > -40:
        crowded = base.where(F.col("__n") > leaf)
        most = crowded.agg(F.max("__n")).first()[0]
        if most is None:
            break
        below = max(level - math.ceil(math.log2(most / leaf) / len(axes)) - 1, -40)  # where even rows would be few enough
        inside = others.withColumns(_cells(axes, F.lit(size * 2.0**level))).join(crowded.select(*names), names, "left_semi").select(*axes)
        base = count(inside, size * 2.0**below)
        found, level = found.unionByName(up(base, below, level - 1)), below
    return found


LEAF, FAN = 32, 16  # rows of a cell that isn't divided further, and cells below a cell, on average, that a round looks at


def places(df: DataFrame, columns: list[str]) -> DataFrame:
    """The different values of columns, each with a number, __spot; rows with a null or a number that isn't finite are left out."""
    real = reduce(lambda a, b: a & b, [F.abs(c) < float("inf") for c in columns])
    return scratch.at_rest(df.where(real).select(*columns).distinct().withColumn("__spot", F.monotonically_increasing_id()), "places")


def neighbourhoods(spots: DataFrame, others: DataFrame, k: int, size: float, axes: list[tuple[str, str]], slack: float = 0.0, leaf: int = LEAF, crowd: int = CROWD) -> DataFrame:
    """spots (__spot and coordinates, see places) and others joined so that each spot meets its k nearest others, and few more. axes: (column
    of spots, column of others), one a dimension; others' must be finite, and at most `leaf` of them should stand in one place.

    The others' quadtree is gone down from a level of a few cells. In each round the cells a spot still looks at are replaced by those
    below; the k-th nearest lies no further than the farthest corners of the cells that hold k rows, and cells whose box is further
    away than that (and `slack`) go. So a spot meets the rows of a few small cells, wherever it lies and however others are spread.
    Only bounds and a count a level reach the driver.
    """
    mine, theirs = [p for p, _ in axes], [o for _, o in axes]
    span = lambda df, cols: df.agg(F.count("*"), *[f(c) for c in cols for f in (F.min, F.max)]).first()
    b = span(others, theirs)
    if not b[0]:
        return spots.join(others, F.lit(False))  # nothing to meet
    wide = max(*(b[2 * i + 2] - b[2 * i + 1] for i in range(len(axes))), size)
    names = [f"__c{i}" for i in range(len(axes))]
    cells = scratch.at_rest(pyramid(others, theirs, size, math.ceil(math.log2(wide / size)) + 1, leaf), "pyramid")
    levels = {r["__level"]: r for r in cells.groupBy("__level").agg(F.count("*").alias("cells"), F.sum("__n").alias("rows"), F.sum((F.col("__n") > leaf).cast("long")).alias("crowded")).collect()}  # 60 or so
    whole = [v for v, r in levels.items() if r["rows"] == b[0]]
    level = min([v for v in whole if levels[v]["cells"] <= FAN] or [max(whole)])

    def near(df: DataFrame) -> DataFrame:
        """df with the least and the greatest distance of each cell's box, but for the cells that can't hold one of the k nearest."""
        gap = [F.greatest(F.col(f"__lo{i}") - F.col(m), F.col(m) - F.col(f"__hi{i}"), F.lit(0.0)) for i, m in enumerate(mine)]
        rim = [F.greatest(F.abs(F.col(f"__lo{i}") - F.col(m)), F.abs(F.col(f"__hi{i}") - F.col(m))) for i, m in enumerate(mine)]
        size_of = lambda sides: F.sqrt(sum((x * x for x in sides), F.lit(0.0)))
        return df.withColumns({"__near": size_of(gap), "__far": size_of(rim)}).drop(*[f"__{e}{i}" for i in range(len(axes)) for e in ("lo", "hi")])

    def cut(df: DataFrame) -> DataFrame:
        by = Window.partitionBy("__spot")
        held = F.sum("__n").over(by.orderBy("__far"))
        df = df.withColumn("__held", held).withColumn("__most", F.min(F.when(F.col("__held") >= k, F.col("__far"))).over(by) * (1 + 1e-9) + slack)
        return scratch.at_rest(df.where(F.col("__most").isNull() | (F.col("__near") <= F.col("__most"))).drop("__held"), "near")

    at = cut(near(spots.select("__spot", *mine).crossJoin(F.broadcast(cells.where(F.col("__level") == level)))))  # FAN cells, or two a dimension
    while levels[level]["crowded"] and level > min(levels):
        rows, few = levels[level - 1]["rows"], FAN * levels[level]["crowded"]
        below = level - 1
        while below - 1 in levels and levels[below - 1]["rows"] == rows and levels[below - 1]["cells"] <= few:
            below -= 1
        parents = {n: F.floor(F.col(n) / 2.0 ** (level - below)).cast("long") for n in names}
        under = cells.where(F.col("__level") == below).select(*[F.col(n).alias(f"_{n}") for n in names], *[c.alias(n) for n, c in parents.items()], *[c for c in cells.columns if c not in ("__level", *names)])
        still = (F.col("__level") == level) & (F.col("__n") > leaf)
        going = at.where(still).select("__spot", *mine, *names)
        down = going.join(F.broadcast(under), names) if levels[below]["cells"] <= _BROADCAST else spread_join(going, under, names, crowd=crowd)
        down = near(down.drop(*names).withColumnsRenamed({f"_{n}": n for n in names}).withColumn("__level", F.lit(below)))
        at, level = cut(at.where(~still).drop("__most").unionByName(down)), below
    cell_at = ["__level", *names]
    wanted = scratch.at_rest(at.select(*cell_at).distinct(), "wanted")
    per = {r["__level"]: r["count"] for r in wanted.groupBy("__level").count().collect()}
    rows = others.select("*", F.explode(F.array(*[F.lit(v) for v in sorted(per)])).alias("__level")) if per else others.withColumn("__level", F.lit(0))
    rows = rows.withColumns(_cells(theirs, F.pow(F.lit(2.0), F.col("__level")) * size)).join(F.broadcast(wanted) if sum(per.values()) <= _BROADCAST else wanted, cell_at, "left_semi")
    left = at.select("__spot", *cell_at, "__most").join(spots, "__spot") if set(spots.columns) - {"__spot", *mine} else at.select(*spots.columns, *cell_at, "__most")
    apart = F.sqrt(sum((F.pow(F.col(m) - F.col(o), 2) for m, o in axes), F.lit(0.0)))
    pairs = spread_join(left, rows, cell_at, F.col("__most").isNull() | (apart <= F.col("__most")), crowd)
    return pairs.drop(*cell_at, "__most")


def knn_join(points: DataFrame, others: DataFrame, k: int, id_col: str, other_id: str, radius: float, x: str = "x", y: str = "y", ox: str = "ox", oy: str = "oy") -> DataFrame:
    """The k nearest others of every point, with dist and rank (ties by other_id). radius: the cells' usual width; crowded cells are
    divided, sparse ones joined (see neighbourhoods), so it changes no result. Points of one place are searched once, and of the others
    of one place only the first k take part. Rows without a position have no neighbours and are none."""
    spots = places(points.select(F.col(x).cast("double").alias(x), F.col(y).cast("double").alias(y)), [x, y])
    there = others.where((F.abs(ox) < float("inf")) & (F.abs(oy) < float("inf"))).withColumn("__nth", F.row_number().over(Window.partitionBy(ox, oy).orderBy(other_id)))
    stands = scratch.at_rest(there.where(F.col("__nth") <= k).drop("__nth"), "stands")
    order = Window.partitionBy("__spot").orderBy("dist", other_id)
    near = neighbourhoods(spots, stands, k, radius, [(x, ox), (y, oy)], leaf=max(LEAF, k)).withColumn("dist", planar(F.col(x), F.col(y), F.col(ox), F.col(oy)))
    best = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("__spot").withColumnsRenamed({x: "__px", y: "__py"})
    return points.join(best, (F.col(x) == F.col("__px")) & (F.col(y) == F.col("__py"))).drop("__px", "__py")


def nearest_with_threshold(points: DataFrame, others: DataFrame, id_col: str, other_id: str, radius: float, threshold: float, **names: str) -> DataFrame:
    """The nearest other of every point and on_road: whether it lies within the threshold."""
    return knn_join(points, others, 1, id_col, other_id, radius, **names).drop("rank").withColumn("on_road", F.col("dist") <= threshold)


def tile_keys(x: Column, y: Column, radius: float, tile: float = 1000.0) -> tuple[Column, Column]:
    """Tile numbers that a search box touches; a tile is named by its west edge and its north edge."""
    tx = F.sequence(F.floor((x - radius) / tile).cast("int"), F.floor((x + radius) / tile).cast("int"))
    ty = F.sequence((F.floor((y - radius) / tile) + 1).cast("int"), (F.floor((y + radius) / tile) + 1).cast("int"))
    return tx, ty


def tile_join(points: DataFrame, tiles: DataFrame, radius: float, x: str = "x", y: str = "y", tile: float = 1000.0) -> DataFrame:
    tx, ty = tile_keys(F.col(x), F.col(y), radius, tile)
    return points.select("*", F.explode(tx).alias("tx")).select("*", F.explode(ty).alias("ty")).join(tiles, ["tx", "ty"])


def containing_box(points: DataFrame, boxes: DataFrame, id_col: str, name: str = "name", x: str = "x", y: str = "y", size: float = 1000.0) -> DataFrame:
    """id_col and the first (by name) box that contains the point; boxes: name, x0, y0, x1, y1, dealt to cells of `size`."""
    b = boxes.select(name, "x0", "y0", "x1", "y1", F.explode(F.sequence(cell(F.col("x0"), size), cell(F.col("x1"), size))).alias("__cx")).select("*", F.explode(F.sequence(cell(F.col("y0"), size), cell(F.col("y1"), size))).alias("__cy"))
    p = points.select(id_col, x, y, cell(F.col(x), size).alias("__cx"), cell(F.col(y), size).alias("__cy"))
    hit = p.join(b, ["__cx", "__cy"]).where(F.col(x).between(F.col("x0"), F.col("x1")) & F.col(y).between(F.col("y0"), F.col("y1")))
    return hit.groupBy(id_col).agg(F.min(name).alias(name))


def edge_segments(edges: DataFrame, coords: str = "coords") -> DataFrame:
    """One row a segment of a polyline (array<struct<x, y>>), in order: seg_idx, ax, ay, bx, by."""
    n = F.size(coords)
    pairs = F.when(n >= 2, F.arrays_zip(F.slice(coords, 1, n - 1).alias("a"), F.slice(coords, 2, n - 1).alias("b")))
    flat = edges.select("*", F.posexplode(pairs).alias("seg_idx", "__s"))
    return flat.select(*edges.columns, "seg_idx", *[F.col(f"__s")[s][c].alias(s + c) for s in ("a", "b") for c in ("x", "y")])


def edge_samples(segments: DataFrame, per_metre: float = 0.25) -> DataFrame:
    """Evenly spaced points of every segment, its ends included; segments under a millimetre have none."""
    length = planar(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    n = F.greatest(F.lit(2), F.ceil(length * per_metre).cast("int"))
    out = segments.where(length >= 1e-3).select("*", F.explode(F.transform(F.sequence(F.lit(0), n - 1), lambda i: i / (n - 1))).alias("__f"))
    return out.withColumn("ox", F.col("ax") + F.col("__f") * (F.col("bx") - F.col("ax"))).withColumn("oy", F.col("ay") + F.col("__f") * (F.col("by") - F.col("ay"))).drop("__f")


def project_on_edges(candidates: DataFrame, segments: DataFrame, by: list[str], edge: str = "edge_id", x: str = "x", y: str = "y") -> DataFrame:
    """For each candidate (point, edge) the nearest point of the edge: qx, qy, dist, and its segment (the first on ties)."""
    qx, qy, d = project_on_segment(F.col(x), F.col(y), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    near = candidates.join(segments.select(edge, "seg_idx", "ax", "ay", "bx", "by"), edge).withColumns({"qx": qx, "qy": qy, "dist": d})
    best = F.min_by(F.struct("qx", "qy", "dist", "seg_idx", (F.col("bx") - F.col("ax")).alias("sx"), (F.col("by") - F.col("ay")).alias("sy")), F.struct("dist", "seg_idx"))
    return near.groupBy(*by, edge).agg(best.alias("b"), F.first(x).alias(x), F.first(y).alias(y)).select(*by, edge, x, y, "b.*")


def bilinear(points: DataFrame, raster: DataFrame, id_col: str, x0: float, y0: float, step: float, x: str = "x", y: str = "y") -> DataFrame:
    """Elevation at points from a raster (row, col, z): null where one of the four neighbours is missing or null."""
    fx, fy = (F.col(x) - x0) / step, (F.lit(y0) - F.col(y)) / step
    base = points.select(id_col, F.floor(fx).cast("int").alias("c0"), F.floor(fy).cast("int").alias("r0"), (fx - F.floor(fx)).alias("u"), (fy - F.floor(fy)).alias("v"))
    corners = base.select("*", F.explode(F.array(*[F.struct((F.col("r0") + i).alias("row"), (F.col("c0") + j).alias("col"), ((F.col("v") if i else 1 - F.col("v")) * (F.col("u") if j else 1 - F.col("u"))).alias("w")) for i in (0, 1) for j in (0, 1)])).alias("k")).select(id_col, "k.*")
    got = corners.join(raster.select("row", "col", "z"), ["row", "col"], "left").groupBy(id_col).agg(F.sum(F.col("w") * F.col("z")).alias("z"), F.count("z").alias("n"))
    return got.select(id_col, F.when(F.col("n") == 4, F.col("z")).alias("z"))


def on_sphere(lat: Column, lon: Column) -> list[Column]:
    """The place as a point in space, in metres: the nearer in a straight line, the nearer by the haversine."""
    p, l_ = F.radians(lat), F.radians(lon)
    return [EARTH_M * c for c in (F.cos(p) * F.cos(l_), F.cos(p) * F.sin(l_), F.sin(p))]


def snap_trajectory(points: DataFrame, nodes: DataFrame, id_col: str, node_id: str, lat: str, lon: str, search_m: float = 200.0, cell_m: float = 100.0) -> DataFrame:
    """points with lat_corrected and lon_corrected (of the nearest node), matched_on_road (within search_m by the haversine) and
    distance_correction_m. Rows without a position pass with their own, not matched.

    The nearest is exact, anywhere on the globe: nodes are searched by cells in space, where the straight line orders places as the
    haversine does; ties go to the smaller node id."""
    at = lambda df, a, b, names: df.withColumns(dict(zip(names, on_sphere(F.col(a), F.col(b)), strict=True)))
    mine, theirs = ["__x", "__y", "__z"], ["__ox", "__oy", "__oz"]
    there = at(places(points.select(F.col(lat).alias("__plat"), F.col(lon).alias("__plon")), ["__plat", "__plon"]), "__plat", "__plon", mine)
    known = nodes.where((F.abs(lat) < float("inf")) & (F.abs(lon) < float("inf"))).groupBy(F.col(lat).alias("__lat"), F.col(lon).alias("__lon")).agg(F.min(node_id).alias("__node"))
    roads = scratch.at_rest(at(known, "__lat", "__lon", theirs), "nodes")
    dist = haversine_m(F.col("__plat"), F.col("__plon"), F.col("__lat"), F.col("__lon"))
    # the haversine and the straight line round differently: what lies within a millimetre of the nearest is compared by the haversine
    pairs = neighbourhoods(there, roads, 1, cell_m, list(zip(mine, theirs, strict=True)), slack=1e-3)
    near = pairs.withColumn("__d", dist).groupBy("__plat", "__plon").agg(F.min_by(F.struct("__lat", "__lon", "__d"), F.struct("__d", "__node")).alias("__n"))
    out = points.join(near, (F.col(lat) == F.col("__plat")) & (F.col(lon) == F.col("__plon")), "left").drop("__plat", "__plon")
    return out.withColumns({"lat_corrected": F.coalesce("__n.__lat", lat), "lon_corrected": F.coalesce("__n.__lon", lon), "matched_on_road": F.coalesce(F.col("__n.__d") <= search_m, F.lit(False)), "distance_correction_m": F.col("__n.__d")}).drop("__n")


def patches_with_fall_back(points: DataFrame, cloud: DataFrame, raster: DataFrame, id_col: str, radius: float) -> DataFrame:
    """id_col, ox, oy, oz and origin: the cloud's points within the radius of each point; where there are none, the raster's cells with
    a value in the square of twice the radius around it. cloud and raster: ox, oy, oz."""
    where = points.select(id_col, "x", "y")
    near = radius_join(where, cloud.select("ox", "oy", "oz"), radius).select(id_col, "ox", "oy", "oz", F.lit("cloud").alias("origin"))
    rest = where.join(near.select(id_col).distinct(), id_col, "left_anti")
    square = radius_join(rest, raster.where("oz is not null").select("ox", "oy", "oz"), radius * math.sqrt(2)).where((F.abs(F.col("ox") - F.col("x")) <= radius) & (F.abs(F.col("oy") - F.col("y")) <= radius))
    return near.unionByName(square.select(id_col, "ox", "oy", "oz", F.lit("raster").alias("origin")))
