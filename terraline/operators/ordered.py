"""Ordered scans: segmentation, rolling robust statistics, ring means, interpolation, patience."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window  # noqa: F401
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraline import scratch
from terraline.functions.geo import planar


def numbered(df: DataFrame, by: str, order: list[str | Column], out: str = "pos") -> DataFrame:
    """df with the position, from 0, of each row within its key, at rest; a key may span any number of tasks.

    Rows are dealt by ranges of (key, order); a task numbers what it holds, and the counts of the tasks before, a row a key and
    task, say where it begins. Nulls are a key and come first in the order; the order should leave no ties.
    """
    dealt = df.repartitionByRange(by, *order).sortWithinPartitions(by, *order)
    rows = scratch.at_rest(dealt.withColumns({"__part": F.spark_partition_id(), "__seq": F.monotonically_increasing_id()}), "numbered")
    held = rows.groupBy(F.col(by).alias("__key"), F.col("__part").alias("__at")).agg(F.min("__seq").alias("__first"), F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("__key").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    zero = held.select("__key", "__at", (F.col("__first") - before).alias("__zero"))
    found = rows.join(zero, F.col(by).eqNullSafe(F.col("__key")) & (F.col("__part") == F.col("__at")))
    return found.withColumn(out, F.col("__seq") - F.col("__zero")).drop("__part", "__seq", "__key", "__at", "__zero")


def in_blocks(df: DataFrame, size: int, before: int, after: int, pos: str = "pos", block: str = "block") -> DataFrame:
    """df once for each block of `size` positions that a row belongs to or borders on: the last `before` rows of the block before
    and the first `after` rows of the next one stand beside a block's own (floor(pos / size))."""
    own, at = F.floor(F.col(pos) / size), F.col(pos) % size
    more = F.array(own, F.when(at >= size - before, own + 1), F.when((at < after) & (own > 0), own - 1))
    return df.withColumn(block, F.explode(F.array_compact(more)))


def step_distance(df: DataFrame, by: list[str], order: list[str], x: str, y: str, out: str = "step_m") -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(out, planar(F.col(x), F.col(y), F.lag(x).over(w), F.lag(y).over(w)))


def split_segments(df: DataFrame, by: list[str], order: list[str], breaks: Column, min_rows: int = 10, inclusive: bool = False) -> DataFrame:
    """df with segment_id, numbered from 1 over the segments that are kept.

    breaks: true on a row that begins a new segment (null: false); may use F.lag over gap_window(). A key without a break keeps
    its one segment whatever its size; otherwise segments need more than min_rows rows (at least that many if inclusive).
    """
    w = Window.partitionBy(*by).orderBy(*order)
    cut = df.withColumn("__g", F.sum(F.coalesce(breaks.cast("int"), F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    size, last = F.count("*").over(Window.partitionBy(*by, "__g")), F.max("__g").over(Window.partitionBy(*by))
    enough = F.col("__n") >= min_rows if inclusive else F.col("__n") > min_rows
    cut = cut.withColumn("__n", size).withColumn("__last", last).where((F.col("__last") == 0) | enough)
    return cut.withColumn("segment_id", F.dense_rank().over(Window.partitionBy(*by).orderBy("__g"))).drop("__g", "__n", "__last")


def gap_window(by: list[str], order: list[str]):
    return Window.partitionBy(*by).orderBy(*order)


def distance_break(by: list[str], order: list[str], x: str, y: str, max_gap: float) -> Column:
    w = gap_window(by, order)
    return planar(F.col(x), F.col(y), F.lag(x).over(w), F.lag(y).over(w)) > max_gap


def centred_frame(window: int) -> tuple[int, int]:
    after = (window - 1) // 2
    return -(window - 1 - after), after


def _away_from(centre: Column):
    return lambda x: F.abs(x - centre)


def _quartile(v: Column, p: float) -> Column:
    """The interpolated quantile (p: a number of quarters) of a sorted array, rounded as DuckDB does: low * (1 - d) is added to hi * d unrounded.

    Only three quarters of a number need more than its own digits: half and a quarter of it, and what their sum loses, are added apart."""
    at = (F.size(v) - 1) * F.lit(p)
    d = at - F.floor(at)
    low, high = F.get(v, F.floor(at).cast("int")), F.get(v, F.ceil(at).cast("int"))
    m, half, fourth = high * d, low * 0.5, low * 0.25
    most = half + fourth
    total = most + m
    back = total - most
    lost = (most - (total - back)) + (m - back) + (fourth - (most - half))
    return F.when(d == 0, low).when((d == 0.25) & (F.abs(total) < float("inf")), total + lost).otherwise(low * (1 - d) + m)


def rolling_outliers(df: DataFrame, by: list[str], order: list[str], axes: list[str], window: int = 41, min_rows: int = 15, iqr_k: float = 3.0, mad_k: float = 6.0, min_iqr: float = 1e-6, min_axes: int = 2) -> DataFrame:
    """df with flagged_axes (joined by |), flagged_axes_count and outlier.

    Per axis, over a centred frame with enough values: outside the interquartile fence, or, where the range is (nearly) zero,
    further from the median than mad_k robust standard deviations.
    """
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(*centred_frame(window))
    df = df.withColumns({f"__v_{a}": F.array_sort(F.collect_list(F.col(a).cast("double")).over(w)) for a in axes})
    df = df.withColumns({f"__q_{a}": F.array(*[_quartile(F.col(f"__v_{a}"), p) for p in (0.25, 0.5, 0.75)]) for a in axes})
    flags = []
    for a in axes:
        q, v = F.col(f"__q_{a}"), F.col(f"__v_{a}")
        dev = F.array_sort(F.transform(v, _away_from(q[1])))
        n = F.size(dev)
        mad = (F.get(dev, F.floor((n - 1) / 2).cast("int")) + F.get(dev, F.floor(n / 2).cast("int"))) / 2
        iqr, x = q[2] - q[0], F.col(a)
        fence = (x < q[0] - iqr_k * iqr) | (x > q[2] + iqr_k * iqr)
        flags.append(F.coalesce((F.size(v) >= min_rows) & F.when(iqr > min_iqr, fence).otherwise(F.abs(x - q[1]) > mad_k * 1.4826 * mad), F.lit(False)))
    names = F.filter(F.array(*[F.when(f, F.lit(a)) for f, a in zip(flags, axes, strict=True)]), lambda x: x.isNotNull())
    df = df.withColumn("__names", names)
    out = df.withColumn("flagged_axes", F.array_join("__names", "|")).withColumn("flagged_axes_count", F.size("__names")).withColumn("outlier", F.size("__names") >= min_axes)
    return out.drop("__names", *[f"__{k}_{a}" for k in "qv" for a in axes])


def ring_mean(value: Column, by: list[str], order: list[str], window: int) -> Column:
    """Sum of the last `window` values over `window`: a ring of zeros that fills up."""
    return F.sum(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(-(window - 1), 0)) / window


def interpolate(df: DataFrame, by: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Nulls filled linearly by row position; leading and trailing ones by the nearest value."""
    w = Window.partitionBy(*by).orderBy(*order)
    df = df.withColumn("__i", F.row_number().over(w))
    for c in columns:
        here = F.when(F.col(c).isNotNull(), F.struct(F.col("__i").alias("i"), F.col(c).alias("v")))
        df = df.withColumn("__a", F.last(here, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("__b", F.first(here, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
        line = F.col("__a.v") + (F.col("__b.v") - F.col("__a.v")) * (F.col("__i") - F.col("__a.i")) / (F.col("__b.i") - F.col("__a.i"))
        df = df.withColumn(c, F.coalesce(F.col(c), line, F.col("__a.v"), F.col("__b.v")))
    return df.drop("__i", "__a", "__b")


def movement(df: DataFrame, by: list[str], order: list[str], x: str, y: str, min_move: float = 0.5) -> DataFrame:
    """mx, my: the step to each row (the first copies the second), averaged over three rows inside; has_move."""
    w = Window.partitionBy(*by).orderBy(*order)
    for c, m in ((x, "mx"), (y, "my")):
        step = F.col(c) - F.lag(c).over(w)
        df = df.withColumn(m, F.coalesce(step, F.lead(c).over(w) - F.col(c), F.lit(0.0)))
    smooth = lambda m: F.when(F.lag(m).over(w).isNull() | F.lead(m).over(w).isNull(), F.col(m)).otherwise((F.lag(m).over(w) + F.col(m) + F.lead(m).over(w)) / 3)
    df = df.withColumns({"__mx": smooth("mx"), "__my": smooth("my")}).withColumns({"mx": F.col("__mx"), "my": F.col("__my")}).drop("__mx", "__my")
    return df.withColumn("has_move", F.sqrt(F.col("mx") ** 2 + F.col("my") ** 2) > min_move)


def patience(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """best_so_far and rows since it was last improved."""
    w = Window.partitionBy(*by).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("__before", F.max(value).over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("best_so_far", F.max(value).over(upto)).withColumn("__i", F.row_number().over(w))
    better = F.when(F.col("__before").isNull() | (F.col(value) > F.col("__before")), F.col("__i"))
    return df.withColumn("since_best", F.col("__i") - F.last(better, ignorenulls=True).over(upto)).drop("__before", "__i")


def clock_fold(markers: DataFrame, by: list[str], order: list[str], anchor: str, clock_s: str, rows: str) -> DataFrame:
    """Absolute times of clock markers, folded in order: by, and pos, t (epoch seconds) per marker.

    A marker (seconds of the day) is read on the current date, a day later if that lies over 12 hours back, and one second after
    the current time if it still doesn't advance. anchor: epoch seconds at which the fold begins. Keys are sorted, not gathered, and
    each marker is one step on the time before it.
    """
    w = Window.partitionBy(*by).orderBy(*order, "c", "n")
    marks = markers.select(*by, *[F.col(c) for c in order if c not in by], F.col(anchor).cast("long").alias("__anchor"), F.col(clock_s).cast("long").alias("c"), F.col(rows).cast("long").alias("n"))
    least = F.min("__anchor").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    lined = marks.select(*by, (F.row_number().over(w) - 1).alias("pos"), least.alias("__a"), "c", "n").where("__a is not null")
    k, names = len(by), [*by, "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None  # a key's markers follow each other in order, over batches too
        for batch in batches:
            begin, until = [], []
            for pos, a, c in zip(*(batch.column(k + i).to_pylist() for i in range(3)), strict=True):
                now = a if pos == 0 else now
                t = None if now is None or c is None else now - now % 86_400 + c
                if t is not None:
                    t += 86_400 * (t < now - 43_200)
                    t = max(t, now + 1)
                begin.append(now)
                until.append(t)
                now = t
            yield pa.RecordBatch.from_arrays([*batch.columns[: k + 1], pa.array(begin, pa.int64()), pa.array(until, pa.int64()), batch.column(k + 3)], names=[*names, "begin", "t", "n"])

    fields = [T.StructField("begin", T.LongType()), T.StructField("t", T.LongType()), T.StructField("n", T.LongType())]
    return lined.mapInArrow(run, T.StructType([*lined.schema.fields[: k + 1], *fields]))


def clock_rows(df: DataFrame, by: list[str], order: list[str], anchor: str, clock_s: str) -> DataFrame:
    """The rows without a clock value, with t_us (epoch microseconds): row i of the N up to the next marker stands i/N seconds behind
    the time before them, that is, the last marker's or the anchor. Rows of a key without an anchor are left out.

    Markers are the rows with a clock value (seconds of the day), read as in clock_fold.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    placed = df.withColumn("__pos", F.coalesce(F.count(clock_s).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    block = Window.partitionBy(*by, "__pos")
    data = placed.where(F.col(clock_s).isNull()).withColumn("__i", F.row_number().over(block.orderBy(*order))).withColumn("__n", F.count("*").over(block))
    times = clock_fold(placed.where(F.col(clock_s).isNotNull()).withColumn("__rows", F.lit(0)), by, order, anchor, clock_s, "__rows")
    # what follows marker p begins at its time; what precedes the first one begins at the anchor
    begun = times.select(*by, (F.col("pos") + 1).cast("long").alias("__pos"), F.col("t").alias("__t"))
    begin = F.coalesce("__t", F.when(F.col("__pos") == 0, F.col(anchor).cast("long")))
    timed = data.withColumn("__pos", F.col("__pos").cast("long")).join(begun, [*by, "__pos"], "left").withColumn("__t", begin).where("__t is not null")
    t_us = F.col("__t") * 1_000_000 + F.rint(F.col("__i") * (F.lit(1.0) / F.col("__n")) * 1e6).cast("long")
    return timed.withColumn("t_us", t_us).drop("__pos", "__i", "__n", "__t", clock_s)
