"""Tracks as streams: rows of a key are put in order of time, then go through a state one by one; the state is small and ends.

A row waits until the watermark passes its time, so any split of a track into micro-batches, and any disorder within the delay,
gives the same rows. Late rows (older than the watermark) are dropped. A key that is silent for `expire` (in event time) is closed:
what is still held is returned, its state goes, and later rows of the key are a new track. The session must use the RocksDB state
store (spark.sql.streaming.stateStore.providerClass).
"""

from __future__ import annotations

import json
import math
import pickle
import uuid
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from terraline import scratch
from terraline.operators.matcher import MatchConfig, lock_step, reachable, segment_cells


class InOrder(StatefulProcessor):
    """Rows (us, ord, ...) of a key, ordered by both. Subclasses have step() for the rows of one (us, ord), and close()."""

    def __init__(self, held: T.StructType, out: T.StructType, expire_us: int) -> None:
        self.held, self.out, self.expire_us = held, out, expire_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.memory = handle.getValueState("memory", "text string")

    def close(self) -> None:
        pass

    def step(self, memory: dict[str, Any], rows: list[tuple]) -> list[tuple]:
        raise NotImplementedError

    def finish(self, memory: dict[str, Any]) -> list[tuple]:
        raise NotImplementedError

    def advance(self, key: tuple, rows: list[tuple], watermark_us: int) -> Iterator[Row]:
        # one value holds all: the rows that wait, the memory of those gone by and the timer; each access of a state is a message to the JVM
        state = self.memory.get()
        waiting, memory, timer = json.loads(state[0]) if state else ([], {}, None)
        rows = sorted([*(tuple(r) for r in waiting), *(r for r in rows if r[0] >= watermark_us and [r[0], r[1]] > memory.get("at", []))])
        ready = [r for r in rows if r[0] <= watermark_us]
        rest, out = rows[len(ready) :], []
        for at, same in groupby(ready, key=lambda r: [r[0], r[1]]):
            if memory and at[0] > memory["at"][0] + self.expire_us:
                out += self.finish(memory)
                memory = {}
            out += self.step(memory, list(same))
            memory["at"] = at
        due = rest[0][0] if rest else None
        if memory and memory["at"][0] + self.expire_us < watermark_us:
            out += self.finish(memory)
            memory = {}
        if memory:
            due = min(due or memory["at"][0] + self.expire_us, memory["at"][0] + self.expire_us)
        now = None if due is None else due // 1000 + 1
        if timer is not None and timer != now:
            self.handle.deleteTimer(timer)
        if now is not None and timer != now:
            self.handle.registerTimer(now)
        if memory or rest:
            self.memory.update((json.dumps([rest, memory, now]),))
        elif state:
            self.memory.clear()
        row = Row(*self.out.names)
        yield from (row(*key, *r) for r in out)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        pick = itemgetter(*self.held.names)
        new = [pick(r) for r in rows]
        yield from self.advance(key, new, timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        yield from self.advance(key, [], timerValues.getCurrentWatermarkInMs() * 1000)


#: A candidate edge of a row in its packed form: the edge's nearest segment, and whether any of its segments is hit.
NEAR = np.dtype([("edge", "<i8"), ("dist", "<f8"), ("seg", "<i8"), ("qx", "<f8"), ("qy", "<f8"), ("sx", "<f8"), ("sy", "<f8"), ("hit", "?")])


def nearest(found: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """found (NEAR, a segment each) as one for each edge of a row, by row and edge: the nearest segment of lowest number; and their rows."""
    by = np.lexsort((found["seg"], found["dist"], found["edge"], row))
    found, row = found[by], row[by]
    head = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (found["edge"][1:] != found["edge"][:-1])][: len(row)])
    best = found[head]
    if len(head):
        best["hit"] = np.logical_or.reduceat(found["hit"], head)
    return best, row[head]


def with_candidates(rows: DataFrame, cells: DataFrame, cfg: MatchConfig, track: str, time: str) -> DataFrame:
    """rows (track, time, us, ord, x, y) with near, their candidates packed (NEAR): a row each, but for those that a batch cuts.

    Rows of one place within a batch are joined as one, SPOT at most, and are rows again when the candidates are packed."""
    kinds = T.StructType([*rows.schema])
    those = T.StructType([f for f in kinds if f.name not in ("x", "y")])
    spots = rows.mapInArrow(gather(those.names), T.StructType([T.StructField("spot", T.BinaryType()), T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType()), T.StructField("rows", T.ArrayType(those))]))
    found = reachable(spots, cells, cfg, "left").select(*spots.columns, F.col("edge_id").cast("long").alias("edge"), "hit", "best.dist", F.col("best.seg_idx").cast("long").alias("seg"), *[f"best.{c}" for c in ("qx", "qy", "sx", "sy")])
    return found.mapInArrow(pack, T.StructType([*those, T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType()), T.StructField("near", T.BinaryType())]))


def gather(names: list[str]):
    """Rows of one place in a batch as one row with all of them, and a name that no other has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
            by = np.lexsort((y, x))
            x, y = x[by], y[by]
            new = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])][: len(x)]
            start = np.flatnonzero(new)
            new[np.arange(len(x)) - start[np.cumsum(new) - 1] & (SPOT - 1) == 0] = True
            start = np.flatnonzero(new)
            batch = batch.take(pa.array(by))
            each = pa.StructArray.from_arrays([batch.column(c) for c in names], names)
            spot, run_id = range(len(start)), uuid.uuid4().bytes
            yield pa.RecordBatch.from_arrays(
                [pa.array([run_id + i.to_bytes(4, "big") for i in spot], pa.binary()), pa.array(x[start]), pa.array(y[start]), pa.ListArray.from_arrays(pa.array(np.r_[start, len(x)].astype(np.int32)), each)], names=["spot", "x", "y", "rows"]
            )

    return run


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places, each with a segment near it, become their rows with the place's candidates packed. Segments of a place that don't come one
    after the other (another batch) make rows of their own; who reads them puts them together."""
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.ones(batch.num_rows, bool)
        new[1:] = pc.not_equal(batch.column("spot")[1:], batch.column("spot")[:-1]).to_numpy(zero_copy_only=False)
        there = batch.column("edge").is_valid().to_numpy(zero_copy_only=False)
        some = batch.select(NEAR.names).filter(pa.array(there))
        found = np.empty(some.num_rows, NEAR)
        for c in NEAR.names:
            found[c] = some.column(c).to_numpy(zero_copy_only=False)
        best, spot = nearest(found, (np.cumsum(new) - 1)[there])
        ends = np.r_[0, np.cumsum(np.bincount(spot, minlength=int(new.sum())))].astype(np.int32) * np.int32(NEAR.itemsize)
        near = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(best.tobytes())])
        heads = batch.select(["x", "y", "rows"]).filter(pa.array(new))
        each, of = pc.list_flatten(heads.column("rows")), pc.list_parent_indices(heads.column("rows"))
        for k in range(0, len(each), 10_000):
            part, its = each.slice(k, 10_000), of.slice(k, 10_000)
            yield pa.RecordBatch.from_arrays([*part.flatten(), *(c.take(its) for c in (heads.column("x"), heads.column("y"), near))], names=[*(f.name for f in part.type), "x", "y", "near"])


SPOT = 64  # rows of a place that are joined as one; a power of two
CHOSEN, HELD, WAITS = 0, 1, 2  # what has become of a row: its edge is out, its direction waits for the next row, its time hasn't come
GROUPS = 256  # of tracks, each one state
CONTEXT = 3  # rows of an open track that are kept: the held one and the two before it, as smoothing looks two rows back


class EdgeChoice(StatefulProcessor):
    """Tracks of a group, all at once: the last chosen edges of each, its rows whose time hasn't come, and the row whose direction isn't
    known before the next one (with its candidates and the two rows before it)."""

    def __init__(self, track: str, out: T.StructType, expire_us: int, cfg: MatchConfig) -> None:
        self.track, self.out, self.expire_us, self.cfg = track, out, expire_us, cfg

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.memory = handle.getValueState("memory", "packed binary")

    def close(self) -> None:
        pass

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        yield from self.advance([r[[self.track, "us", "ord", "x", "y", "near"]] for r in rows], timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        yield from self.advance([], timerValues.getCurrentWatermarkInMs() * 1000)

    def advance(self, new: list[pd.DataFrame], watermark_us: int) -> Iterator[pd.DataFrame]:
        state = self.memory.get()
        old, recent, timer = pickle.loads(state[0]) if state else (None, {}, None)
        frames = [f[f["us"] >= watermark_us].assign(stage=WAITS) for f in new] + ([] if old is None else [old])
        out, old, recent = self.go_on(pd.concat(frames, ignore_index=True), recent, watermark_us)
        due = [*old["us"][old["stage"] == WAITS], *(old["us"][old["stage"] == HELD] + self.expire_us)]
        now = min(due) // 1000 + 1 if due else None
        if timer is not None and timer != now:
            self.handle.deleteTimer(timer)
        if now is not None and timer != now:
            self.handle.registerTimer(int(now))
        if due:
            self.memory.update((pickle.dumps((old, recent, None if now is None else int(now)), pickle.HIGHEST_PROTOCOL),))
        elif state:
            self.memory.clear()
        if len(out):
            yield out

    def go_on(self, rows: pd.DataFrame, recent: dict, watermark_us: int) -> tuple[pd.DataFrame, pd.DataFrame, dict]:
        """The rows that come out, those that stay, and the last chosen edges of the tracks that are open."""
        rows = whole_rows(rows, self.track)
        ready = (rows["us"] <= watermark_us).to_numpy()
        rest, rows = rows[~ready], rows[ready].reset_index(drop=True)
        n, names, us = len(rows), rows[self.track].to_numpy(), rows["us"].to_numpy()
        stage, x, y = (rows[c].to_numpy() for c in ("stage", "x", "y"))
        other = np.r_[True, names[1:] != names[:-1]][:n]
        head = other.copy()
        head[1:] |= us[1:] > us[:-1] + self.expire_us  # a silent track was closed
        first = np.flatnonzero(head)
        last = np.r_[first[1:], n][: len(first)]  # a visit is first to last
        visit = np.cumsum(head) - 1
        is_open = np.r_[other[first[1:]], True][: len(first)] & (us[last - 1] + self.expire_us >= watermark_us)
        end = np.zeros(n, bool)
        end[last - 1] = True
        goes = (stage != CHOSEN) & ~(end & is_open[visit])
        moves = [self.moved(c, head, end) for c in (x, y)]
        found = np.frombuffer(b"".join(rows["near"][goes]), NEAR)
        size = np.array([len(b) for b in rows["near"][goes]], np.int64) // NEAR.itemsize
        # of rows that came in parts an edge may stand there twice
        found, row = nearest(found, np.repeat(np.arange(len(size)), size))
        found, row = found[found["hit"]], row[found["hit"]]
        until = np.cumsum(np.bincount(row, minlength=len(size)))
        score = self.scores(found, *(m[goes][row] for m in moves))
        before = [recent.get(names[a], []) if other[a] else [] for a in first]
        held = np.array([len(b) for b in before], np.int64)
        start = np.zeros((len(first), self.cfg.history), np.int64)
        for i in np.flatnonzero(held):
            start[i, : held[i]] = before[i]
        upto = np.r_[0, np.cumsum(goes)]
        a, z = upto[first], upto[last]
        picked, _, _, after, after_held = lock_step(found["edge"], score, np.r_[0, until][:-1], until, a, a, z, start, held, self.cfg)
        there, best = picked >= 0, found[picked[picked >= 0]]
        out = pd.DataFrame({c: rows[r][goes].to_numpy() for c, r in zip(self.out.names, (self.track, "ord", "x", "y", "x", "y"), strict=False)})
        for c, v in zip(self.out.names[2:4], ("qx", "qy"), strict=True):
            out.loc[there, c] = best[v]
        edge, dist = np.zeros(len(out), np.int64), np.full(len(out), np.nan)
        edge[there], dist[there] = best["edge"], best["dist"]
        out[self.out.names[6]] = pd.arrays.IntegerArray(edge, ~there)
        out[self.out.names[7]] = pd.arrays.FloatingArray(np.where(there, dist, 0.0), ~there)
        stays = is_open[visit] & (last[visit] - np.arange(n) <= CONTEXT)
        kept = rows[stays].copy()
        kept["stage"] = np.where(end[stays], HELD, CHOSEN)
        kept["near"] = [b if e else b"" for b, e in zip(kept["near"], end[stays], strict=True)]
        recent = {names[first[i]]: after[i, : after_held[i]].tolist() for i in np.flatnonzero(is_open)}
        return out, pd.concat([kept, rest], ignore_index=True), recent

    def moved(self, at: np.ndarray, head: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The mean of a row's step and those beside it; the first row copies the second, and both ends are as they are."""
        if not len(at):
            return at
        step = np.diff(at, prepend=at[:1])
        after = np.r_[step[1:], 0.0]
        step = np.where(head, np.where(end, 0.0, after), step)
        return np.where(head | end, step, (np.r_[0.0, step[:-1]] + step + after) / 3)

    def scores(self, found: np.ndarray, mx: np.ndarray, my: np.ndarray) -> np.ndarray:
        bearing = lambda dx, dy: (np.degrees(np.arctan2(dx, dy)) + 360) % 360
        d = np.abs(bearing(mx, my) - bearing(found["sx"], found["sy"])) % 360
        known = (np.sqrt(mx**2 + my**2) > 0.5) & (np.sqrt(found["sx"] ** 2 + found["sy"] ** 2) > 0.1)
        apart = np.where(known, np.minimum(1.0, np.minimum(d, 360 - d) / 90), 0.0)
        return found["dist"] / self.cfg.max_dist_m * (1 - self.cfg.dir_weight) + apart * self.cfg.dir_weight


def whole_rows(rows: pd.DataFrame, track: str) -> pd.DataFrame:
    """rows by track and time, those that came in parts made one again; without new rows up to the last one that a track has gone by."""
    rows = rows.sort_values([track, "us", "ord", "stage", "x", "y"], ignore_index=True)
    names, us, no, stage, x, y = (rows[c].to_numpy() for c in (track, "us", "ord", "stage", "x", "y"))
    code = np.cumsum(np.r_[True, names[1:] != names[:-1]][: len(rows)]) - 1
    by = np.full(len(rows), -1)  # a track's last row gone by
    seen = np.flatnonzero(stage != WAITS)
    by[code[seen]] = seen
    by = by[code]
    late = (stage == WAITS) & (by >= 0) & ((us < us[by]) | ((us == us[by]) & (no <= no[by])))
    if late.any():
        return whole_rows(rows[~late], track)
    head = np.ones(len(rows), bool)
    head[1:] = (code[1:] != code[:-1]) | (us[1:] != us[:-1]) | (no[1:] != no[:-1])
    if head.all():
        return rows
    first = np.flatnonzero(head)
    of = first[np.cumsum(head) - 1]
    same = (x == x[of]) & (y == y[of])  # of two places in one moment the first counts
    near = rows["near"].tolist()
    parts = np.flatnonzero(same & ~head)
    for i in parts:
        near[of[i]] += near[i]
    return rows.assign(near=near)[head].reset_index(drop=True)


def match_stream(stream: DataFrame, edges: DataFrame, track: str = "track", order: str = "ord", time: str = "ts", cfg: MatchConfig = MatchConfig(), delay: str = "30 seconds", expire: str = "10 minutes", groups: int = GROUPS) -> DataFrame:
    """match_tracks over a stream: track, order, x, y, x_raw, y_raw, edge_id, dist_to_road_m.

    stream: track, order (whole numbers that rise with the time), time, x, y; rows that lack one of them are left out. A row is
    returned when the track's next one has passed the watermark, as its direction needs both neighbours; the last one when the track
    is closed. Smoothing (smooth_min_run above 1) looks forward without bound and is not done. Tracks are dealt to a number of groups,
    whose rows are chosen in lock step; it must stay the same as long as a checkpoint is used.
    """
    scratch.send_code(stream.sparkSession)
    cells = scratch.at_rest(segment_cells(edges, cfg.max_dist_m), "segment-cells")
    whole = stream.where(" and ".join(f"`{c}` is not null" for c in (track, order, time, "x", "y")))
    rows = whole.select(track, time, F.unix_micros(F.col(time).cast("timestamp")).alias("us"), F.col(order).cast("long").alias("ord"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    group = F.pmod(F.xxhash64(track), F.lit(groups)).alias("__group")
    flat = with_candidates(rows, cells, cfg, track, time).withWatermark(time, delay).select("*", group)
    double = ["x", "y", "x_raw", "y_raw"]
    out = T.StructType([stream.schema[track], T.StructField(order, T.LongType()), *(T.StructField(c, T.DoubleType()) for c in double), T.StructField("edge_id", T.LongType()), T.StructField("dist_to_road_m", T.DoubleType())])
    return flat.groupBy("__group").transformWithStateInPandas(EdgeChoice(track, out, micros(expire), cfg), out, "append", "EventTime")


class GapSegments(InOrder):
    """The last position and the number of the segment; its rows only as long as it may still be dropped for its size."""

    def __init__(self, held: T.StructType, out: T.StructType, expire_us: int, max_gap: float, min_rows: int) -> None:
        super().__init__(held, out, expire_us)
        self.max_gap, self.min_rows = max_gap, min_rows

    def step(self, memory: dict[str, Any], rows: list[tuple]) -> list[tuple]:
        out = []
        for row in rows:
            x, y = row[2:4]
            last = memory.get("last")
            if last and math.sqrt((x - last[0]) ** 2 + (y - last[1]) ** 2) > self.max_gap:
                memory["cut"], memory["id"] = True, memory["id"] + (not memory["small"])
                memory["small"], memory["rows"] = True, []
            if not last:
                memory |= {"cut": False, "id": 1, "small": True, "rows": []}
            memory["last"] = [x, y]
            if memory["small"]:
                memory["rows"].append(row[1:4])
                if len(memory["rows"]) > self.min_rows:
                    out += [(*r, memory["id"]) for r in memory["rows"]]
                    memory["small"], memory["rows"] = False, []
            else:
                out.append((*row[1:4], memory["id"]))
        return out

    def finish(self, memory: dict[str, Any]) -> list[tuple]:
        return [] if memory["cut"] else [(*r, 1) for r in memory["rows"]]


def segment_stream(stream: DataFrame, key: str, order: str, time: str, x: str, y: str, max_gap: float, min_rows: int = 10, delay: str = "30 seconds", expire: str = "10 minutes") -> DataFrame:
    """split_segments by distance over a stream: key, order, x, y and segment_id of the rows that are kept.

    A step longer than max_gap begins a segment; segments of min_rows rows or fewer go, but for a track without any cut. Rows are
    returned once their segment is large enough, so at most min_rows rows a key are held beyond the watermark's delay. order: whole
    numbers that rise with the time; rows that lack a key, order, time or position are left out.
    """
    scratch.send_code(stream.sparkSession)
    whole = stream.where(" and ".join(f"`{c}` is not null" for c in (key, order, time, x, y)))
    rows = whole.withWatermark(time, delay).select(key, time, F.unix_micros(F.col(time).cast("timestamp")).alias("us"), F.col(order).cast("long").alias("ord"), *[F.col(c).cast("double").alias(n) for c, n in ((x, "at_x"), (y, "at_y"))])
    held = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema if f.name not in (key, time)])
    out = T.StructType([stream.schema[key], T.StructField(order, T.LongType()), T.StructField(x, T.DoubleType()), T.StructField(y, T.DoubleType()), T.StructField("segment_id", T.LongType())])
    return rows.groupBy(key).transformWithState(GapSegments(held, out, micros(expire), max_gap, min_rows), out, "append", "EventTime")


def micros(interval: str) -> int:
    return int(pd.Timedelta(interval) / pd.Timedelta("1us"))
