"""Motion: gradients of signals, absolute clocks, feature crosses, and an extended Kalman filter over a track."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraline import scratch


def gyro_rad_s(mdeg_s: Column) -> Column:
    """Thousandths of a degree a second as radians a second."""
    return mdeg_s * (math.pi / 180_000)


def absolute_time(start: Column, elapsed_us: Column) -> Column:
    """Inferred: a session's start plus the microseconds counted since."""
    return F.timestamp_micros(F.expr("0") + F.unix_micros(start.cast("timestamp")) + elapsed_us).cast("timestamp_ntz")


def feature_crosses(df: DataFrame, speed: str = "speed_kmh", phi: str = "phi_lidar") -> DataFrame:
    return df.withColumns({"speed_x_phi": F.col(speed) * F.col(phi), "speed_sq": F.col(speed) * F.col(speed)})


def gradient(df: DataFrame, by: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Central differences, one-sided at the ends; null for a single row."""
    w = Window.partitionBy(*by).orderBy(*order)
    before, after, here = F.lag(value).over(w), F.lead(value).over(w), F.col(value)
    return df.withColumn(out, F.when(before.isNull(), after - here).when(after.isNull(), here - before).otherwise((after - before) / 2))


def centred_mean(df: DataFrame, by: list[str], order: list[str], value: str, out: str, width: int = 5) -> DataFrame:
    """Convolution with `width` equal weights; beyond the ends counts as 0."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-(width // 2), (width - 1) // 2)
    return df.withColumn(out, F.sum(value).over(w) / width)


@dataclass(frozen=True)
class Noise:
    """Deviations: of the process per second (position, speed, heading), and of a fix (metres at hdop 1, speed)."""

    position: float = 0.5
    speed: float = 1.0
    heading: float = 0.1
    fix: float = 2.5
    fix_speed: float = 0.5


class Kalman:
    """State x, y, speed, heading (radians, counter-clockwise from east, in (-pi, pi]); inferred, as only its tests are known.

    It starts at the first fix, with that fix's variance. The first displacement longer than four deviations of a fix tells the
    heading; until then the way of a step is unknown, so it moves nothing but widens the position's variance by its length."""

    def __init__(self, noise: Noise = Noise()) -> None:
        self.noise, self.x, self.P, self.origin = noise, None, np.diag([1e3, 1e3, 100.0, math.pi**2]), None

    def start(self, x: float, y: float, speed: float | None, hdop: float) -> None:
        fix = (self.noise.fix * hdop) ** 2
        self.x, self.origin = np.array([x, y, speed or 0.0, 0.0]), (x, y)
        self.P = np.diag([fix, fix, 100.0 if speed is None else self.noise.fix_speed**2, math.pi**2])

    def jacobian(self, dt: float) -> np.ndarray:
        v, h = self.x[2:]
        out = np.eye(4)
        out[0, 2:] = math.cos(h) * dt, -v * math.sin(h) * dt
        out[1, 2:] = math.sin(h) * dt, v * math.cos(h) * dt
        return out

    def predict(self, accel: float, yaw_rate: float, dt: float) -> None:
        if self.x is None:
            return
        v, h = self.x[2:]
        n = self.noise
        if self.origin is not None:
            self.x = self.x + np.array([0.0, 0.0, accel * dt, 0.0])
            self.P = self.P + np.diag([(v * dt) ** 2 + n.position**2 * dt] * 2 + [n.speed**2 * dt, 0.0])
            return
        J = self.jacobian(dt)
        self.x = self.x + np.array([v * math.cos(h) * dt, v * math.sin(h) * dt, accel * dt, yaw_rate * dt])
        self.P = J @ self.P @ J.T + np.diag([n.position**2, n.position**2, n.speed**2, n.heading**2]) * dt
        self.turn()

    def update(self, x: float, y: float, speed: float | None, hdop: float = 1.0) -> None:
        """A fix; without a speed only its position is measured."""
        if self.x is None:
            self.start(x, y, speed, hdop)
            return
        if self.origin and math.hypot(x - self.origin[0], y - self.origin[1]) > 4 * self.noise.fix * hdop:
            self.x[3] = math.atan2(y - self.origin[1], x - self.origin[0])
            self.x[:2], self.P = (x, y), self.P * np.outer([0, 0, 1, 0], [0, 0, 1, 0])
            self.P += np.diag([(self.noise.fix * hdop) ** 2] * 2 + [0, 2 / 16])
            self.origin = None
        rows = 2 if speed is None else 3
        H = np.eye(rows, 4)
        R = np.diag([(self.noise.fix * hdop) ** 2] * 2 + [self.noise.fix_speed**2])[:rows, :rows]
        S = H @ self.P @ H.T + R
        K = np.linalg.solve(S, H @ self.P).T
        self.x = self.x + K @ (np.array([x, y, speed][:rows], float) - H @ self.x)
        left = np.eye(4) - K @ H
        self.P = left @ self.P @ left.T + K @ R @ K.T
        self.turn()

    def turn(self) -> None:
        self.x[3] = math.pi - (math.pi - self.x[3]) % (2 * math.pi)


def kalman_track(df: DataFrame, by: str, time_s: str, x: str, y: str, speed: str, hdop: str, accel: str, yaw_rate: str, noise: Noise = Noise()) -> DataFrame:
    """by, time_s and the filtered ekf_x, ekf_y, ekf_speed, ekf_heading of every row, in order of time (a whole key is one pass, but
    only its filter is held).

    Rows without a position are predicted only; before the first fix there is no state, and nulls are returned. A null time is
    taken as no time passed (such rows come first). A null speed leaves a measurement of the position alone; a null hdop is 1."""
    scratch.send_code(df.sparkSession)
    cols = [by, time_s, x, y, speed, hdop, accel, yaw_rate]
    rows = df.select(by, *[F.col(c).cast("double").alias(c) for c in cols[1:]]).repartition(by).sortWithinPartitions(by, time_s, x, y)
    fields = [T.StructField(c, T.DoubleType()) for c in (time_s, "ekf_x", "ekf_y", "ekf_speed", "ekf_heading")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last, ekf = object(), None, Kalman(noise)
        for batch in batches:
            states = []
            for k, t, px, py, v, h, a, w in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    key, last, ekf = k, None, Kalman(noise)
                ekf.predict(a or 0.0, w or 0.0, 0.0 if t is None or last is None else max(0.0, t - last))
                last = last if t is None else t
                if px is not None and py is not None:
                    ekf.update(px, py, v, h or 1.0)
                states.append([None] * 4 if ekf.x is None else ekf.x.tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([s[i] for s in states], pa.float64()) for i in range(4))], names=[by, *(f.name for f in fields)])

    return rows.mapInArrow(run, T.StructType([df.schema[by], *fields]))
