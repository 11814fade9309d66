"""Embedding whitening by hierarchical SVD merging.

Entries become integers x = floor(64 * c) + 1000000; the fit list is each distinct x vector once. A partition of the fit list
keeps its count, exact sums and a factor R, the singular values times the right singular vectors of its centred rows, at full
rank. Two of them merge without loss: their factors are stacked over one more row, the difference of the means times
sqrt(n1 n2 / (n1 + n2)), and decomposed again. Batches merge so within a partition, partitions in groups of FAN, round after
round, until one is left. Its right singular vectors are the components, and the squares of its singular values over n the
eigenvalues of the covariance (divisor n). Means are differences of exact integers, so the offset costs no digits.

Defined cases. Rows whose vector is null, or holds a null or non-finite entry, are dropped. Shorter vectors are filled up with
entries c = 0. Entries beyond 2^62 / 64 saturate. Components without variance (to double precision) have no whitened value and
are left out: fewer than 17 dimensions, few different vectors or one vector only give fewer components or none. A deviation
beyond a long is null. Repeated rows, ids and null ids: each row is returned. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraline.llm import common, vectors

SCALE, OFFSET, COMPONENTS, FAN = 64, 1_000_000, 16, 4
_ROWS = 2048
_PART = "part long, n long, sums array<string>, factor binary"


@dataclass
class Part:
    """Count, exact sums (Python integers) and factor of some rows: factor.T @ factor is the scatter matrix about their mean."""

    n: int
    sums: np.ndarray
    factor: np.ndarray

    def row(self, part: int) -> tuple:
        return part, self.n, [str(s) for s in self.sums], self.factor.astype("<f8").tobytes()

    @classmethod
    def of(cls, n: int, sums: list[str], factor: bytes) -> Part:
        s = np.array([int(x) for x in sums], object)
        return cls(int(n), s, np.frombuffer(factor, "<f8").reshape(-1, len(s)))


def column_sums(x: np.ndarray) -> np.ndarray:
    small = np.abs(x).max(initial=0) < 2**62 // max(1, len(x))
    return (x.sum(axis=0) if small else x.astype(object).sum(axis=0)).astype(object)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n in doubles: the whole part of the mean is taken off exactly."""
    whole = np.array([s // n for s in sums], object)
    rest = np.array([s % n / n for s in sums], float)
    if np.abs(x).max(initial=0) < 2**61:
        return (x - whole.astype(np.int64)).astype(float) - rest
    return (x.astype(object) - whole).astype(float) - rest


def factor_of(rows: np.ndarray) -> np.ndarray:
    _, s, v = np.linalg.svd(rows, full_matrices=False)
    return s[:, None] * v


def summarised(x: np.ndarray) -> Part:
    sums = column_sums(x)
    return Part(len(x), sums, factor_of(centred(x, len(x), sums)))


def merged(a: Part | None, b: Part) -> Part:
    if a is None:
        return b
    apart = np.array([(s * b.n - t * a.n) / (a.n * b.n) for s, t in zip(a.sums, b.sums, strict=True)], float)
    correction = np.sqrt(a.n * b.n / (a.n + b.n)) * apart
    return Part(a.n + b.n, a.sums + b.sums, factor_of(np.vstack([a.factor, b.factor, correction])))


def local_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for a partition of the fit list."""
    found = None
    for batch in batches:
        for a in range(0, batch.num_rows, _ROWS):
            found = merged(found, summarised(vectors.dense(batch.slice(a, _ROWS).column("x"))))
    if found:
        part, n, sums, factor = found.row(TaskContext.get().partitionId())
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([n]), pa.array([sums], pa.list_(pa.string())), pa.array([factor], pa.binary())], names=["part", "n", "sums", "factor"])


def merge_group(group: pd.DataFrame) -> pd.DataFrame:
    found = None
    for r in group.sort_values("part").itertuples():
        found = merged(found, Part.of(r.n, r.sums, r.factor))
    return pd.DataFrame([found.row(int(group["part"].min()) // FAN)], columns=["part", "n", "sums", "factor"])


@dataclass
class Model:
    """What whitening needs: at most `components` directions, whatever the number of rows."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    values: np.ndarray
    total: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ self.directions.T / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - sums) ** 2, exact."""
        whole = np.array([s // self.n for s in self.sums], object)
        rest = np.array([s % self.n for s in self.sums], object)
        most = float(np.abs(x.astype(float) - whole.astype(float)).max(initial=0)) + 1
        if most < 2**60 and max(most, self.n) * most * max(1, x.shape[1]) < 2**62:  # (n y - r)^2 by its three sums, which fit
            y = x - whole.astype(np.int64)
            squares, crossed = ((y * z).sum(axis=1).astype(object) for z in (y, rest.astype(np.int64)))
            total = self.n**2 * squares - 2 * self.n * crossed + sum(int(r) ** 2 for r in rest)
        else:
            d = self.n * (x.astype(object) - whole) - rest
            total = (d * d).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in total]


def integer_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id and x of every usable row, all x of one length."""
    rows = table.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(vectors.usable(F.col("v")))
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    most = float(2**62)
    x = F.transform("v", lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-most)), F.lit(most))) + OFFSET)
    return rows.select("id", F.when(F.size("v") == width, x).otherwise(F.concat(x, F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(width) - F.size("v")))).alias("x"))


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Model | None:
    """The model of all rows of a table of x vectors; None if there are no rows or no dimensions."""
    spark = distinct.sparkSession
    parts, _ = common.materialize(distinct.mapInArrow(local_parts, _PART), "whitening-parts")
    left = (parts.agg(F.max("part")).first()[0] or 0) + 1
    while left > 1:
        parts = parts.groupBy(F.floor(F.col("part") / FAN)).applyInPandas(merge_group, _PART)
        left = -(-left // FAN)
    row = parts.first()  # a factor of dimensions x dimensions
    if row is None or not row["sums"]:
        return None
    whole = Part.of(row["n"], row["sums"], bytes(row["factor"]))
    _, s, v = np.linalg.svd(whole.factor, full_matrices=False)
    kept = s[:components] > s.max(initial=0) * max(whole.factor.shape) * 8 * np.finfo(float).eps
    values = s**2 / whole.n
    return Model(whole.n, whole.sums, v[:components][kept], values[:components][kept], float(values.sum()))


def identity_error(distinct: DataFrame, model: Model) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(model.values)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                w = model.whiten(vectors.dense(batch.slice(a, _ROWS).column("x")))
                total += np.vstack([w.T @ w, w.sum(axis=0)])
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "value"])

    got = distinct.mapInArrow(moments, "i long, j long, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).toPandas()  # components + 1 squared
    total = got.pivot(index="i", columns="j", values="value").to_numpy() / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whiten(table: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each usable vector and component: id, component, n, deviation, whitened, explained and identity_error."""
    spark = table.sparkSession
    common.ship(spark)
    rows = integer_vectors(table, id_col, vector_col)
    distinct, path = common.materialize(rows.select("x").distinct(), "whitening-fit")
    model = fit(distinct, components)
    kind = table.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    error, k = identity_error(distinct, model), len(model.values)
    common.discard(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                part = batch.slice(a, _ROWS)
                x, m = vectors.dense(part.column("x")), part.num_rows
                again = np.repeat(np.arange(m), k)
                columns = [
                    part.column("id").take(pa.array(again)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)), pa.array(model.deviation(x), pa.int64()).take(pa.array(again)),
                    pa.array(model.whiten(x).ravel()), pa.array(np.tile(model.values / model.total, m)), pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
