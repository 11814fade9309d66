"""Extremely randomised trees, grown a level at a time for all trees at once.

Every tree sees all rows. An open node draws an order of the features and, for the first `max_features` of them that vary in the
node, one threshold each, uniform between the least and the greatest value there; the split that leaves the least squared error is
taken. Rows of equal features can't be told apart, so they are added up first (count, sum and sum of squares of the label). A level
is two passes over these sums, which stay where they lie: one gathers each open node's count, sums and ranges, one the
count and sum left of each drawn threshold. Tasks send their partial sums, Spark adds them up, and the driver sees what the model
consists of: a row for each open node and feature, at most CELLS at a time. Draws depend on seed, tree and node only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array  # noqa: F401
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraline import scratch

CELLS = 1 << 19  # (open node, feature) pairs of a pass
_BATCH = 1 << 15


@dataclass
class Tree:
    """Nodes in arrays; a split's children are `child` and the one after it, a leaf's child is 0. `path` numbers nodes as in a heap."""

    path: list[int]
    feature: list[int]
    threshold: list[float]
    child: list[int]
    value: list[float]
    n: list[int]
    gain: list[float]

    @classmethod
    def root(cls) -> Tree:
        return cls([1], [0], [0.0], [0], [0.0], [0], [0.0])

    def grow(self, node: int, feature: int, threshold: float, gain: float) -> list[int]:
        self.feature[node], self.threshold[node], self.child[node], self.gain[node] = feature, threshold, len(self.path), gain
        for side in (0, 1):
            for column, v in zip(self.columns(), (2 * self.path[node] + side, 0, 0.0, 0, 0.0, 0, 0.0), strict=True):
                column.append(v)
        return [len(self.path) - 2, len(self.path) - 1]

    def columns(self) -> list[list]:
        return [self.path, self.feature, self.threshold, self.child, self.value, self.n, self.gain]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The node in which each row ends."""
        feature, threshold, child = np.array(self.feature), np.array(self.threshold), np.array(self.child)
        node, inside = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(inside):
            inside = inside[child[node[inside]] > 0]
            at = node[inside]
            node[inside] = child[at] + (x[inside, feature[at]] > threshold[at])
        return node


def draws(seed: int, tree: int, path: int, features: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the features in a node, and where between least and greatest each is cut."""
    rng = np.random.default_rng([seed, tree, path])
    return rng.permutation(features), rng.random(features)


def how_many(max_features: str | float | int | None, features: int) -> int:
    if max_features in (None, "none", "all"):
        return features
    if max_features in ("sqrt", "log2"):
        return max(1, int(getattr(math, max_features)(features)))
    return max(1, int(max_features * features) if isinstance(max_features, float) else int(max_features))


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def node_sums(x: np.ndarray, n: np.ndarray, s: np.ndarray, ss: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, ...]:
    """By slot (a row's node, -1: none): which occur, count, sum, sum of squares, least and greatest of each feature."""
    order = np.argsort(node, kind="stable")
    order = order[np.searchsorted(node[order], 0) :]
    slot, starts = np.unique(node[order], return_index=True)
    if not len(slot):
        return slot, *(np.zeros(0),) * 3, *(np.zeros((0, x.shape[1])),) * 2
    over = lambda f, v: f.reduceat(v[order], starts, axis=0)
    return slot, over(np.add, n), over(np.add, s), over(np.add, ss), over(np.minimum, x), over(np.maximum, x)


def gathered(rows: DataFrame, each, names: str, by: list[str], aggregates: list[Column]) -> list:
    """each(x, n, s, ss) -> columns, over all batches; the sums over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, _BATCH):
                part = batch.slice(a, _BATCH)
                columns = each(matrix(part), *(part.column(c).to_numpy(zero_copy_only=False) for c in ("n", "s", "ss")))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[n.split()[0] for n in names.split(", ")])

    return rows.mapInArrow(run, names).groupBy(*by).agg(*aggregates).collect()


class ExtraTrees:
    """An estimator like Spark ML's tree regressors. maxDepth None grows until nodes are pure or too small (30 levels at most).
    Rows with a null or NaN feature or label are not learnt from."""

    def __init__(self, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction", seed: int = 42, numTrees: int = 100, maxDepth: int | None = None, minInstancesPerNode: int = 1, minInstancesToSplit: int = 2, maxFeatures: str | float | int | None = None) -> None:  # noqa: N803
        self.features, self.label, self.prediction, self.seed, self.trees = featuresCol, labelCol, predictionCol, seed, numTrees
        self.depth, self.leaf, self.split, self.most = 30 if maxDepth is None else min(maxDepth, 30), max(1, minInstancesPerNode), max(2, minInstancesToSplit), maxFeatures

    def fit(self, df: DataFrame) -> ExtraTreesModel:
        rows = df.select(vector_to_array(self.features).alias("x"), F.col(self.label).cast("double").alias("y")).where("y is not null and not isnan(y) and not exists(x, v -> isnan(v))")
        rows = scratch.at_rest(rows.groupBy("x").agg(F.count("*").alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("ss")), "extra-trees")
        scratch.send_code(df.sparkSession)
        one = rows.select(F.size("x").alias("n")).first()
        trees = [Tree.root() for _ in range(self.trees)]
        if one is None:
            return ExtraTreesModel(trees, 0, self.features, self.prediction)
        width = one["n"]
        opened = [(t, 0) for t in range(self.trees)]
        for level in range(self.depth + 1):
            following = []
            for a in range(0, len(opened), max(1, CELLS // width)):
                following += self.level(rows, trees, opened[a : a + max(1, CELLS // width)], width, level == self.depth)
            opened = following
            if not opened:
                break
        return ExtraTreesModel(trees, width, self.features, self.prediction)

    def level(self, rows: DataFrame, trees: list[Tree], opened: list[tuple[int, int]], width: int, last: bool) -> list[tuple[int, int]]:
        """Values of the open nodes, their splits, and the nodes that those open."""
        spark = rows.sparkSession
        mine: dict[int, list[int]] = {}
        for i, (t, _) in enumerate(opened):
            mine.setdefault(t, []).append(i)
        sent = spark.sparkContext.broadcast(([(t, trees[t], mine[t]) for t in sorted(mine)], [v for _, v in opened]))  # the part of the model that is growing

        def slots(x: np.ndarray):
            for _, tree, own in sent.value[0]:
                at = np.full(len(tree.path), -1)
                at[[sent.value[1][i] for i in own]] = own
                yield at[tree.leaves(x)]

        def ranges(x: np.ndarray, rows: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> list[np.ndarray]:
            found = [node_sums(x, rows, sums, squares, slot) for slot in slots(x)]
            slot, n, s, ss, low, high = (np.concatenate(c) for c in zip(*found, strict=True))
            wide = lambda c: np.repeat(c, x.shape[1])
            return [wide(slot.astype(np.int64)), np.tile(np.arange(x.shape[1]), len(slot)), wide(n.astype(np.int64)), wide(s.astype(float)), wide(ss.astype(float)), low.ravel(), high.ravel()]

        table = {}
        for r in gathered(rows, ranges, "slot long, feature long, n long, s double, ss double, low double, high double", ["slot", "feature"], [F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.min("low").alias("low"), F.max("high").alias("high")]):
            table.setdefault(r["slot"], {})[r["feature"]] = r
        cuts: dict[int, list[tuple[int, float]]] = {}
        k = how_many(self.most, width)
        for i, (t, v) in enumerate(opened):
            own = table[i]
            n, s, ss = (own[0][c] for c in ("n", "s", "ss"))
            trees[t].value[v], trees[t].n[v] = s / n, n
            if last or n < self.split or n < 2 * self.leaf or ss - s * s / n <= 1e-12 * max(1.0, ss):
                continue
            order, where = draws(self.seed, t, trees[t].path[v], width)
            vary = [f for f in order.tolist() if own[f]["low"] < own[f]["high"]][:k]
            at = [(f, own[f]["low"] + float(where[f]) * (own[f]["high"] - own[f]["low"])) for f in vary]
            if at:
                cuts[i] = [(f, c if c < own[f]["high"] else own[f]["low"]) for f, c in at]
        if not cuts:
            sent.destroy()
            return []
        feature, threshold = np.full((len(opened), k), -1), np.zeros((len(opened), k))
        for i, c in cuts.items():
            feature[i, : len(c)], threshold[i, : len(c)] = zip(*c, strict=True)
        drawn = spark.sparkContext.broadcast((feature, threshold))

        def lefts(x: np.ndarray, rows: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> list[np.ndarray]:
            feature, threshold = drawn.value
            n, s = np.zeros(feature.shape, np.int64), np.zeros(feature.shape)
            for slot in slots(x):
                row = np.flatnonzero(slot >= 0)
                at = slot[row]
                for j in range(feature.shape[1]):
                    left = (feature[at, j] >= 0) & (x[row, feature[at, j]] <= threshold[at, j])
                    n[:, j] += np.bincount(at[left], rows[row[left]], len(n)).astype(np.int64)  # whole numbers, exact below 2**53
                    s[:, j] += np.bincount(at[left], sums[row[left]], len(n))
            at = np.nonzero(n)
            return [*(c.astype(np.int64) for c in at), n[at], s[at]]

        below = {(r["slot"], r["cut"]): (r["n"], r["s"]) for r in gathered(rows, lefts, "slot long, cut long, n long, s double", ["slot", "cut"], [F.sum("n").alias("n"), F.sum("s").alias("s")])}
        opens = []
        for i, c in cuts.items():
            t, v = opened[i]
            n, s = table[i][0]["n"], table[i][0]["s"]
            gains = []
            for j in range(len(c)):
                nl, sl = below.get((i, j), (0, 0.0))
                gains.append(sl * sl / nl + (s - sl) ** 2 / (n - nl) - s * s / n if self.leaf <= nl <= n - self.leaf else -1.0)
            best = max(range(len(c)), key=gains.__getitem__)
            if gains[best] > 0:
                opens += [(t, w) for w in trees[t].grow(v, *c[best], gains[best])]
        sent.destroy()
        drawn.destroy()
        return opens


class ExtraTreesModel:
    def __init__(self, trees: list[Tree], width: int, features: str, prediction: str) -> None:
        self.trees, self.width, self.features, self.prediction = trees, width, features, prediction

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802
        """The share of each feature in a tree's gain, averaged over the trees."""
        total = np.zeros(self.width)
        for t in self.trees:
            own = np.zeros(self.width)
            np.add.at(own, np.array(t.feature), np.array(t.gain))
            total += own / (own.sum() or 1.0)
        return DenseVector(total / (total.sum() or 1.0))

    def transform(self, df: DataFrame) -> DataFrame:
        """df with the mean of the trees' values; null where a feature is NaN or nothing was learnt."""
        sent = df.sparkSession.sparkContext.broadcast([(t, np.array(t.value)) for t in self.trees])
        learnt = bool(self.width)

        @F.pandas_udf("double")
        def mean(x):
            import pandas as pd

            if not learnt or not len(x):
                return pd.Series([None] * len(x), dtype="float64")
            m = np.vstack(x.to_numpy())
            total = sum(value[t.leaves(m)] for t, value in sent.value) / len(sent.value)
            return pd.Series(np.where(np.isnan(m).any(axis=1), np.nan, total)).astype("Float64").mask(np.isnan(m).any(axis=1))

        return df.withColumn(self.prediction, mean(vector_to_array(self.features)))

    def write(self) -> ExtraTreesModel:
        return self

    def overwrite(self) -> ExtraTreesModel:
        return self

    def save(self, path: str) -> None:
        """A row a node."""
        spark = SparkSession.getActiveSession()
        rows = [(i, self.width, j, *node) for i, t in enumerate(self.trees) for j, node in enumerate(zip(*t.columns(), strict=True))]
        spark.createDataFrame(rows, "tree int, width int, node long, path long, feature int, threshold double, child long, value double, n long, gain double").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, features: str = "__features", prediction: str = "prediction") -> ExtraTreesModel:
        trees: dict[int, list] = {}
        width = 0
        for r in spark.read.parquet(path).orderBy("tree", "node").collect():  # the model
            width = r["width"]
            trees.setdefault(r["tree"], []).append(r[3:])
        return cls([Tree(*(list(c) for c in zip(*t, strict=True))) for t in trees.values()], width, features, prediction)
