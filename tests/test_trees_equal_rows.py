"""Extra trees: rows of equal features are added up before the trees grow, and the trees are those of the rows."""

import numpy as np
from pyspark.ml.feature import VectorAssembler

from terraline.operators import trees


def test_levels_read_a_row_for_each_different_features(spark, monkeypatch):
    rng = np.random.default_rng(8)
    a, b = rng.integers(0, 5, 2000).astype(float), rng.integers(0, 3, 2000).astype(float)
    y = rng.integers(0, 100, 2000) + 10 * a  # whole numbers: sums are exact in any order
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame([tuple(map(float, r)) for r in zip(a, b, y, strict=True)], "a double, b double, label double"))
    read, real = [], trees.gathered
    monkeypatch.setattr(trees, "gathered", lambda rows, *rest: read.append(rows.count()) or real(rows, *rest))
    model = trees.ExtraTrees(numTrees=2, maxDepth=3).fit(df)
    assert set(read) == {15}
    for t in model.trees:
        node = np.zeros(2000, int)
        x = np.column_stack([a, b])
        while any(t.child[v] for v in node):  # down a step at a time, each node against its own rows
            node = np.array([t.child[v] + (x[i, t.feature[v]] > t.threshold[v]) if t.child[v] else v for i, v in enumerate(node)])
        assert (node == t.leaves(x)).all() and t.n[0] == 2000 and t.value[0] == y.sum() / 2000
        for v in set(node.tolist()):
            assert t.n[v] == (node == v).sum() and t.value[v] == y[node == v].sum() / t.n[v]
