"""Extra trees against a plain numpy version with the same draws; the search, its pruner and its trials at rest."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraline.operators import learning, search, trees


def plain_tree(x, y, seed, t, depth, leaf, split, most):
    """One tree, grown recursively: path -> (value, feature, threshold)."""
    out = {}

    def grow(rows, path, level):
        n, s, ss = len(rows), y[rows].sum(), (y[rows] ** 2).sum()
        out[path] = [s / n, None, None]
        if level == depth or n < split or n < 2 * leaf or ss - s * s / n <= 1e-12 * max(1.0, ss):
            return
        rng = np.random.default_rng([seed, t, path])
        order, where = rng.permutation(x.shape[1]), rng.random(x.shape[1])
        best = (0.0, None, None)
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        for f in [f for f in order.tolist() if low[f] < high[f]][: trees.how_many(most, x.shape[1])]:
            cut = low[f] + where[f] * (high[f] - low[f])
            left = x[rows, f] <= cut
            nl, sl = left.sum(), y[rows][left].sum()
            if leaf <= nl <= n - leaf and (gain := sl * sl / nl + (s - sl) ** 2 / (n - nl) - s * s / n) > best[0]:
                best = (gain, f, cut)
        if best[1] is not None:
            out[path][1:] = best[1:]
            left = x[rows, best[1]] <= best[2]
            grow(rows[left], 2 * path, level + 1)
            grow(rows[~left], 2 * path + 1, level + 1)

    grow(np.arange(len(x)), 1, 0)
    return out


@pytest.mark.parametrize(("depth", "leaf", "split", "most", "cells"), [(None, 1, 2, None, 1 << 19), (4, 3, 10, "sqrt", 30), (3, 1, 2, 0.5, 1 << 19)])
def test_extra_trees(spark, monkeypatch, depth, leaf, split, most, cells):
    monkeypatch.setattr(trees, "CELLS", cells)
    rng = np.random.default_rng(1)
    x = rng.integers(0, 12, (160, 5)).astype(float)
    x[:, 4] = 3  # never varies
    y = np.round(x[:, 0] * 4 + (x[:, 1] > 5) * 16 + rng.integers(0, 3, 160))
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)] + [(None, 1.0, 1.0, 1.0, 1.0, 5.0), (1.0, 1.0, 1.0, 1.0, 1.0, None)], ", ".join(f"{c} double" for c in "abcde") + ", y double").repartition(3)
    run = learning.Run("extra_trees", {"numTrees": 3, "maxDepth": depth, "minInstancesPerNode": leaf, "minInstancesToSplit": split, "maxFeatures": most})
    fitted = learning.fit(df, list("abcde"), "y", run)
    want = [plain_tree(x, y, 42, t, 30 if depth is None else depth, leaf, split, most) for t in range(3)]
    for t, w in zip(fitted[1].trees, want, strict=True):
        got = {p: [v, f if c else None, cut if c else None] for p, f, cut, c, v in zip(t.path, t.feature, t.threshold, t.child, t.value, strict=True)}
        assert got == w and len(got) > 5

    def ends(row, w):
        path = 1
        while w[path][1] is not None:
            path = 2 * path + int(row[w[path][1]] > w[path][2])
        return w[path][0]

    out = {tuple(r[c] for c in "abcde"): r["prediction"] for r in learning.predict(fitted, df.where("a is not null")).collect()}
    assert all(out[tuple(r)] == pytest.approx(np.mean([ends(r, w) for w in want])) for r in x.tolist())
    weights = dict(learning.importances(fitted, list("abcde")))
    assert sum(weights.values()) == pytest.approx(1) and max(weights, key=weights.get) == "a" and weights["e"] == 0


def test_extra_trees_of_few_rows_and_at_rest(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, y double")
    assert learning.predict(learning.fit(df, ["a", "b"], "y", learning.Run("extra_trees", {"numTrees": 2})), df).first()["prediction"] == 3.0
    nothing = learning.fit(df.limit(0), ["a", "b"], "y", learning.Run("extra_trees", {"numTrees": 2}))
    assert learning.predict(nothing, df).first()["prediction"] is None
    many = spark.range(60).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"), F.col("id").cast("double").alias("y"))
    fitted = learning.fit(many, ["a", "b"], "y", learning.Run("extra_trees", {"numTrees": 3, "maxDepth": 3}))
    learning.save_bundle(fitted, spark.createDataFrame([(0, 0.5, 0.6)], "trial int, holdout_r2 double, cv_r2 double"), str(tmp_path / "m"))
    again = trees.ExtraTreesModel.load(spark, str(tmp_path / "m" / "model"))
    rows = lambda model: [r["prediction"] for r in learning.predict((fitted[0], model), many).orderBy("y").collect()]
    assert rows(again) == rows(fitted[1])


# ------------------------------------------------------------------------------------------------ search


def trial(i, state, folds, holdout=None, **params):
    return search.Trial(i, "extra_trees", params, state, folds, float(np.mean(folds)), 0.0, 1.0, 1.0, holdout)


def test_median_pruner():
    past = [trial(i, "COMPLETE", [v, v, v]) for i, v in enumerate((0.2, 0.4, 0.6))] + [trial(9, "PRUNED", [0.9, 0.9])]
    assert search.should_prune([0.1, 0.2], past, 3) and not search.should_prune([0.1], past, 3)  # two folds first
    assert not search.should_prune([0.1, 0.2], past, 4)  # too few complete ones
    assert not search.should_prune([0.9, 0.0], past, 3)  # the best running mean counts
    assert not search.should_prune([0.4, 0.4], past, 3)


def test_sampler_learns_and_repeats():
    def score(p):
        return 1 - abs(p["numTrees"] - 50) / 50 - abs(p["maxDepth"] - 4) / 10 + (p["maxFeatures"] == "log2") * 0.5

    past = []
    for i in range(60):
        p = search.suggest("extra_trees", past, i, 7)
        assert p == search.suggest("extra_trees", list(past), i, 7)
        assert all(p[c] in r if isinstance(r, list) else r[0] <= p[c] <= r[1] for c, r in search.SPACE["extra_trees"].items())
        past.append(trial(i, "COMPLETE", [score(p)], score(p), **p))
    even = [score(search.suggest("extra_trees", [], i, 7)) for i in range(60)]
    assert np.mean([t.cv_r2 for t in past[30:]]) > np.mean(even) + 0.3
    random_one = search.suggest("extra_trees", past, 60, 7, search.Sampler("random"))
    assert random_one == search.suggest("extra_trees", [], 60, 7)


def test_stop_rules():
    done = [trial(i, "COMPLETE", [0.1], h) for i, h in enumerate((0.5, 0.6, 0.4, 0.6))] + [trial(4, "PRUNED", [0.0])]
    assert search.out_of_patience(done, 2) and not search.out_of_patience(done, 3)  # equal isn't better, pruned ones don't count
    assert not search.out_of_patience([], 1)


def test_search_goes_on_where_it_was(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(int(i % 12), float(a), float(b), float(3 * a + b)) for i, (a, b) in enumerate(rng.random((240, 2)))], "g int, a double, b double, y double")
    monkeypatch.setitem(search.SPACE, "extra_trees", {"numTrees": (1, 2), "maxDepth": (1, 2), "maxFeatures": ["sqrt", 0.5]})
    fits = []
    real = learning.fit
    monkeypatch.setattr(learning, "fit", lambda *a: fits.append(1) or real(*a))
    how = {"model": "extra_trees", "limits": learning.SearchLimits(target_r2=2.0, max_trials=3, patience=9), "sampler": search.Sampler(startup=3, candidates=4), "folds": 3}
    whole = search.search(df, ["a", "b"], "y", "g", str(tmp_path / "one"), **how)
    search.search(df, ["a", "b"], "y", "g", str(tmp_path / "two"), trials=2, **how)  # interrupted
    parts = search.search(df, ["a", "b"], "y", "g", str(tmp_path / "two"), **how)
    assert [t.params for t in parts] == [t.params for t in whole] and [t.state for t in parts] == [t.state for t in whole] and len(parts) == 3
    assert np.allclose([t.cv_r2 for t in parts], [t.cv_r2 for t in whole])
    before = len(fits)
    assert search.search(df, ["a", "b"], "y", "g", str(tmp_path / "two"), **how) == parts and len(fits) == before  # nothing is left to do
    monkeypatch.setattr(search, "should_prune", lambda folds, past, startup: len(folds) == 2)
    more = search.search(df, ["a", "b"], "y", "g", str(tmp_path / "two"), **(how | {"limits": learning.SearchLimits(target_r2=2.0, max_trials=4, patience=9)}))
    assert more[-1].state == "PRUNED" and len(more[-1].fold_r2) == 2 and more[-1].holdout_r2 is None and len(fits) == before + 2
    complete, pruned = search.histories(search.read_trials(spark, str(tmp_path / "two")))
    assert len(complete) == 3 and [t.trial for t in pruned] == [3]
    board = [r["trial"] for r in search.leaderboard(spark, str(tmp_path / "two")).collect()]
    assert board[0] == search.chosen(more).trial and len(board) == 3 and not math.isnan(search.chosen(more).gap)
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_feasible_trials_end_the_search(spark, tmp_path, monkeypatch):
    df = spark.range(120).select((F.col("id") % 10).alias("g"), (F.col("id") % 8).cast("double").alias("a"), ((F.col("id") % 8) * 2).cast("double").alias("y"))
    monkeypatch.setitem(search.SPACE, "extra_trees", {"numTrees": (3, 3), "maxDepth": (8, 8)})
    got = search.search(df, ["a"], "y", "g", str(tmp_path / "t"), "extra_trees", folds=2)
    assert len(got) == 1 and got[0].feasible and search.chosen(got).trial == 0


def test_folds_without_a_global_window(spark):
    df = spark.range(4000).select((F.col("id") % 97 + (F.col("id") % 5) * 3).alias("g"), F.col("id").alias("i"))
    dealt = learning.group_folds(df, "g", 4)
    assert "SinglePartition" not in dealt._jdf.queryExecution().executedPlan().toString()
    pdf = dealt.toPandas()
    sizes = pdf.groupby("g").size()
    order = sorted(sizes.index, key=lambda g: (-sizes[g], g))
    want = {g: (i % 8 if i % 8 < 4 else 7 - i % 8) for i, g in enumerate(order)}
    assert len(pdf) == 4000 and (pdf["g"].map(want) == pdf["fold"]).all()
