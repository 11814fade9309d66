"""Prefix trie, whitening and top-k against brute force, and the cases that their docstrings define."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraline.llm import prefixtrie, topk, whitening

# ------------------------------------------------------------------------------------------------ prefix trie

TURNS = "conv_id long, turn long, role string, text string"


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    built = {c: own.get(c - c % 20, [])[: zlib.crc32(str(c).encode()) % 4] + v[zlib.crc32(str(c).encode()) % 4 :] for c, v in own.items()}
    nodes = defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            nodes[tuple(v[:d])].append(c)
    children, leaves, saved = Counter(k[:-1] for k in nodes if k), Counter(), Counter()
    for k, m in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(m) - 1) * words
    ends = {k: ",".join(str(c) for c in sorted(m) if len(built[c]) == len(k)) for k, m in nodes.items()}
    return sorted((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends[k].encode()).hexdigest()) for k, m in nodes.items())


def run_trie(spark, rows):
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit(1) for c in ("pos", "a", "b", "x", "y", "px", "depth", "owner", "part", "block", "words", "n_turns", "ends", "base")})
    got = prefixtrie.trie(*prefixtrie.rebuilt(*prefixtrie.ordered_turns(df)))
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    return sorted(tuple(r) for r in got.collect())


def test_trie_of_random_conversations(spark):
    rng = np.random.default_rng(3)
    rows = [(c, t, ["user", "assistant"][t % 2], f"w{rng.integers(0, 3)}  x\t" * int(rng.integers(1, 3))) for c in rng.choice(400, 150, replace=False).tolist() for t in range(int(rng.integers(1, 7)))]
    rows += [(1000 + c, t, "user", "the same") for c in range(60) for t in range(5)]  # copies
    assert run_trie(spark, rows) == brute_trie(rows)


def test_trie_of_hard_rows(spark):
    rows = [
        (None, 1, "user", "nobody's"), (1, None, "user", "null first"), (1, 2, None, None), (1, 0, "", ""), (1, 0, "", ""), (1, 0, "a", "tie"), (1, 0, "a", "earlier"),
        (20, 5, "user", "word " * 300_000), (21, 5, "user", "word " * 300_000), (21, 6, "user", "x" * 500_000), (40, 0, "user", "one"), (45, 0, "user", "only turn"),
        (-7, 1, "user", "negative"), (-20, 1, "user", "base of a negative one"), (60, 1, "ab", "c"), (61, 1, "a", "bc"), (80, 0, "u", "a"), (80, 1, "u", "b"), (2**62, 0, "u", "日本 語 x"),
    ]
    rows += [(c, t, "u", f"{t}") for c in (100, 101, 102, 103, 104) for t in range(c - 96)]  # each is the start of the next
    assert run_trie(spark, rows) == brute_trie(rows)


def test_trie_of_long_conversations_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "BLOCK", 7)
    monkeypatch.setattr(prefixtrie, "PIECE", 16)
    rows = [(c, t, "u", "a b" if t < 40 or c % 2 else f"{c} {t // 9}") for c in range(0, 12) for t in range(10 * c)]
    rows += [(c, 0, "u", "z") for c in range(500, 540)]  # end lists of several pieces
    assert run_trie(spark, rows) == brute_trie(rows)


def test_trie_of_an_empty_table(spark):
    assert run_trie(spark, []) == []


def test_trie_without_python_state_beyond_a_piece():
    import pyarrow as pa

    n = 50_000
    batch = pa.RecordBatch.from_arrays([pa.array([1] * n), pa.array([2] * n), pa.array([3] * n), pa.array(range(n))], names=["depth", "x", "y", "conv_id"])
    pieces = list(prefixtrie.joined_pieces(iter([batch])))
    assert max(len(p) for b in pieces for p in b.column("piece").to_pylist()) < prefixtrie.PIECE + 20
    (out,) = prefixtrie.hashed_pieces(iter(pieces))
    assert out.column("ends_sha256").to_pylist() == [hashlib.sha256(",".join(map(str, range(n))).encode()).hexdigest()]


# ------------------------------------------------------------------------------------------------ whitening

VECTORS = "vec_id long, embedding array<float>"


def frame(spark, rows):
    return spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit(1) for c in ("id", "x", "v", "n", "no", "part", "component", "score", "rank", "sums", "factor")})


def brute_whitening(rows, components=16):
    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max(len(v) for _, v in rows)
    x = np.floor(np.array([list(np.float32(v).astype(float)) + [0.0] * (width - len(v)) for _, v in rows]) * 64).astype(np.int64) + 1_000_000
    once = np.unique(x, axis=0)
    n, sums = len(once), once.sum(axis=0)
    c = (n * once - sums) / n
    values, directions = np.linalg.eigh(c.T @ c / n)
    values, directions = values[::-1][:components], directions[:, ::-1][:, :components]
    return [i for i, _ in rows], n, ((n * x - sums).astype(object) ** 2).sum(axis=1), ((n * x - sums) / n) @ directions / np.sqrt(values), values / (c**2).sum() * n


@pytest.mark.parametrize("parts", [1, 23])
def test_whitening(spark, parts):
    rng = np.random.default_rng(parts)
    mixing = rng.normal(size=(20, 20))
    rows = [(i, (rng.normal(size=20) @ mixing + 5).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # one vector many times
    rows += [(2000, None), (2001, [1.0] * 19 + [None]), (2002, [float("nan")] * 20), (2003, [float("inf")] + [0.0] * 19), (2004, [1.0, 2.0]), (2005, [])]
    got = whitening.whiten(frame(spark, rows).repartition(parts)).toPandas()
    ids, n, deviation, white, explained = brute_whitening(rows)
    assert sorted(set(got["vec_id"])) == sorted(ids) and len(got) == 16 * len(ids)
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    assert np.abs(wide * np.sign((wide * white).sum(axis=0)) - white).max() < 1e-8
    assert set(got["n"]) == {n} and got["identity_error"].max() < 1e-9 and got["identity_error"].nunique() == 1
    assert got[got["component"] == 1].set_index("vec_id")["deviation"].loc[ids].tolist() == deviation.tolist()
    assert np.allclose(got.groupby("component")["explained"].first(), explained, rtol=1e-9)


def test_merging_is_lossless():
    rng = np.random.default_rng(0)
    x = rng.integers(999_000, 1_001_000, (700, 9))
    found = None
    for a in range(0, 700, 13):  # parts smaller than the dimension, too
        found = whitening.merged(found, whitening.summarised(x[a : a + 13]))
    c = x - x.mean(axis=0)
    assert found.n == 700 and found.sums.tolist() == x.sum(axis=0).tolist()
    assert np.allclose(found.factor.T @ found.factor, c.T @ c, rtol=1e-11)


def test_deviation_of_many_and_of_large_entries():
    sums, n = np.array([10**6 * 10**9 + 7, 10**6 * 10**9 + 3], object), 10**9
    model = whitening.Model(n, sums, np.eye(2), np.ones(2), 2.0)
    assert model.deviation(np.array([[10**6, 10**6 + 1], [10**6 + 4, 10**6]])) == [49 + (n - 3) ** 2, None]
    assert whitening.Model(1, np.array([0, 0], object), np.eye(2), np.ones(2), 2.0).deviation(np.array([[2**62, 0], [3, 4]])) == [None, 25]


def test_whitening_of_few_and_no_vectors(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, [float("nan")])])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no variance
    line = whitening.whiten(frame(spark, [(None, [0.0, 0.0]), (2, [1.0, 1.0]), (2, [2.0, 2.0]), (2, [2.0, 2.0])])).toPandas()
    assert len(line) == 4 and set(line["component"]) == {1} and set(line["n"]) == {3} and np.allclose(sorted(np.abs(line["whitened"])), [0, 1.5**0.5, 1.5**0.5, 1.5**0.5])
    assert whitening.whiten(frame(spark, [(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [5.0, 2.0])])).count() > 0


# ------------------------------------------------------------------------------------------------ top-k


def brute_top(rows, k=10, scale=1024):
    rows = [(i, [int(np.floor(np.float64(np.float32(c)) * scale)) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for i, v in sorted({(i, tuple(v)) for i, v in rows if i is not None and i % 100 == 0}):
        scores = [(-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), j is None, j) for j, w in rows if j != i]  # noqa: B905  the shorter one ends in zeros
        out += [(i, r + 1, j, -s) for r, (s, _, j) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out)


def run_top(spark, rows, parts=5, **how):
    return sorted(tuple(r) for r in topk.top_k(frame(spark, rows).repartition(parts), F.col("id") % 100 == 0, **how).collect())


@pytest.mark.parametrize("how", [{}, {"pass_bytes": 4000, "seed_rows": 50}])
def test_top_k(spark, how):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 40))
    rows = [(i, (centres[i % 5] + 0.2 * rng.normal(size=40)).astype(np.float32).tolist()) for i in range(1500)]
    rows += [(5000 + i, rows[300][1]) for i in range(400)]  # ties of one vector
    assert run_top(spark, rows, **how) == brute_top(rows)


def test_top_k_of_hard_rows(spark):
    rows = [
        (0, [1.0, -2.0, 3.0]), (0, [1.0, -2.0, 3.0]), (100, [0.5]), (100, [0.25, 1.0]), (200, []), (300, None), (400, [float("nan")]), (500, [None]), (600, [float("inf")]), (700, [1e30, 1.0]),
        (1, [2.0, 2.0, 2.0]), (1, [2.0, 2.0, 2.0]), (None, [2.0, 2.0, 2.0]), (2, [1e25, 0.0]), (3, [0.0] * 40), (4, [-1e36, 5.0, 1.0]), (-100, [3e7, 3e7, 3e7]), (5, [3e7, 3e7, 2.9e7]),
    ]
    got, want = run_top(spark, rows), brute_top(rows)
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_top_k_of_few_and_no_rows(spark):
    assert run_top(spark, []) == []
    assert run_top(spark, [(100, [1.0])]) == []
    assert run_top(spark, [(101, [1.0])]) == []
    assert run_top(spark, [(100, [1.0]), (1, [0.5])]) == [(100, 1, 1, 1024 * 512)]


def test_bounds_drop_no_pair():
    rng = np.random.default_rng(2)
    q, v = np.floor(rng.normal(size=(30, 50)) * 100), np.floor(rng.normal(size=(50, 600)) * 100)
    exact = q @ v
    floor = np.sort(exact, axis=1)[:, -10]
    row, col, score = topk.bounded_pairs(q, v, topk.left_over(q.T.copy()), topk.left_over(v), floor, (np.zeros(0, int), np.zeros(0, int)), 10)
    assert len(row) >= 300 and np.array_equal(score, exact[row, col])
    assert set(zip(*np.nonzero(exact >= floor[:, None]), strict=True)) <= set(zip(row, col, strict=True))
