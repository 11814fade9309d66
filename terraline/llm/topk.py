"""Exact top-k by integer inner product: columnar branch-and-bound over a stated set of queries.

Components become integers, floor(1024 * x). A task reads its candidates in blocks of a vertical layout (a row a dimension) and
adds up the scores of a chunk of queries dimension block by dimension block. After each block, what a pair can still gain is at
most the product of the lengths that query and candidate have left (Cauchy-Schwarz); a pair that can't reach the query's
threshold goes, and candidates that no query of the chunk needs are compacted away; once few pairs survive, only those are
carried on. A threshold is the k-th best score seen, at first that of a seed: SEED_ROWS candidates, which can only leave it too
low, never too high. So every result is exact.

Queries are broadcast in passes of PASS_BYTES, as many as there are queries for; each pass scans the candidates where they lie,
without moving them, and gives k rows a query and task at most, which one window ranks.

Defined cases. Vectors that are null or hold null or non-finite components take no part. Vectors of unlike lengths are compared
as if the shorter one ended in zeros. A candidate is every row whose id is not the query's; rows without an id are candidates,
come after others of their score, and are never queries. Repeated rows are candidates each, and one query; an id with unlike
vectors is a query for each of them. Ties go to the smaller id. Scores beyond a long are the nearest long. Fewer than k
candidates: all. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraline.llm import common, vectors

SCALE, PASS_BYTES, SEED_ROWS = 1024, 16 << 20, 4096
_DIMS, _ROWS, _CHUNK, _FEW = 16, 8192, 64, 1 / 8  # dimensions a block, candidates a block, queries a chunk, share of pairs that are carried on one by one
_LOW, _HIGH = -(2**63), 2**63 - 1


def quantised(m: np.ndarray) -> np.ndarray:
    """floor(1024 * x), as whole doubles; beyond a double's range, its largest."""
    most = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        return np.floor(np.clip(m.astype(np.float64) * SCALE, -most, most))


def left_over(m: np.ndarray) -> np.ndarray:
    """Row b: the lengths of the columns of m (a row a dimension) below dimension block b, rounded up."""
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(m * m, np.arange(0, len(m), _DIMS)) if len(m) else np.zeros((0, m.shape[1]))
    after = np.cumsum(sums[::-1], axis=0)[::-1]
    return np.sqrt(np.vstack([after, np.zeros((1, m.shape[1]))])) * (1 + 1e-9)


class Best:
    """The k best candidates of each query so far, and the score that another one has to reach."""

    def __init__(self, queries: int, k: int, floor: np.ndarray) -> None:
        self.k, self.floor = k, floor.copy()
        self.query, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.null = np.zeros(0, bool)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        if not len(query):
            return
        query, score, ids, null = np.r_[self.query, query], np.r_[self.score, score], np.r_[self.id, ids], np.r_[self.null, null]
        order = np.lexsort((ids, null, ~score, query))  # ~score falls as score rises, without overflow
        query = query[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        order, kth = order[place < self.k], order[place == self.k - 1]
        self.floor[query[place == self.k - 1]] = np.maximum(self.floor[query[place == self.k - 1]], score[kth])
        self.query, self.score, self.id, self.null = query[place < self.k], score[order], ids[order], null[order]


def bounded_pairs(q: np.ndarray, v: np.ndarray, q_left: np.ndarray, v_left: np.ndarray, floor: np.ndarray, own: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (query, candidate, score) that reach the floor. q: a row a query; v: a row a dimension; own: pairs that don't count."""
    d, (n, m) = len(v), (len(q), v.shape[1])
    columns, scores, alive = np.arange(m), np.zeros((n, m)), np.ones((n, m), bool)
    alive[own] = False
    for b, a in enumerate(range(0, d, _DIMS)):
        z = min(a + _DIMS, d)
        scores += q[:, a:z] @ v[a:z]
        alive &= scores + q_left[b + 1][:, None] * v_left[b + 1] + 0.5 >= floor[:, None]
        if np.count_nonzero(alive) <= _FEW * alive.size:
            row, col = np.nonzero(alive)
            return carry_on(q, v, q_left, v_left, floor, row, col, scores[row, col], z, columns)
        needed = alive.any(axis=0)
        if np.count_nonzero(needed) < 0.75 * len(needed):
            scores, alive, v, v_left, columns = scores[:, needed], alive[:, needed], v[:, needed], v_left[:, needed], columns[needed]
    scores[~alive] = -np.inf
    if scores.shape[1] > k:  # most pairs are left: their own k-th best is a better floor
        floor = np.maximum(floor, np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k])
    row, col = np.nonzero(alive & (scores >= floor[:, None]))
    return row, columns[col], scores[row, col]


def carry_on(q, v, q_left, v_left, floor, row, col, score, at: int, columns) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The remaining dimension blocks for single pairs, compacted after each."""
    for a in range(at, len(v), _DIMS):
        z = min(a + _DIMS, len(v))
        score = score + np.einsum("pd,dp->p", q[row, a:z], v[a:z, col])
        b = z // _DIMS if z < len(v) else len(v_left) - 1
        keep = score + q_left[b][row] * v_left[b][col] + 0.5 >= floor[row]
        row, col, score = row[keep], col[keep], score[keep]
    keep = score >= floor[row]
    return row[keep], columns[col[keep]], score[keep]


def long_pairs(q: np.ndarray, v: np.ndarray, own: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs by whole numbers of any size, for scores that doubles don't hold exactly."""
    whole = np.vectorize(int, otypes=[object])
    exact = np.clip(whole(q).dot(whole(v)), _LOW, _HIGH) if v.size and q.size else np.zeros((len(q), v.shape[1]), object)
    keep = np.ones(exact.shape, bool)
    keep[own] = False
    row, col = np.nonzero(keep)
    return row, col, exact[row, col].astype(np.int64)


def scan(best: Best, q: np.ndarray, q_ids: np.ndarray, q_left: np.ndarray, block: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
    """One block of candidates (a row each) against all queries. q_ids are sorted."""
    d = max(q.shape[1], block.shape[1])
    if q.shape[1] < d:
        q = np.pad(q, ((0, 0), (0, d - q.shape[1])))
        q_left = left_over(np.ascontiguousarray(q.T))
    v = np.zeros((d, len(block)))
    v[: block.shape[1]] = block.T
    v_left = left_over(v)
    first, last = np.searchsorted(q_ids, ids), np.searchsorted(q_ids, ids, "right")
    last = np.where(null, first, last)
    same = np.repeat(np.arange(len(ids)), last - first)  # candidates that are a query's own row
    asks = np.repeat(first, last - first) + np.arange(len(same)) - np.repeat(np.cumsum(last - first) - (last - first), last - first)
    with np.errstate(over="ignore"):
        exact = q_left[0].max(initial=0) * v_left[0].max(initial=0) < 2**52
    chunk = _CHUNK if exact else 1
    for a in range(0, len(q), chunk):
        z = min(a + chunk, len(q))
        mine = (asks >= a) & (asks < z)
        own = (asks[mine] - a, same[mine])
        if exact:
            row, col, score = bounded_pairs(q[a:z], v, q_left[:, a:z], v_left, best.floor[a:z].astype(np.float64), own, best.k)
        else:
            row, col, score = long_pairs(q[a:z], v, own)
        score = score.astype(np.int64)
        best.add(row + a, score, ids[col], null[col])


def matcher(sent, k: int, key: str):
    """The function that runs a partition of candidates against a pass of queries: rows (no, vec_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, q_ids, numbers, floor, q_left = common.only("queries", key, lambda: (x := sent.value, (*x, left_over(np.ascontiguousarray(x[0].T))))[1])
        best = Best(len(q), k, floor)
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                part = batch.slice(a, _ROWS)
                ids = part.column("id").fill_null(_HIGH).to_numpy(zero_copy_only=False)
                scan(best, q, q_ids, q_left, quantised(vectors.dense(part.column("v"))), ids, part.column("id").is_null().to_numpy(zero_copy_only=False))
        for a in range(0, len(best.query), 1 << 16):
            s = slice(a, a + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(numbers[best.query[s]]), pa.array(best.id[s], mask=best.null[s]), pa.array(best.score[s])], names=["no", "vec_id", "score"])

    return run


def top_k(candidates: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", pass_bytes: int = PASS_BYTES, seed_rows: int = SEED_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k best candidates of every row that is_query (on the column `id`) names."""
    spark = candidates.sparkSession
    common.ship(spark)
    rows = candidates.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(vectors.usable(F.col("v")))
    asked, asked_path = common.materialize(rows.where(F.col("id").isNotNull() & is_query).distinct().select("id", "v", F.monotonically_increasing_id().alias("no")), "topk-queries")
    size = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    passes = 1 + 2 * size[0] * (24 + 8 * (size[1] or 0)) // pass_bytes  # a pass is half full on average
    seed, seed_path = common.materialize(rows.where(F.pmod(F.xxhash64(F.lit(13), "id", "v"), F.lit(max(1, rows.count() // seed_rows))) == 0), "topk-seed")
    found, schema = [], "no long, vec_id long, score long"
    for p in range(passes):
        mine = asked.where(F.pmod(F.xxhash64(F.lit(17), "no"), F.lit(passes)) == p).orderBy("id", "no").toArrow()  # a pass of PASS_BYTES
        q_ids, numbers = (mine.column(c).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "no"))
        column = mine.column("v").combine_chunks()
        q = quantised(vectors.dense(column)) if len(q_ids) else np.zeros((0, 0))
        floor = np.full(len(q), _LOW, np.int64)
        for step in (seed, rows):
            sent = spark.sparkContext.broadcast((q, q_ids, numbers, floor))
            hits = step.mapInArrow(matcher(sent, k, f"{asked_path}-{p}-{step is seed}"), schema)
            if step is seed:
                kth = ranked(hits, k).where(F.col("rank") == k).select("no", "score").toArrow()  # a row a query of the pass
                at = {n: i for i, n in enumerate(numbers.tolist())}
                for no, score in zip(kth.column("no").to_pylist(), kth.column("score").to_pylist(), strict=True):
                    floor[at[no]] = score
            else:
                found.append(common.materialize(hits, "topk-found")[0])
            sent.destroy()
    common.discard(spark, seed_path)
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    names = asked.select("no", F.col("id").alias("query_id"))
    return ranked(hits, k).join(names, "no").select("query_id", "rank", "vec_id", "score")


def ranked(hits: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def op13_top_k(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0)


ORACLE_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT DISTINCT vec_id AS query_id, v AS qv FROM e WHERE vec_id % 100 = 0),
s AS (SELECT query_id, qv, vec_id, list_dot_product(qv, v)::BIGINT AS score FROM q JOIN e ON vec_id IS DISTINCT FROM query_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id, qv ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank, vec_id, score FROM s
QUALIFY rank <= 10
"""
