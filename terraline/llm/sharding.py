"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix. DataFrame functions only.

Rows are dealt to blocks by a hash. How many rows of each block go to each range of slots is drawn once: row after row of the
matrix is multivariate hypergeometric given what is still free, which is the law of the counts under a uniform permutation.
Each block is permuted locally (ordered by a seeded hash), cut by its row of the matrix, exchanged, and each slot range is
permuted again. A shard is a run of slot ranges, so its size is exact and its slots have no gap, and no task orders a whole
shard. The only thing that leaves the executors is the block counts (at most MOST_BLOCKS); the matrix is written to the shared
folder, and its at most MOST_BLOCKS times MOST_RANGES counts are the proven bound of the broadcast. Counts are drawn exactly
below a thousand million rows; beyond, by inversion of the exact ratios within twelve deviations of the mode.

Law `rows`: shard sizes differ by one at most. Defined cases. Null text: 16 bytes, CRC 0. Very long texts: only their size and
CRC move. Null ids are ids like others. Rows equal in all keys are interchangeable, meet in one block, and each gets its own
slot. Empty table: empty result. More shards than rows: the last ones stay empty. Columns named shard
or slot are replaced.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraline.llm import common

#: Rows that a block or slot range should hold; numbers of them.
BLOCK_ROWS = 4_000_000
LEAST_BLOCKS, MOST_BLOCKS, LEAST_RANGES, MOST_RANGES = 256, 2048, 320, 2048


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good ones among draws without replacement. Beyond numpy's range by inversion of the exact ratios around the mode."""
    if not good or not draws:
        return 0
    if not bad:
        return draws
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, draws))
    total = good + bad
    sd = math.sqrt(draws * (good / total) * (bad / total) * (total - draws) / max(1, total - 1))
    mode = (draws + 1) * (good + 1) // (total + 2)
    low, high = max(0, draws - bad, mode - int(12 * sd) - 20), min(draws, good, mode + int(12 * sd) + 20)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log((good - k) * (draws - k)) - np.log((k + 1) * (bad - draws + k + 1))
    logs = np.r_[0.0, np.cumsum(steps)]
    weights = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def communication_matrix(blocks: list[int], ranges: list[int], seed: int) -> list[list[int]]:
    """Rows of block i that go to range j; row sums are the blocks, column sums the ranges."""
    rng = np.random.default_rng(seed)
    free = list(ranges)
    out = []
    for size in blocks:
        row, left, rest = [], size, sum(free)
        for j, room in enumerate(free):
            got = hypergeometric(rng, room, rest - room, left)
            row.append(got)
            left -= got
            rest -= room
            free[j] = room - got
        out.append(row)
    return out


def even(total: int, parts: int) -> list[int]:
    return [total // parts + (i < total % parts) for i in range(parts)]


def _table(spark: SparkSession, rows: Iterable[dict], schema: str) -> DataFrame:
    """Rows of the driver as a JSON table in the shared folder, so that no plan carries them."""
    path = f"{common.new_path(spark, 'matrix')}/rows.json"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where)
    for r in rows:
        out.write(bytearray(json.dumps(r).encode() + b"\n"))
    out.close()
    return spark.read.schema(schema).json(path)


def _constant(values: list, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(values)), kind)


def shard_rows(docs: DataFrame, keys: list[str], shards: int = 40, seed: int = 20_240_601) -> DataFrame:
    """docs with shard and slot. keys: columns that tell rows apart; rows equal in all of them are interchangeable."""
    spark = docs.sparkSession
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "slot")])
    n = docs.count()
    blocks = min(MOST_BLOCKS, max(LEAST_BLOCKS, -(-n // BLOCK_ROWS)))
    per = max(1, -(-min(MOST_RANGES, max(LEAST_RANGES, -(-n // BLOCK_ROWS))) // shards))
    block = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(blocks)).cast("int")
    counts = {r["block"]: r["n"] for r in docs.groupBy(block.alias("block")).agg(F.count("*").alias("n")).collect()}
    sizes = [x for s in even(n, shards) for x in even(s, per)]
    matrix = communication_matrix([counts.get(b, 0) for b in range(blocks)], sizes, seed)
    ends = np.cumsum(np.array(matrix, np.int64).reshape(blocks, -1), axis=1)
    stride = max(1, math.isqrt(len(sizes)))
    rows = ({"b": b, "ends": e.tolist(), "coarse": e[stride - 1 :: stride].tolist()} for b, e in enumerate(ends))
    table = _table(spark, rows, "b int, ends array<bigint>, coarse array<bigint>")
    dealt = docs.withColumn("__b", block).withColumn("__r", F.row_number().over(Window.partitionBy("__b").orderBy(F.xxhash64(F.lit(seed + 1), *keys), *keys)).cast("long") - 1)
    dealt = dealt.join(F.broadcast(table), dealt["__b"] == table["b"])
    skip = F.size(F.filter("coarse", lambda x: x <= F.col("__r"))) * stride
    dealt = dealt.withColumn("__skip", skip)
    target = F.col("__skip") + F.size(F.filter(F.slice("ends", F.col("__skip") + 1, F.lit(stride)), lambda x: x <= F.col("__r")))
    dealt = dealt.withColumn("__t", target).drop("__b", "__r", "__skip", "b", "ends", "coarse")
    nth = F.row_number().over(Window.partitionBy("__t").orderBy(F.xxhash64(F.lit(seed + 2), *keys), *keys)).cast("long") - 1
    first = [0]
    for j, s in enumerate(sizes[:-1]):
        first.append(0 if (j + 1) % per == 0 else first[-1] + s)
    slot = F.element_at(_constant(first, "array<bigint>"), F.col("__t") + 1) + nth
    return dealt.select(*[F.col(f"`{c}`") for c in docs.columns], F.floor(F.col("__t") / per).cast("int").alias("shard"), slot.alias("slot"))


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sized = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"), F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    done = shard_rows(sized, ["doc_id", "size", "text_crc32"])
    return done.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
