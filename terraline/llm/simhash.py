"""SimHash near-duplicates by the generalised pigeonhole principle.

Words are the runs of non-blank bytes of the text with A-Z lower-cased, shingles are `shingle` consecutive words joined by
blanks (repeats included), and a fingerprint bit is set if it is set in over half of the shingles' XXH64 values (seed 42).
Fingerprints link at `max_bits` or fewer differing bits.

Search. Bits that agree or differ together are grouped into the same partition (co-occurrence counts over all distinct
fingerprints), and every partition i gets its own threshold t_i, -1 meaning that it isn't probed. If the sum of (t_i + 1) is
max_bits + 1, two fingerprints within max_bits are within t_i in some partition. Dynamic programming picks the number of
partitions and the thresholds with the fewest estimated candidates and probes. Exact partition values are joined with
probes (values with up to t_i bits flipped), and candidates are verified on all 64 bits inside the join. Equal
fingerprints are one vertex, so copies never make pairs.

Defined cases. Null, empty or blank text: fingerprint zero, linked like any other. Fewer words than a shingle: the whole
sequence is the one shingle. Very long texts are read whole, in blocks that end at a blank. Null ids: linked, but never a
component's id unless it has no other; repeated ids: each row for itself. Repeated rows: equal fingerprints, one component. A component's id is its smallest non-null
doc_id, null if it has none. Empty table: empty result. Columns named like ours are replaced in the result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraline.llm import common
from terraline.llm.components import components

BITS = 64
#: For first_of_similar: fingerprints a text (its pool), texts a key to aim at, the fewest bits of a key, the most bits in which the pools of a
#: candidate differ (39 of 256 are expected at a similarity of 0.8, 128 of unrelated texts), and the bits within which the pigeonhole
#: brings every two pools together.
WORDS, PER_KEY, LEAST_BITS, POOL_BITS, NEAR_BITS = 4, 512, 15, 72, 31
#: Keys of bits drawn at random, to which tests/llm/test_near_copies.py holds meetings() and nearest(): bits a key, tables, chance that a bit agrees at 0.8.
KEY_BITS, TABLES, AGREE = 20, 96, 0.848
#: Of the bits behind a key, drawn from the other partitions, of every 4 at most 1 may differ (6 of 40 are expected at 0.8, 20 of unrelated texts).
REST_SHARE = 0.25
#: Up to which share of the keys the first rounds go, and how many rows of its key a row meets: few at first, so that near copies are
#: linked and needn't meet again. The others follow, ROUND keys at a time.
ROUNDS, ROUND, WINDOW = [(0.05, 8), (0.19, 1024)], 80, 1024
#: Bits of a set's sketch, and after how many candidates in vain a vertex's rows carry it.
SKETCH, IN_VAIN = 512, 3
_WORDS = [f"w{w}" for w in range(WORDS)]
_BATCH = 4 << 20
_BLOCK = 4 << 20
_ROWS = 1 << 17
_BLANKS = (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a lower-cased text, block by block, so that a huge text is never one list."""
    start, n = 0, len(text)
    while start < n:
        end = min(n, start + _BLOCK)
        if end < n:  # up to the last blank of the block, or else to the first one behind it
            cut = max(text.rfind(x, start, end) for x in _BLANKS)
            end = cut + 1 if cut >= start else min((k for x in _BLANKS if (k := text.find(x, end)) >= 0), default=n)
        yield text[start:end].lower().split()
        start = end


def shingle_hashes(text: bytes | None, k: int) -> Iterator[np.ndarray]:
    """XXH64 values of the shingles, in arrays of bounded size."""
    if not text:
        return
    digest, tail, made = xxhash.xxh64_intdigest, [], False
    for words in word_blocks(text):
        words = tail + words
        if len(words) >= k:
            made = True
            whole = b" ".join(words)
            at = list(accumulate(map(len, words), lambda a, b: a + b + 1, initial=0))
            yield np.array([digest(whole[i : j - 1], 42) for i, j in zip(at, at[k:], strict=False)], np.uint64)
        tail = words[max(0, len(words) - k + 1) :] if k > 1 else []
    if not made and tail:
        yield np.array([digest(b" ".join(tail), 42)], np.uint64)


def _sums(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


def fingerprints(texts: list[bytes | None], shingle: int = 3) -> np.ndarray:
    """One signed 64-bit fingerprint for each text."""
    out = np.zeros(len(texts), np.uint64)
    held: list[np.ndarray] = []
    owners: list[int] = []
    rows = 0

    def flush() -> None:
        if held:
            sizes = np.fromiter(map(len, held), np.int64, len(held))
            sums = _sums(np.concatenate(held), np.cumsum(sizes) - sizes)
            own = np.array(owners)
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            sums, total = np.add.reduceat(sums, first, axis=0), np.add.reduceat(sizes, first)
            for i, s, n in zip(own[first].tolist(), sums, total, strict=True):
                part = carried.pop(i, None)
                if part:
                    s, n = s + part[0], n + part[1]
                if open_at[0] == i:
                    carried[i] = (s, n)
                else:
                    out[i] = np.packbits(2 * s > n, bitorder="little").view(np.uint64)[0]
            held.clear()
            owners.clear()

    carried: dict[int, tuple[np.ndarray, int]] = {}
    open_at = [-1]
    for i, text in enumerate(texts):
        for part in shingle_hashes(text, shingle):
            held.append(part)
            owners.append(i)
            rows += len(part)
            if rows >= _ROWS:
                open_at[0] = i
                flush()
                open_at[0], rows = -1, 0
        if i in carried and i not in owners:
            s, n = carried.pop(i)
            out[i] = np.packbits(2 * s > n, bitorder="little").view(np.uint64)[0]
    flush()
    return out.view(np.int64)


def fingerprint_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    common.ship(docs.sparkSession)
    frame = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.pieces(batches, "text", _BATCH):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints(common.texts_of(batch, "text"), shingle))], names=["doc_id", "fp"])

    return frame.mapInArrow(run, T.StructType([T.StructField("doc_id", frame.schema["doc_id"].dataType), T.StructField("fp", T.LongType())]))


def co_occurrence(prints: DataFrame, columns: tuple[str, ...] = ("fp",)) -> tuple[int, np.ndarray]:
    """Number of fingerprints (of one or more columns) and, for each pair of bits, in how many both are set; over all rows, summed by Spark."""
    size = BITS * len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, step = np.zeros((size, size)), 0, _ROWS // len(columns)
        for batch in batches:
            values = np.column_stack([c.to_numpy() for c in batch.columns])
            for at in range(0, len(values), step):
                x = np.unpackbits(values[at : at + step].copy().view(np.uint8), axis=1, bitorder="little").astype(np.float32)
                total += x.T @ x
                n += len(x)
        if n:
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[i, -1]), pa.array(np.r_[j, -1]), pa.array(np.r_[total[i, j], n].astype(np.int64))], names=["i", "j", "n"])

    got = prints.select(*columns).mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    out, n = np.zeros((size, size)), 0
    for r in got:
        if r["i"] < 0:
            n = r["n"]
        else:
            out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["n"]
    return n, out


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of near-equal width; each grows from one bit by the free bit most correlated with those it has."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd)
    np.fill_diagonal(corr, 0)
    free, out = np.ones(len(both), bool), []
    for k in range(parts):
        mine, tied = [], corr[:, free].sum(axis=1)
        for _ in range(len(both) // parts + (k < len(both) % parts)):
            best = int(np.where(free, tied, -np.inf).argmax())
            tied = tied + corr[:, best] if mine else corr[:, best]
            mine.append(best)
            free[best] = False
        out.append(sorted(mine))
    return out


def _within(agree: np.ndarray, most: int) -> np.ndarray:
    """Chance that a random pair differs in at most 0, 1, ... most of the bits, given the chance that each agrees."""
    d = np.zeros(most + 1)
    d[0] = 1
    for a in agree:
        d[1:] = d[1:] * a + d[:-1] * (1 - a)
        d[0] *= a
    return np.cumsum(d)


def _probed(n: int, agree: np.ndarray, max_bits: int) -> list[float]:
    """Cost of a partition by threshold: candidates, index and probe rows (values with up to t bits flipped)."""
    near = _within(agree, max_bits)
    rows = np.cumsum([float(len(list(combinations(range(len(agree)), t)))) if t < 3 else len(agree) ** 3 / 6 for t in range(max_bits + 1)])
    return list(n * n / 2 * near + 20 * n * (rows + 1))


def _masked(n: int, agree: np.ndarray, max_bits: int) -> list[float]:
    """Cost of a partition by threshold, if rows meet in its values without any t bits: meetings (dear beyond PER_KEY rows a key) and
    rows, as dear as 100 meetings. A key has LEAST_BITS at least, so that the plan, and with it the rows a text, is one for all tables
    up to some millions of texts."""
    found = []
    for t in range(min(3, len(agree))):
        keys, same = math.comb(len(agree), t), float(np.exp(np.log(agree).mean() * (len(agree) - t)))
        met = n * n / 2 * keys * same * (1 if n * same <= PER_KEY else 100)
        found.append(met + 100 * n * keys if len(agree) - t >= LEAST_BITS else np.inf)
    return found


def allocate(n: int, both: np.ndarray, max_bits: int, costs: Callable[[int, np.ndarray, int], list[float]] = _probed) -> list[tuple[list[int], int]]:
    """Partitions and thresholds of least estimated cost (a shuffled row counts as 20 comparisons)."""
    p = np.diag(both) / max(n, 1)
    agree = p * p + (1 - p) * (1 - p)
    best: tuple[float, list] = (np.inf, [])
    for parts in range(1, max_bits + 3):
        groups = group_bits(n, both, parts)
        cost = [[0.0, *costs(n, agree[g], max_bits)] for g in groups]
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for c in cost:
            after: dict[int, tuple[float, list[int]]] = {}
            for spent, (total, chosen) in table.items():
                for t in range(-1, len(c) - 1):
                    now = spent + t + 1
                    if now <= max_bits + 1 and (now not in after or total + c[t + 1] < after[now][0]):
                        after[now] = (total + c[t + 1], [*chosen, t])
            table = after
        total, chosen = table.get(max_bits + 1, (np.inf, []))
        if total < best[0]:
            best = (total, list(zip(groups, chosen, strict=True)))
    return best[1]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(prints: DataFrame, plan: list[tuple[list[int], int]], max_bits: int) -> DataFrame:
    """Verified links a < b between distinct fingerprints."""
    exact, probes = [], []
    for i, (bits, t) in enumerate(plan):
        if t < 0:
            continue
        part = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))
        exact.append(F.struct(F.lit(i).alias("i"), part.alias("value")))
        for r in range(t + 1):
            probes += [F.struct(F.lit(i).alias("i"), part.bitwiseXOR(F.lit(_signed(sum(1 << b for b in flip)))).alias("value")) for flip in combinations(bits, r)]
    index = prints.select(F.col("fp").alias("a"), F.explode(F.array(*exact)).alias("k")).select("a", "k.i", "k.value")
    probe = prints.select(F.col("fp").alias("b"), F.explode(F.array(*probes)).alias("k")).select("b", "k.i", "k.value")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    return index.join(probe, (index["i"] == probe["i"]) & (index["value"] == probe["value"]) & near).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fp (long), component_id for every row."""
    prints, path = common.materialize(fingerprint_table(docs, id_col, text_col, shingle), "simhash")
    classes, classes_path = common.materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "simhash-classes")
    n, both = co_occurrence(classes)
    if n == 0:
        return prints.withColumn("component_id", F.col("doc_id"))
    roots, _ = components(links(classes.select("fp"), allocate(n, both, max_bits), max_bits))
    rooted = classes.join(roots.withColumnRenamed("v", "fp"), "fp", "left").select("fp", "rep", "n", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"), F.sum("n").alias("rows"))
    known = rooted.join(least.where("rows > 1"), "root").select("fp", "component_id")
    known, _ = common.materialize(known, "simhash-components")
    common.discard(docs.sparkSession, classes_path)
    return prints.join(known, "fp", "left").select("doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id"))


def first_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of docs for each component. A row is known by its id and its text; the smallest id stays, a null one only where no row of the component has an id."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("th"))
    found = near_duplicates(docs.select(key.alias("key"), "text"), id_col="key", shingle=shingle, max_bits=max_bits)
    kept = found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("__n")).select(F.col("doc_id.doc_id").alias("__id"), F.col("doc_id.th").alias("__th"), "__n")
    kept, _ = common.materialize(kept, "simhash-kept")  # grows with the input: never broadcast, at any size
    return _rows_of(docs, kept, bool(kept.where("__n > 1").take(1)))


def _rows_of(docs: DataFrame, kept: DataFrame, again: bool) -> DataFrame:
    """The row of docs for each id and text hash (__id, __th) in kept; again: some stand in more than one row."""
    left = docs.withColumn("__t", F.xxhash64("text"))
    left = left.join(kept.select("__id", "__th").hint("merge"), F.col("__t").eqNullSafe(F.col("__th")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    return (left.dropDuplicates(["doc_id", "__t"]) if again else left).drop("__t")  # text moves again only where rows repeat


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Distinct shingle hashes, sorted."""
    got = np.zeros(0, np.uint64)
    for part in shingle_hashes(text, k):
        got = np.union1d(got, part)
    return got


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pool_of(hashes: np.ndarray) -> np.ndarray:
    """WORDS independent fingerprints of a shingle set; bits are set as in fingerprints(), each shingle counts once."""
    sums = np.zeros((WORDS, BITS), np.int64)
    for at in range(0, len(hashes), _ROWS):
        part = hashes[at : at + _ROWS]
        for w in range(WORDS):
            sums[w] += _sums(_mix(part + np.uint64((w + 1) * 0x9E3779B97F4A7C15 % 2**64)), np.zeros(1, np.int64))[0]
    return np.packbits(2 * sums > len(hashes), axis=1, bitorder="little").view(np.uint64)[:, 0].view(np.int64)


def sketch_of(hashes: np.ndarray) -> bytes:
    """For each of SKETCH bits whether an odd number of the set's shingles falls to it. A shingle that only one of two sets has changes
    one bit, so two sketches differ in no more bits than the sets do in shingles."""
    odd = np.bincount((hashes % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def pool_table(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, th (hash of the text), v (hash of the shingle set), n (its size), the fingerprints w0, w1, ... and the sketch p of every row."""
    common.ship(docs.sparkSession)
    frame = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    names = ["doc_id", "th", "v", "n", *_WORDS, "p"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.pieces(batches, "text", _BATCH):
            sets = [shingle_set(x, shingle) for x in common.texts_of(batch, "text")]
            v = np.array([xxhash.xxh64_intdigest(s.tobytes(), 7) for s in sets], np.uint64).view(np.int64)
            words = np.array([pool_of(s) for s in sets]).reshape(len(sets), WORDS)
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(v), sizes, *(pa.array(words[:, w]) for w in range(WORDS)), pa.array(map(sketch_of, sets), pa.binary())], names=names)

    return frame.mapInArrow(run, T.StructType([frame.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in names[1:-1]), T.StructField("p", T.BinaryType())]))


def key_size(n: int) -> tuple[int, int]:
    """For keys drawn at random: bits of a key for n texts, about PER_KEY texts a key, and the tables that find a pair of similarity 0.8 as often as TABLES keys of KEY_BITS do."""
    bits = max(KEY_BITS, int(np.ceil(np.log2(max(n, 1) / PER_KEY))))
    return bits, int(np.ceil(TABLES * AGREE ** (KEY_BITS - bits)))


def partition_keys(plan: list[tuple[list[int], int]]) -> list[tuple[int, list[int]]]:
    """Number and bits of a plan's keys: a partition of threshold t has one for any t of its bits left out, so that two pools that
    differ in at most t bits of the partition are equal in one of them. Keys of different partitions take turns."""
    turns = []
    for g, (bits, t) in enumerate(plan):
        own = [[b for b in bits if b not in out] for out in combinations(bits, t)] if t >= 0 else []
        turns += [(i / len(own), g, key) for i, key in enumerate(own)]
    return list(enumerate(key for _, _, key in sorted(turns)))


def key_words(vertices: DataFrame, keys: list[tuple[int, list[int]]], key_bits: int) -> DataFrame:
    """t, word, v, r, w0, w1, ... (and n and p, where the vertices have them): for each vertex and key a word that begins with the key's bits
    (filled up with zeros to key_bits) and goes on with bits drawn from the rest of the pool, and the vertex's root and pool."""
    size, picked = BITS * WORDS, []
    for t, bits in keys:
        rest = np.setdiff1d(np.arange(size), bits)
        picked.append(np.r_[bits, np.full(key_bits - len(bits), size, np.int64), np.random.default_rng([5, t]).choice(rest, BITS - key_bits, replace=False)].astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                pool = np.column_stack([part.column(2 + w).to_numpy() for w in range(WORDS)]).view(np.uint8)
                bits = np.zeros((size + 1, part.num_rows), np.uint8)  # the last one is the filling
                bits[:size] = np.unpackbits(pool, axis=1, bitorder="little").T
                for (t, _), p in zip(keys, picked, strict=True):
                    word = np.ascontiguousarray(np.packbits(bits[p], axis=0).T).view(">u8")[:, 0].astype(np.uint64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, t, np.int32)), pa.array((word ^ np.uint64(1 << 63)).view(np.int64)), *part.columns], names=["t", "word", *columns])

    columns = ["v", "r", *_WORDS, *(c for c in ("n", "p") if c in vertices.columns)]
    return vertices.select(*columns).mapInArrow(run, "t int, word long, " + ", ".join(f"{c} {'binary' if c == 'p' else 'long'}" for c in columns))


def meetings(t: np.ndarray, word: np.ndarray, root: np.ndarray, key_bits: int, window: int, fresh: int, pools: np.ndarray | None = None, sizes: np.ndarray | None = None, least: float = 0.0, sketches: np.ndarray | None = None, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places i > j (i from `fresh` on), and the bits that differ behind the key, of rows of one key with unlike roots that may be
    similar: whose pools differ in at most POOL_BITS bits and whose sets' sizes allow the similarity `least`, or, without pools, by the
    bits behind the key alone. Where both rows have a sketch (`known`), sets that differ in more shingles than the similarity allows
    are told by it; no pair of that similarity is. Rows are sorted by table and word, so within a key by its further bits, too; i - j is at most `window`."""
    behind = np.uint64((1 << (BITS - key_bits)) - 1)
    most = int(REST_SHARE * (BITS - key_bits))
    key = (word.view(np.uint64) ^ np.uint64(1 << 63)) & ~behind
    found, live = [], np.arange(max(fresh, 1), len(t))
    for lag in range(1, window + 1):
        live = live[live >= lag]
        live = live[(key[live] == key[live - lag]) & (t[live] == t[live - lag])]
        if not len(live):
            break
        unlike = live[root[live] != root[live - lag]]
        apart = np.bitwise_count((word[unlike] ^ word[unlike - lag]).view(np.uint64) & behind)
        if pools is None:
            near = apart <= most
        else:
            near = (np.bitwise_count(pools[unlike] ^ pools[unlike - lag]).sum(axis=1, dtype=np.int64) <= POOL_BITS) & (np.minimum(sizes[unlike], sizes[unlike - lag]) >= least * np.maximum(sizes[unlike], sizes[unlike - lag]))
        if sketches is not None:
            at = np.flatnonzero(near)
            at = at[known[unlike[at]] & known[unlike[at] - lag]]
            x, y = unlike[at], unlike[at] - lag
            near[at] = np.bitwise_count(sketches[x] ^ sketches[y]).sum(axis=1, dtype=np.int64) * (1 + least) <= (1 - least) * (sizes[x] + sizes[y]) + 1e-6
        found.append((unlike[near], unlike[near] - lag, apart[near].astype(np.int64)))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def nearest(t: np.ndarray, word: np.ndarray, root: np.ndarray, key_bits: int, i: np.ndarray, j: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Of those meetings the nearest of each root within a key, so that a group of R roots in a key gives R pairs at most."""
    key = (word.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(BITS - key_bits)
    number = np.cumsum(np.r_[False, (key[1:] != key[:-1]) | (t[1:] != t[:-1])])
    pair, own = np.tile(np.arange(len(i)), 2), np.r_[root[i], root[j]]
    order = np.lexsort((j[pair], i[pair], apart[pair], own, number[i[pair]]))
    whose = np.column_stack([number[i[pair]], own])[order]
    first = np.r_[True, (whose[1:] != whose[:-1]).any(axis=1)][: len(order)]
    return np.unique(pair[order[first]])


def met_pairs(words: DataFrame, key_bits: int, window: int, least: float) -> DataFrame:
    """a < b: candidates of some tables, of what may be similar the nearest of each root in each of its keys. The nearest is taken by the
    bits behind the key, which every key draws anew: by the whole pool the same pairs would come first in key after key, and hide
    others. Rows are dealt by ranges of (table, word, v), so a crowded key is many tasks, and a task holds a batch and the window before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int32), *(np.zeros(0, np.int64),) * (4 + WORDS), np.zeros((0, SKETCH // BITS), np.uint64), np.zeros(0, bool)]
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                before = len(held[0])
                own = [part.column(c).to_numpy() for c in range(5 + WORDS)]
                if carried:
                    known = part.column("p").is_valid().to_numpy(zero_copy_only=False)
                    sketches = np.zeros((len(known), SKETCH // BITS), np.uint64)
                    sketches[known] = np.frombuffer(b"".join(part.column("p").drop_null().to_pylist()), np.uint64).reshape(-1, SKETCH // BITS)
                    own += [sketches, known]
                held = [np.concatenate([h, o]) for h, o in zip(held, own, strict=False)]
                t, word, v, r, n, *pool = held[: 5 + WORDS]
                i, j, apart = meetings(t, word, r, key_bits, window, before, np.column_stack(pool).view(np.uint64), n, least, *held[5 + WORDS :])
                if len(i):
                    kept = nearest(t, word, r, key_bits, i, j, apart)
                    x, y = v[i[kept]], v[j[kept]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])
                held = [h[max(0, len(h) - window) :] for h in held]

    carried = "p" in words.columns
    rows = words.select("t", "word", "v", "r", "n", *_WORDS, *(["p"] if carried else []))
    return rows.repartitionByRange("t", "word", "v").sortWithinPartitions("t", "word", "v").mapInArrow(run, "a long, b long")


def _similar(pairs: DataFrame, vertices: DataFrame, docs: DataFrame, shingle: int, least: float) -> DataFrame:
    """The pairs a, b whose shingle sets have a Jaccard similarity of at least `least`, by the sets themselves."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("v")).distinct().join(vertices.hint("merge"), "v").select("v", F.col("rep.doc_id").alias("__id"), F.col("rep.th").alias("__th"))
    same = F.col("__th").eqNullSafe(F.xxhash64("text")) & F.col("__id").eqNullSafe(F.col("doc_id"))
    texts = docs.select("doc_id", "text").join(wanted.hint("merge"), same).dropDuplicates(["v"]).select("v", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.pieces(batches, "text", _BATCH):
            sets = [shingle_set(x, shingle).view(np.int64) for x in common.texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["v", "s"])

    sets, path = common.materialize(texts.mapInArrow(run, "v long, s array<long>"), "simhash-sets")
    both = F.size(F.array_intersect("sa", "sb"))
    near = both >= least * (F.size("sa") + F.size("sb") - both)
    side = lambda c: sets.select(F.col("v").alias(c), F.col("s").alias(f"s{c}")).hint("merge")
    found, _ = common.materialize(pairs.join(side("a"), "a").join(side("b"), "b").where(near).select("a", "b"), "simhash-similar")
    common.discard(docs.sparkSession, path)
    return found


def similar_roots(vertices: DataFrame, docs: DataFrame, shingle: int, least: float) -> DataFrame:
    """v, root of the vertices that are not the smallest of their component.

    The pool of WORDS fingerprints is searched by the generalised pigeonhole: bits are grouped by their co-occurrence over all
    vertices, and thresholds that add up to NEAR_BITS are dealt by dynamic programming, so two pools within NEAR_BITS share a key, and
    most of those beyond do. The keys are taken in rounds. In a key every vertex meets the others, by their whole pools and the sizes of
    their sets; of what may be similar and has another root, the nearest of each root is a candidate, unless it was met before, and the
    sets verify it. So a group of near copies is linked by the first keys. A vertex whose candidates were IN_VAIN times not similar
    in the first rounds carries a sketch of its set in the others, so the members of a group that is nearly similar aren't candidates key after key. A key with more than a window's rows is met in the order of its
    further bits, a window at a time.
    """
    spark = docs.sparkSession
    n, both = co_occurrence(vertices.coalesce(4 * spark.sparkContext.defaultParallelism), tuple(_WORDS))
    keys = partition_keys(allocate(n, both, NEAR_BITS, _masked)) if n else []
    key_bits = max((len(bits) for _, bits in keys), default=0)
    links = tried = None
    searched = vertices.drop("p")
    roots = vertices.select("v", F.col("v").alias("root")).limit(0)
    before: list[str] = []
    ends = [(max(i + 1, round(share * len(keys))), window) for i, (share, window) in enumerate(ROUNDS)]
    ends += [(min(len(keys), e + ROUND), WINDOW) for e in range(ends[-1][0], len(keys), ROUND)]
    done = 0
    for i, (upto, window) in enumerate(ends if n else []):
        now = searched.withColumn("r", F.col("v"))
        if links is not None:
            now = searched.join(roots.select(F.col("v").alias("x"), "root").hint("merge"), F.col("v") == F.col("x"), "left").withColumn("r", F.coalesce("root", "v"))
        pairs = met_pairs(key_words(now, keys[done:upto], key_bits), key_bits, window, least).distinct()
        done = upto
        if tried is not None:
            pairs = pairs.join(tried.hint("merge"), ["a", "b"], "left_anti")
        pairs, pairs_path = common.materialize(pairs, "simhash-met")
        common.drop_shuffles(spark)  # of the keys: the largest there are
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = _similar(pairs, vertices, docs, shingle, least)
        links = found if links is None else links.unionByName(found)
        before.append(pairs_path)
        roots, _ = components(links)
        if i + 1 == len(ROUNDS) < len(ends):
            vain = tried.join(links.hint("merge"), ["a", "b"], "left_anti")
            often = vain.select(F.col("a").alias("y")).unionByName(vain.select(F.col("b").alias("y"))).groupBy("y").agg(F.count("*").alias("times")).where(F.col("times") >= IN_VAIN)
            sketched = vertices.join(often.hint("merge"), F.col("v") == F.col("y"), "left").withColumn("p", F.when(F.col("y").isNotNull(), F.col("p"))).drop("y", "times")
            searched, sketched_path = common.materialize(sketched, "simhash-sketched")
            before.append(sketched_path)
        common.drop_shuffles(spark)
    common.discard(spark, *before)
    return roots


def first_of_similar(docs: DataFrame, shingle: int = 5, least: float = 0.8) -> DataFrame:
    """One row of docs for each component of texts whose sets of `shingle` words have a Jaccard similarity of at least `least`.

    Candidates are found by SimHash and the generalised pigeonhole over WORDS independent fingerprints (see similar_roots) and verified
    on the sets, so nothing less similar is linked; the README has the share of pairs that is found. A row is known by its id and
    its text: the row with the smallest id stays, a null one only where no row of the component has an id.
    """
    rows, path = common.materialize(pool_table(docs, shingle), "simhash-pool")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    vertices, vertices_path = common.materialize(rows.groupBy("v").agg(F.min(rank).alias("rep"), F.min("n").alias("n"), *[F.min(w).alias(w) for w in [*_WORDS, "p"]]), "simhash-vertices")
    roots = similar_roots(vertices, docs, shingle, least).withColumnRenamed("v", "x")
    rooted = vertices.join(roots.hint("merge"), F.col("v") == F.col("x"), "left").groupBy(F.coalesce("root", "v").alias("root")).agg(F.min("rep").alias("rep"))
    kept = rooted.select(F.col("rep.doc_id").alias("__id"), F.col("rep.th").alias("__th"))
    kept, _ = common.materialize(kept, "simhash-kept")  # grows with the input: never broadcast, at any size
    same = F.col("th").eqNullSafe(F.col("__th")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    again = rows.groupBy("doc_id", "th").agg(F.count("*").alias("n")).where("n > 1").join(kept.hint("merge"), same, "left_semi").take(1)
    common.discard(docs.sparkSession, path, vertices_path)
    return _rows_of(docs, kept, bool(again))


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
