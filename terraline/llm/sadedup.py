"""Suffix-array removal of repeated byte strings by induced sorting.

A byte goes if a string of `length` bytes that covers it also starts anywhere else in the input, the same document included.

1. Anchors. The anchor of a string of `length` bytes is the first of its grams whose hash has the smallest upper half;
   neighbouring strings mostly share theirs. An anchor's neighbourhood is all that the strings it anchors cover. Equal strings have equal anchors at
   the same offset, so a repeated string lies in the neighbourhood of an anchor whose gram occurs again.
2. Anchors are counted by gram, and those that occur once are gone. Equal neighbourhoods (128 bits of hashes) are repeated as a
   whole; only where a repeated gram stands in different neighbourhoods must text be compared.
3. For those, one representative of each neighbourhood goes to the shard of its gram. A shard's suffix array is induced
   linearly, its permuted common prefixes are computed, and suffixes sharing `length` bytes form runs: if a run has two
   positions of the input, or a representative of several copies, its strings are repeated.
   A gram with more than `hot` different neighbourhoods is too much for one task. Its strings are split by the offset of
   the gram, in halves, and by the bytes that all strings of a half have in common; each part is again settled where equal
   and else given to a suffix array, or split further, down to single strings.
4. The repeated ranges of each document are united and cut out.

Text moves once to find the neighbourhoods' bytes and once to be cut; hash rows move otherwise. Only the list of the grams that
hold more than a MOST_HOT-th of all repeated anchors, at most MOST_HOT of them, is broadcast: their rows are salted.

Defined cases. Null text: no bytes. Very long texts are read whole. Shorter texts than `length` stay whole. Repeated rows are copies of each other, so
`length` bytes or more go from both. Documents are told apart by two 64-bit hashes of id and text; null and repeated ids are
fine. Columns named like ours are replaced in the result; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraline.llm import common, sais

LENGTH = 200
GRAM = 32
#: Most different neighbourhoods of a gram that one task compares; beyond, they are split.
HOT = 8_000
#: Grams whose rows are salted, at most, and the salts of each.
MOST_HOT, SALTS = 1_000, 32
_PIECE = 2 << 20
_SHARD = 2 << 20
_MAX, _LOW = np.uint64(2**64 - 1), np.uint64(2**32 - 1)
_KEYS = ["k1", "k2"]


class Roller:
    """Gram hashes of flat byte arrays: polynomials modulo 2**64 over random byte values, then mixed."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self) -> None:
        self.value = np.random.default_rng(7).integers(0, 2**64, 256, np.uint64)
        self.up = self.down = np.ones(1, np.uint64)

    def powers(self, n: int) -> None:
        if len(self.up) >= n:
            return
        n = max(n, _PIECE + (_PIECE >> 2))
        for name, base in (("up", self.BASE), ("down", pow(self.BASE, -1, 1 << 64))):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            setattr(self, name, np.multiply.accumulate(x))

    def grams(self, flat: np.ndarray, k: int) -> np.ndarray:
        n = len(flat)
        if n > 4 * _PIECE:  # a huge text: in steps, so that the powers stay small
            step = 2 * _PIECE
            return np.concatenate([self.grams(flat[i : i + step + k - 1], k) for i in range(0, n - k + 1, step)])
        self.powers(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.value[flat] * self.up[:n], out=sums[1:])
        h = (sums[k:] - sums[:-k]) * self.down[: n - k + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        return h


def sliding(values: np.ndarray, w: int, op: np.ufunc, fill) -> np.ndarray:
    """op over values[i : i + w] for every i, in two passes over blocks of w."""
    n = len(values)
    padded = np.full(-(-(n + w - 1) // w) * w, fill, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, w)
    left = op.accumulate(blocks, axis=1).reshape(-1)
    right = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return op(right[:n], left[w - 1 : w - 1 + n])


def anchors(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text number, position and gram hash of every anchor, and the first and last of the strings (by their starts) whose anchor it is."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    long = np.flatnonzero(lengths >= length)
    if not len(long):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), none, none
    flat = np.frombuffer(b"".join(texts[i] for i in long), np.uint8)
    ends = np.cumsum(lengths[long])
    starts = ends - lengths[long]
    h = common.only("roller", gram, Roller).grams(flat, gram)
    at = np.arange(len(h), dtype=np.uint64)
    where = sliding((h & ~_LOW) | at, length - gram + 1, np.minimum, _MAX) & _LOW
    edges = np.zeros(len(flat) + 1, np.int8)
    edges[starts] += 1
    edges[ends - length + 1] -= 1
    inside = np.flatnonzero(np.cumsum(edges[: len(h)], dtype=np.int8) > 0)  # strings that lie in one text
    p = where[inside].astype(np.int64)
    head = np.r_[True, p[1:] != p[:-1]]  # no anchor is shared by two texts
    first, last = inside[head], inside[np.r_[head[1:], True]]
    p = p[head]
    doc = np.searchsorted(ends, p, side="right")
    base = starts[doc]
    return long[doc], p - base, h[p], first - base, last - base


def _keys(docs: DataFrame, id_col: str, text_col: str) -> list:
    return [F.xxhash64(F.col(id_col), F.col(text_col)).alias("k1"), F.xxhash64(F.lit(3), F.col(id_col)).alias("k2")]


def anchor_table(docs: DataFrame, id_col: str, text_col: str, length: int, gram: int) -> DataFrame:
    """k1, k2 (the document), p (anchor), h (gram), nh (neighbourhood), lo and size (its range)."""
    frame = docs.select(*_keys(docs, id_col, text_col), F.col(text_col).alias("text")).where(F.octet_length("text") >= length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in common.pieces(batches, "text", _PIECE):
            texts = common.texts_of(batch, "text")
            doc, p, h, lo, last = anchors(texts, length, gram)
            if not len(doc):
                continue
            hi = last + length
            nh = np.array([digest(texts[d][a:b], c) for d, a, b, c in zip(doc.tolist(), lo.tolist(), hi.tolist(), (p - lo).tolist(), strict=True)], np.uint64)
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(p), pa.array(h.view(np.int64)), pa.array(nh.view(np.int64)), pa.array(lo), pa.array(hi - lo)], names=["k1", "k2", "p", "h", "nh", "lo", "size"])

    return frame.mapInArrow(run, "k1 long, k2 long, p long, h long, nh long, lo long, size long")


def _with_lists(docs: DataFrame, lists: DataFrame, id_col: str, text_col: str, how: str, extra: list) -> DataFrame:
    keyed = docs.select(*_keys(docs, id_col, text_col), *extra, F.col(text_col).alias("text"))
    return keyed.join(lists, _KEYS, how)


def neighbourhoods(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The bytes of the wanted ranges: wanted's rows (k1, k2, h, nh, c, lo, size, a, m) with body."""
    lists = wanted.groupBy(*_KEYS).agg(F.collect_list(F.struct("h", "nh", "c", "lo", "size", "a", "m")).alias("want"))
    got = _with_lists(docs, lists, id_col, text_col, "inner", []).dropDuplicates(_KEYS)  # repeated rows have the same bytes
    cut = got.select(*_KEYS, F.col("text").cast("binary").alias("text"), F.explode("want").alias("w"))
    return cut.select(*_KEYS, "w.h", "w.nh", "w.c", "w.lo", "w.a", "w.m", F.expr("substring(text, cast(w.lo + 1 as int), cast(w.size as int))").alias("body"))


def repeated_in_shard(bodies: list[bytes], position: np.ndarray, copies: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Body number, start and end (in the body) of the repeated ranges. position: of each body's first byte in the input; copies: of the body."""
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    flat = np.frombuffer(b"".join(bodies), np.uint8)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(bodies)), sizes)
    sa = sais.suffix_array(flat)
    plcp = sais.permuted_lcp(flat, sa, np.minimum(np.arange(len(flat), 0, -1), length))
    run = np.cumsum(plcp[sa] < length)  # suffixes of one run begin with the same `length` bytes
    long = (ends[owner] - np.arange(len(flat)))[sa] >= length  # bytes that don't run into the next body
    sa, run = sa[long], run[long]
    place = (position[owner] + np.arange(len(flat)) - (ends - sizes)[owner])[sa]
    first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    several = np.minimum.reduceat(place, first) != np.maximum.reduceat(place, first)
    several |= np.maximum.reduceat(copies[owner][sa], first) > 1
    several = np.repeat(several, np.diff(first, append=len(sa)))
    starts = np.sort(sa[several])
    if not len(starts):
        return starts, starts, starts
    breaks = np.r_[True, (np.diff(starts) > length) | (owner[starts[1:]] != owner[starts[:-1]])]
    head = starts[breaks]
    tail = starts[np.r_[breaks[1:], True]] + length
    own = owner[head]
    offset = (ends - sizes)[own]
    return own, head - offset, tail - offset


_RANGES = "k1 long, k2 long, s long, e long"


def compare_by_suffix_array(edges: DataFrame, length: int) -> DataFrame:
    """k1, k2, s, e: repeated ranges around the representatives (k1, k2, h, nh, c, lo, body), all of a gram in one task."""
    cols = ["h", *_KEYS, "c", "lo", "body"]

    def solve(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        k1, k2, c, lo = (t[x].to_numpy() for x in ("k1", "k2", "c", "lo"))
        code = np.unique(np.stack([k1, k2]), axis=1, return_inverse=True)[1].reshape(-1)
        own, s, e = repeated_in_shard(t["body"].to_pylist(), (code << 34) + lo, c, length)
        return pa.RecordBatch.from_arrays([pa.array(k1[own]), pa.array(k2[own]), pa.array(lo[own] + s), pa.array(lo[own] + e)], names=["k1", "k2", "s", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            h = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(h[1:] != h[:-1]) + 1).tolist(), len(h)]
            last = held[-1].column(0)[-1].as_py() if held else None
            lengths = np.r_[0, np.cumsum(pa.compute.binary_length(batch.column(5)).to_numpy(zero_copy_only=False))]
            begin = 0
            for a in cuts[1:-1] if last is None or not len(h) or h[0] == last else cuts[:-1]:
                if size + lengths[a] - lengths[begin] >= _SHARD:
                    if a > begin:
                        held.append(batch.slice(begin, a - begin))
                    yield solve(held)
                    held, size, begin = [], 0, a
            if begin < len(h):
                held.append(batch.slice(begin))
                size += int(lengths[-1] - lengths[begin])
        if held:
            yield solve(held)

    return edges.select(*cols).repartition("h").sortWithinPartitions("h").mapInArrow(run, _RANGES)


def halves(parts: DataFrame, length: int) -> DataFrame:
    """The parts (k1, k2, h, c, lo, a, first, last, body), whose strings begin first to last bytes before the gram at a, in two
    each: h is then the hash of the old one and of the bytes that all strings of the half cover, nh that of the half's body."""
    middle = F.floor((F.col("first") + F.col("last")) / 2).cast("int")
    each = parts.withColumn("half", F.explode(F.array(F.struct(F.col("first").alias("x"), middle.alias("y")), F.struct((middle + 1).alias("x"), F.col("last").alias("y"))))).select("*", "half.x", "half.y").where("x <= y")
    begin, end = F.greatest(F.lit(0), F.col("a") - F.col("y")), F.least(F.col("a") - F.col("x"), F.octet_length("body") - length)
    each = each.withColumn("begin", begin.cast("int")).withColumn("end", end.cast("int")).where("begin <= end")
    core = F.expr(f"substring(body, cast(a - x + 1 as int), cast({length} - (y - x) as int))")
    each = each.withColumn("core", core).withColumn("body", F.expr(f"substring(body, begin + 1, end - begin + {length})"))
    key = F.xxhash64("h", "x", "core").alias("h")
    at = (F.col("a") - F.col("begin")).cast("int")
    return each.select(*_KEYS, key, F.xxhash64("body", at).alias("nh"), "c", (F.col("lo") + F.col("begin")).cast("long").alias("lo"), at.alias("a"), F.col("x").cast("int").alias("first"), F.col("y").cast("int").alias("last"), "body")


def split_hot(edges: DataFrame, length: int, gram: int, hot: int) -> list[DataFrame]:
    """The repeated ranges around the representatives of grams with more than hot neighbourhoods, a table for each level of halves."""
    spark, out = edges.sparkSession, []
    parts, path = common.materialize(halves(edges.select(*_KEYS, "h", "c", "lo", F.col("a").cast("int").alias("a"), F.lit(0).alias("first"), F.lit(length - gram).alias("last"), "body"), length), "hot-parts")
    while True:
        kinds, kinds_path = common.materialize(parts.groupBy("h", "nh").agg(F.sum("c").alias("n"), F.min(F.struct(*_KEYS, "lo")).alias("r")), "hot-kinds")
        size = F.octet_length("body")
        copied = parts.join(kinds.where("n > 1").select("h", "nh"), ["h", "nh"], "left_semi").select(*_KEYS, F.col("lo").alias("s"), (F.col("lo") + size).alias("e"))
        mixed = kinds.groupBy("h").agg(F.count("*").alias("m"), F.min("n").alias("least")).where("m > 1 and least = 1").select("h", "m")
        wanted = kinds.join(mixed, "h").select("h", "nh", "n", "m", F.col("r.k1").alias("k1"), F.col("r.k2").alias("k2"), F.col("r.lo").alias("lo"))
        left = parts.drop("c").join(wanted, ["h", "nh", *_KEYS, "lo"]).withColumnRenamed("n", "c")
        cold = compare_by_suffix_array(left.where(F.col("m") <= hot), length)
        found, _ = common.materialize(copied.unionByName(cold).distinct(), "hot-ranges")
        out.append(found)
        rest, rest_path = common.materialize(halves(left.where((F.col("m") > hot) & (F.col("first") < F.col("last"))), length), "hot-parts")
        common.discard(spark, path, kinds_path)
        if not rest.take(1):
            common.discard(spark, rest_path)
            return out
        parts, path = rest, rest_path


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int | None = None, hot: int = HOT) -> DataFrame:
    """k1, k2, ranges (array of different structs s, e; not united) of the documents that have repeated strings. Runs jobs."""
    spark = docs.sparkSession
    common.ship(spark)
    gram = min(GRAM, max(1, length // 2)) if gram is None else gram
    every, every_path = common.materialize(anchor_table(docs, id_col, text_col, length, gram), "anchors")
    again, again_path = common.materialize(every.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "repeated-grams")
    share = (again.agg(F.sum("n")).first()[0] or 0) // MOST_HOT
    common_grams = F.broadcast(again.where(F.col("n") > max(share, 20_000)).select("h", F.lit(True).alias("often")))  # at most MOST_HOT
    salted = lambda df: df.join(common_grams, "h", "left").withColumn("salt", F.when(F.col("often"), F.pmod(F.xxhash64("k1", "p"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")).drop("often")
    spread = lambda df: df.join(common_grams, "h", "left").withColumn("salt", F.explode(F.when(F.col("often"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("often")
    twice, twice_path = common.materialize(salted(every).join(spread(again.select("h")), ["h", "salt"], "left_semi"), "repeated-anchors")
    common.discard(spark, every_path)
    place = F.struct("k1", "k2", "p", "lo", "size")
    kinds, kinds_path = common.materialize(twice.groupBy("h", "nh").agg(F.count("*").alias("c"), F.min(place).alias("r")), "neighbourhoods")
    copied = twice.join(spread(kinds.where("c > 1").select("h", "nh")), ["h", "nh", "salt"], "left_semi").select(*_KEYS, F.col("lo").alias("s"), (F.col("lo") + F.col("size")).alias("e"))
    mixed = kinds.groupBy("h").agg(F.count("*").alias("m"), F.min("c").alias("least")).where("m > 1 and least = 1").select("h", "m")
    wanted = kinds.join(mixed, "h").select("r.k1", "r.k2", "h", "nh", "c", "r.lo", "r.size", (F.col("r.p") - F.col("r.lo")).alias("a"), "m")
    wanted, wanted_path = common.materialize(wanted, "wanted")
    bodies, bodies_path = common.materialize(neighbourhoods(docs, wanted, id_col, text_col), "bodies")  # text moves once for all of them
    ranges = copied.unionByName(compare_by_suffix_array(bodies.where(F.col("m") <= hot), length))
    if wanted.where(F.col("m") > hot).take(1):
        for found in split_hot(bodies.where(F.col("m") > hot), length, gram, hot):
            ranges = ranges.unionByName(found)
    ranges, ranges_path = common.materialize(ranges, "ranges")
    common.discard(spark, again_path, twice_path, kinds_path, wanted_path, bodies_path)
    return ranges.groupBy(*_KEYS).agg(F.collect_set(F.struct("s", "e")).alias("ranges"))


def unite(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def cut(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for s, e in runs:
        parts.append(text[at:s])
        at = e
    parts.append(text[at:])
    return b"".join(parts)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep: list[str] | None = None, output: str = "kept", hot: int = HOT) -> DataFrame:
    """The columns in keep (all by default), n_bytes, n_removed, n_spans and kept (binary); for output "text"
    kept_text (without the bytes of characters that a cut split), for "digest" kept_sha256."""
    ours = ["n_bytes", "n_removed", "n_spans", {"digest": "kept_sha256", "text": "kept_text"}.get(output, "kept")]
    kind = T.BinaryType() if output == "kept" else T.StringType()
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ours]
    whole = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    frame = _with_lists(docs, repeated_ranges(docs, id_col, text_col, length, hot=hot), id_col, text_col, "left", [whole]).select("row", "text", "ranges")
    schema = T.StructType([frame.schema["row"], *(T.StructField(c, T.LongType()) for c in ours[:3]), T.StructField(ours[3], kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.pieces(batches, "text", 4 * _PIECE):
            rows = []
            column = batch.column(2)
            flat, offsets, there = column.flatten(), column.offsets.to_pylist(), column.is_valid().to_pylist()
            s, e = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            base = offsets[0]
            for i, text in enumerate(common.texts_of(batch, "text")):
                text = text or b""
                a, b = offsets[i] - base, offsets[i + 1] - base
                runs = unite(list(zip(s[a:b].tolist(), e[a:b].tolist(), strict=True))) if there[i] else []
                kept = cut(text, runs) if runs else text
                rows.append((len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest() if output == "digest" else kept.decode("utf-8", "ignore") if output == "text" else kept))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)), pa.array([r[3] for r in rows], pa.binary() if output == "kept" else pa.string())], names=schema.names)

    return frame.mapInArrow(run, schema).select("row.*", *ours)


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs with the repeated strings cut out of text (bytes of a character that a cut split go too; null stays null) and n_chars counted anew."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")
    found = remove_repeats(whole, keep=["row"], output="text").select("row.*", F.when(F.col("row.text").isNotNull(), F.col("kept_text")).alias("__text"))
    new = {"text": F.col("__text"), "n_chars": F.length("__text")}
    return found.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def op10_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep=["doc_id"], output="digest")
