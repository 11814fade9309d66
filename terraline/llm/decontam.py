"""Benchmark decontamination with an FM-index per training shard.

Words are runs of ASCII letters and digits and of any non-ASCII characters, A-Z lower-cased. A window is `window` consecutive
words of a benchmark item (all its words if it has fewer). A shard is a bounded piece of a task's documents; its words become
symbols, words outside the benchmark one separator, and a stretch between separators that is shorter than the shortest
window is left out, as it cannot hold one. The shard's FM-index answers every window by backward search; occurrences are
located by sampled suffix positions, and the word spans they cover are merged.

The executors cut the benchmark into blocks of about BLOCK_BYTES of text, a table in the shared folder. A pass over the
documents takes blocks of PASS_BYTES of text at most (and one block at least), which are broadcast; a worker unpacks one at a
time. Where the benchmark is larger, the next pass goes over the rows again and adds to what they have. So memory doesn't
grow with the benchmark, on the driver neither, and documents aren't shuffled. An item is never cut: a block holds one whole.

Defined cases. Null, empty or wordless text: no words, no hits, not contaminated. Very long texts are searched whole. Null or wordless item: no window. Items
with the same text or id each count by their id; an item with a null id is skipped, or with null_ids (the query and the
pipeline) searched like any other and only left out of items. A repeated document row is judged like the first.
Empty tables give an empty result, or no hits. A column of docs named like one of ours is replaced by ours.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraline.llm import common
from terraline.llm.fmindex import FMIndex

WINDOW = 13
#: Text of one benchmark block, and of the blocks of one pass.
BLOCK_BYTES, PASS_BYTES = 4 << 20, 32 << 20
_SHARD = 8 << 20
_WORDS = bytes((c | 32) if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split() if text else []


@dataclass(frozen=True)
class Block:
    """The windows of some items: vocab (symbol - 1 is the index), the items' symbols laid end to end, where each distinct
    window starts there and its size, and its items (numbers of ids)."""

    vocab: list[bytes]
    flat: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    first: np.ndarray
    items: np.ndarray
    ids: list[str | None]


def block_of(items: list[tuple[str | None, bytes]], window: int) -> Block:
    symbol: dict[bytes, int] = {}
    texts = [(item, words) for item, text in items if (words := words_of(text))]
    flat = np.array([symbol.setdefault(w, len(symbol) + 1) for _, words in texts for w in words], np.int32)
    lengths = np.array([len(words) for _, words in texts], np.int64)
    per = np.maximum(1, lengths - window + 1)
    owner = np.repeat(np.arange(len(texts)), per)
    starts = np.repeat(np.cumsum(lengths) - lengths - (np.cumsum(per) - per), per) + np.arange(per.sum())
    sizes = np.minimum(lengths, window)[owner]
    rows = np.zeros((len(starts), window), np.int32)
    for k in range(window):
        live = sizes > k
        rows[live, k] = flat[starts[live] + k]
    keep, which = np.unique(rows, axis=0, return_index=True, return_inverse=True)[1:] if len(rows) else (starts, starts)
    pairs = np.unique(which.reshape(-1) * max(1, len(texts)) + owner)
    first = np.searchsorted(pairs, np.arange(len(keep) + 1) * max(1, len(texts)))
    return Block(list(symbol), flat, starts[keep], sizes[keep], first, pairs % max(1, len(texts)), [item for item, _ in texts])


def block_table(benchmark: DataFrame, id_col: str, text_col: str, window: int, null_ids: bool) -> tuple[DataFrame, str]:
    """no, size (bytes of text) and data (a pickled Block), in the shared folder."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("text")).where((F.col("id").isNotNull() | F.lit(null_ids)) & F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            data = pickle.dumps(block_of(held, window))
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) + n]), pa.array([size]), pa.array([data], pa.binary())], names=["no", "size", "data"])

        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.append((item, text))
                size += len(text)
                if size >= BLOCK_BYTES:
                    yield flush()
                    n, held, size = n + 1, [], 0
        if held:
            yield flush()

    return common.materialize(rows.repartition(-(-total // BLOCK_BYTES) or 1).mapInArrow(run, "no long, size long, data binary"), "benchmark")


def passes_of(blocks: DataFrame) -> list[list[int]]:
    """Numbers of the blocks of each pass; a number and a size for each block reach the driver."""
    out, size = [], PASS_BYTES
    for r in blocks.select("no", "size").orderBy("no").collect():
        if size + r["size"] > PASS_BYTES:
            out.append([])
            size = 0
        out[-1].append(r["no"])
        size += r["size"]
    return out


#: (document, item) pairs that are made distinct at once.
_PAIRS = 1 << 21


def search_shard(docs: list[list[bytes]], block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (in words of the shard) of the occurrences, and distinct (document, item) pairs."""
    none = np.zeros(0, np.int64)
    if not len(block.sizes):
        return none, none, none, none
    get = {w: i for i, w in enumerate(block.vocab, 1)}.get
    lengths = np.fromiter(map(len, docs), np.int64, len(docs))
    symbols = np.zeros(int(lengths.sum()) + len(docs), np.int64)
    at = 0
    for words in docs:
        symbols[at : at + len(words)] = [get(w, 0) for w in words]
        at += len(words) + 1
    known = np.r_[False, symbols > 0, False]
    edges = np.flatnonzero(known[1:] != known[:-1])
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= block.sizes.min()
    starts, ends = starts[long], ends[long]
    if not len(starts):
        return none, none, none, none
    size = ends - starts + 1  # each stretch with the separator after it
    where = np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(size.sum())
    index = FMIndex(symbols[where], len(block.vocab) + 1)
    low, high = index.search(block.flat, block.starts, block.sizes)
    found = high - low
    which = np.repeat(np.arange(len(found)), found)
    rows = np.arange(len(which)) - np.repeat(np.cumsum(found) - found, found) + low[which]
    begin = where[index.locate(rows)]
    doc = np.searchsorted(np.cumsum(lengths + 1), begin, side="right")
    once = np.unique(doc * len(found) + which)  # a window counts once a document, however often it occurs
    n = np.diff(block.first)[once % len(found)]
    cuts = np.r_[0, np.flatnonzero(np.diff(np.cumsum(n) // _PAIRS)) + 1, len(once)]
    pairs = none
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        d, w, m = once[a:b] // len(found), once[a:b] % len(found), n[a:b]
        items = block.items[np.repeat(block.first[w] - (np.cumsum(m) - m), m) + np.arange(m.sum())]
        pairs = np.union1d(pairs, np.repeat(d, m) * len(block.ids) + items)
    begin = begin - doc  # without the separators
    return begin, begin + block.sizes[which], pairs // len(block.ids), pairs % len(block.ids)


_RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    ]
)


def match_shard(texts: list[bytes | None], blocks, before: tuple[list, list] | None = None) -> tuple[list[int], list[int], list[list[str]], list[list[list[int]]]]:
    """Words, hit words, sorted item ids and merged word spans of each text; before: items and spans of earlier passes."""
    docs = [words_of(x) for x in texts]
    lengths = np.fromiter(map(len, docs), np.int64, len(docs))
    stops = np.cumsum(lengths)
    delta = np.zeros(int(lengths.sum()) + 1, np.int64)
    items: list[list[str]] = [list(x) for x in before[0]] if before else [[] for _ in docs]
    for d, ranges in enumerate(before[1] if before else ()):
        for a, b in ranges:
            delta[stops[d] - lengths[d] + a] += 1
            delta[stops[d] - lengths[d] + b] -= 1
    for block in blocks:
        begin, end, doc, item = search_shard(docs, block)
        np.add.at(delta, begin, 1)
        np.add.at(delta, end, -1)
        for d, i in zip(doc.tolist(), item.tolist(), strict=True):
            if block.ids[i] is not None:
                items[d].append(block.ids[i])
    hit = np.cumsum(delta[:-1]) > 0
    total = np.r_[0, np.cumsum(hit)]
    n_hit = total[stops] - total[stops - lengths]
    spans: list[list[list[int]]] = [[] for _ in docs]
    for d in np.flatnonzero(n_hit).tolist():
        own = np.r_[False, hit[stops[d] - lengths[d] : stops[d]], False]
        edges = np.flatnonzero(own[1:] != own[:-1])
        spans[d] = edges.reshape(-1, 2).tolist()
    return lengths.tolist(), n_hit.tolist(), [sorted(set(x)) for x in items], spans


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", id_col: str = "item_id", keep: list[str] | None = None, null_ids: bool = False) -> DataFrame:
    """The columns in keep (all by default), n_words, n_hit, items, spans (word ranges to remove) and contaminated."""
    spark = docs.sparkSession
    common.ship(spark)
    blocks, _ = block_table(benchmark, id_col, text_col, window, null_ids)
    ours = {*_RESULT.names, "contaminated"}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ours]
    frame = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("__text"))
    text = frame.schema["__text"]
    types = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.list_(pa.int64()))]
    n = len(keep)
    passes = passes_of(blocks) or [[]]
    for k, numbers in enumerate(passes):
        last = k == len(passes) - 1
        sent = spark.sparkContext.broadcast([bytes(r["data"]) for r in blocks.where(F.col("no").isin(numbers)).select("data").collect()])  # PASS_BYTES of text
        schema = T.StructType([docs.schema[c] for c in keep] + [text] * (not last) + _RESULT.fields)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, more=k > 0, last=last, names=schema.names) -> Iterator[pa.RecordBatch]:
            for batch in common.pieces(batches, "__text", _SHARD):
                parts = (common.only("benchmark", hash(x), lambda x=x: pickle.loads(x)) for x in sent.value)
                before = (batch.column(n + 3).to_pylist(), batch.column(n + 4).to_pylist()) if more else None
                found = match_shard(common.texts_of(batch, "__text"), parts, before)
                yield pa.RecordBatch.from_arrays([*batch.columns[: n + (not last)], *(pa.array(x, t) for x, t in zip(found, types, strict=True))], names=names)

        frame = frame.mapInArrow(run, schema)
        if not last:
            frame, _ = common.materialize(frame, "decontaminated")
            sent.destroy()
    return frame.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def clean_documents(docs: DataFrame, benchmark: DataFrame, null_ids: bool = False) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "text")
    return decontaminate(whole, benchmark, keep=["__row"], null_ids=null_ids).where(~F.col("contaminated")).select("__row.*")


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    found = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["doc_id"], null_ids=True)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bk AS (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS win FROM bk),
dk AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
dw AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS win FROM dk),
hits AS (SELECT DISTINCT doc_id, k, n, item_id FROM dw JOIN bw USING (n, win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
