"""Token files: canonical length-limited Huffman codes of ids, from global counts, with block-wise table decoding.

Files. `blocks` is a Parquet folder of independent blocks in ascending id order: part and block numbers, the documents' ids and
token counts, the first token's index within the part, the bits, and a checkpoint (bit offset) for every STEP tokens.
`code` holds the code length of every id that occurs; lengths alone fix the canonical code. `parts` holds each part's tokens.

Writing takes two passes: ids are computed once and stored raw while their counts are summed, package-merge gives code lengths of
at most MOST_BITS bits (more only where the vocabulary itself needs them), and the raw ids are put in order and packed.
Reading needs a block, the code and the parts' totals: one table of 2**MOST_BITS entries yields a token's id and length, and all
checkpoints at hand are decoded in lock step.

Defined cases. Null or empty text: the end id alone. Very long texts are encoded whole, a batch of their own. Equal or null document ids: ordered by length and a hash of the ids, nulls
first, and dealt to several parts where they are many; rows equal in all of these keep the order in which they were encoded. An
empty table writes empty folders and gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraline.llm import common

END_ID = 2
MOST_BITS = 16
BLOCK = 1 << 16
STEP = 256
_PIECE = 8 << 20
_LANES = 1 << 14
#: Words encoded as one text.
_TOGETHER = 200
#: Words, and their bytes, that a worker remembers at most beyond the current piece.
_KNOWN, _KNOWN_BYTES = 1_200_000, 24 << 20


class WordEncoder:
    """Ids of whole texts by the tokenizers library, which sees each distinct blank-separated word once as long as it is
    remembered. Right for tokenizers that split at ASCII blanks and drop them and fold ASCII case, as the probe confirms.

    A word that is a letter and then one comma or full stop is looked up as the two; no pre-token spans that border.
    """

    def __init__(self, json: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(json)
        suffix = self.tokenizer.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        probe = ["a b", "A\tb's \n c1 ", " x", "don't  stop\r\nhere\x0b!\x0cé", "Ab, cD. E'S,"]
        for text in probe:
            parts = [p for w in text.lower().split() for p in ((w[:-1], w[-1]) if w[-1] in ",." and w[-2:-1].isalpha() else (w,))]
            if self._ids([text])[0].ids != sum((x.ids for x in self._ids(parts)), []):
                raise ValueError("this tokenizer keeps blanks or case, or joins words and marks")
        self.forget()

    def _ids(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words laid end to end, and where each word's begin (with the end appended). Words of letters alone are one pre-token
        each, so many are encoded as one text and told apart by the tokens that end a word."""
        alone = [i for i, w in enumerate(words) if not w.isalpha()]
        plain = [w for w in words if w.isalpha()]
        texts = [" ".join(plain[i : i + _TOGETHER]) for i in range(0, len(plain), _TOGETHER)]
        ids = [np.array(e.ids, np.uint32) for e in self._ids(texts)]
        ids = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        ends = np.flatnonzero(self.is_end[ids])
        if len(ends) != len(plain):  # a letter that the tokenizer doesn't count as one
            alone, plain, ids, ends = list(range(len(words))), [], ids[:0], ends[:0]
        single = [e.ids for i in range(0, len(alone), 20_000) for e in self._ids([words[k] for k in alone[i : i + 20_000]])]
        size = np.zeros(len(words), np.int64)
        size[alone] = [len(x) for x in single]
        joined = np.ones(len(words), bool)
        joined[alone] = False
        size[joined] = np.diff(ends, prepend=-1)
        out = np.zeros(int(size.sum()), np.uint32)
        which = np.repeat(joined, size)
        out[which] = ids
        out[~which] = np.fromiter((i for x in single for i in x), np.uint32)
        return out, np.r_[0, np.cumsum(size)]

    def forget(self) -> None:
        self.known = common.Numbered({b" end": 0, b",": 1, b".": 2})
        self.known_bytes = 0
        self.marks = [[END_ID], *(e.ids for e in self._ids([",", "."]))]
        self.size = np.array([len(x) for x in self.marks])
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.array(sum(self.marks, []), np.uint32)

    def learn(self, words: list[bytes]) -> None:
        """Append the ids of words, the numbers of which follow on from those there are; and of stems that they need and that are new."""
        number, old = self.known, len(self.size)
        marked = [(k, number[w[:-1]], 1 if w.endswith(b",") else 2) for k, w in enumerate(words) if w[-1:] in (b",", b".") and b"a" <= w[-2:-1] <= b"z"]
        words += list(islice(reversed(number), len(number) - old - len(words)))[::-1]
        done = {k for k, _, _ in marked}
        rest = [k for k in range(len(words)) if k not in done]
        sizes = np.zeros(len(words), np.int64)
        flat, place = self._ids_of([words[k].decode() for k in rest])
        sizes[rest] = np.diff(place)
        begin = np.zeros(len(words), np.int64)
        begin[rest] = len(self.flat) + place[:-1]
        every = np.concatenate([self.flat, flat])
        own = np.array([k for k, _, _ in marked], np.int64)
        stem = np.array([x for _, x, _ in marked], np.int64)
        mark = np.array([x for _, _, x in marked], np.int64)
        start, size = np.r_[self.start, begin], np.r_[self.size, sizes]
        # a marked word's ids are its stem's and then the mark's, copied behind all others
        both = np.stack([stem, mark], axis=1).reshape(-1)
        n = size[both]
        total = np.r_[0, np.cumsum(n)]
        extra = every[np.repeat(start[both] - total[:-1], n) + np.arange(total[-1])]
        start[old + own] = len(every) + total[:-1:2]
        size[old + own] = n[::2] + n[1::2]
        self.flat, self.start, self.size = np.concatenate([every, extra]), start, size
        self.known_bytes += sum(map(len, words))

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, END_ID after each, and where each text's begin (with the end appended)."""
        if len(self.known) > _KNOWN or self.known_bytes > _KNOWN_BYTES:
            self.forget()
        number, old = self.known.__getitem__, len(self.known)
        parts: list[np.ndarray] = []
        end = np.zeros(1, np.int64)
        for text in texts:
            if text:
                words = (text if b"<|" in text else text.lower()).split()
                parts.append(np.fromiter(map(number, words), np.int64, len(words)))
            else:
                parts.append(end[:0])
            parts.append(end)
        if len(self.known) > old:
            self.learn(list(islice(reversed(self.known), len(self.known) - old))[::-1])
        w = np.concatenate(parts) if parts else end[:0]
        size = self.size[w]
        total = np.r_[0, np.cumsum(size)]
        ids = self.flat[np.repeat(self.start[w] - total[:-1], size) + np.arange(total[-1])]
        per = np.fromiter(map(len, parts), np.int64, len(parts)).reshape(-1, 2).sum(1)
        return ids, total[np.r_[0, np.cumsum(per)]]


def encoder_of(json: str) -> WordEncoder:
    return common.only("words", hash(json), lambda: WordEncoder(json))


def code_lengths(counts: np.ndarray, most: int = MOST_BITS) -> np.ndarray:
    """Optimal code lengths of at most `most` bits (package-merge) for positive counts."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    most = max(most, int(n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.int64)
    leaves, merged = [], weights
    for _ in range(most - 1):
        even = merged[: len(merged) // 2 * 2]
        both = np.concatenate([weights, even[::2] + even[1::2]])
        sort = np.argsort(both, kind="stable")
        leaves.append(sort < n)
        merged = both[sort]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in leaves[::-1]:
        own = int(leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    lengths[:take] += 1
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """The canonical code of ids and lengths."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        order = np.lexsort((ids, lengths))
        self.ids, size = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        self.bits = int(size.max()) if len(size) else 1
        span = np.int64(1) << (self.bits - size)
        first = np.cumsum(span) - span
        top = int(self.ids.max()) + 1 if len(size) else 0
        self.word, self.size = np.zeros(top, np.uint64), np.zeros(top, np.int64)
        self.word[self.ids] = (first >> (self.bits - size)).astype(np.uint64)
        self.size[self.ids] = size
        self.symbol = np.zeros(1 << self.bits, np.uint32)
        self.used = np.ones(1 << self.bits, np.uint8)
        filled = int(span.sum())
        self.symbol[:filled] = np.repeat(self.ids, span)
        self.used[:filled] = np.repeat(size, span)

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of the ids and the offset at every STEP-th."""
        size = self.size[ids]
        at = np.cumsum(size) - size
        words = np.zeros(int(at[-1] + size[-1]) // 32 + 3, np.uint32)
        wide = self.word[ids] << (64 - (at & 31) - size).astype(np.uint64)
        slot = at >> 5
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        words[slot[first]] |= np.bitwise_or.reduceat((wide >> np.uint64(32)).astype(np.uint32), first)
        words[slot[first] + 1] |= np.bitwise_or.reduceat(wide.astype(np.uint32), first)
        return words.astype(">u4").tobytes(), at[::STEP]

    def unpack(self, data: bytes, marks: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """The ids behind bit offsets, `steps` from each (at most STEP), laid end to end."""
        view = np.ndarray((max(1, len(data) - 3),), ">u4", data, strides=(1,))
        order = np.argsort(-steps, kind="stable")
        pos, sorted_steps = marks[order].astype(np.int64), steps[order]
        live = np.searchsorted(-sorted_steps, -np.arange(int(sorted_steps[0]) if len(steps) else 0), side="left")
        out = np.zeros((len(live), len(marks)), np.uint32)
        low = np.uint32((1 << self.bits) - 1)
        for t, n in enumerate(live):
            p = pos[:n]
            got = (view[p >> 3].astype(np.uint32) >> (32 - self.bits - (p & 7)).astype(np.uint32)) & low
            out[t, :n] = self.symbol[got]
            p += self.used[got]
        back = np.empty(len(marks), np.int64)
        back[order] = np.arange(len(marks))
        total = np.cumsum(steps)
        lane = np.repeat(back, steps)
        return out[np.arange(int(total[-1]) if len(total) else 0) - np.repeat(total - steps, steps), lane]


def raw_ids(docs: DataFrame, tokenizer_json: str, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n, ids (little-endian; two bytes each, four where an id needs them: wide) and tie (a hash of ids, and a number of the row)."""
    spark = docs.sparkSession
    common.ship(spark)
    sent = spark.sparkContext.broadcast(tokenizer_json)  # bounded by the vocabulary
    frame = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("doc_id", frame.schema["doc_id"].dataType), T.StructField("n", T.LongType()), T.StructField("wide", T.BooleanType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder_of(sent.value)
        for batch in common.pieces(batches, "text", _PIECE):
            ids, start = coder.encode(common.texts_of(batch, "text"))
            wide = len(ids) > 0 and int(ids.max()) > 0xFFFF
            width, data = (4, ids.astype("<u4").tobytes()) if wide else (2, ids.astype("<u2").tobytes())
            cuts = (start * width).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(start)), pa.array([wide] * batch.num_rows), pa.array([data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())], names=schema.names)

    tie = F.struct(F.xxhash64("ids").alias("hash"), F.monotonically_increasing_id().alias("row"))  # fixed once the table is written
    return frame.mapInArrow(run, schema).withColumn("tie", tie)


def _as_ids(wide: bool, data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4" if wide else "<u2")


def global_counts(raw: DataFrame) -> dict[int, int]:
    """How often each id occurs; at most the vocabulary's size of rows reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for wide in (False, True):
                data = b"".join(x for x, w in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True) if w == wide)
                if data:
                    got = np.bincount(_as_ids(wide, data))
                    size = max(len(got), len(total))
                    total = np.pad(total, (0, size - len(total))) + np.pad(got, (0, size - len(got)))
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    return {r["id"]: r["n"] for r in raw.select("wide", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()}


def _blocks(raw: DataFrame, lengths: dict[int, int]) -> DataFrame:
    spark = raw.sparkSession
    sent = spark.sparkContext.broadcast(lengths)
    id_type = raw.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("doc_ids", T.ArrayType(id_type)), T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("bits", T.BinaryType()), T.StructField("marks", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(np.array(list(sent.value), np.int64), np.array(list(sent.value.values()), np.int64))
        part = TaskContext.get().partitionId()
        docs: list = []
        held: list[np.ndarray] = []
        block, start, size = 0, 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal block, start, size
            bits, marks = code.pack(np.concatenate(held).astype(np.int64))
            counts = [len(x) for x in held]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(batch.schema.field("doc_id").type), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64())]
            row = [[part], [block], [start], [list(docs)], [counts], [bits], [marks]]
            block, start, size = block + 1, start + size, 0
            docs.clear()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types, strict=True)], names=schema.names)

        for batch in batches:
            for doc, wide, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                docs.append(doc)
                held.append(_as_ids(wide, data))
                size += len(held[-1])
                if size >= BLOCK:
                    yield flush()
        if docs:
            yield flush()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "n", "tie.hash", "tie.row"]  # no id, and no group of equal rows, is bound to one part
    ordered = raw.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return ordered.select("doc_id", "wide", "ids").mapInArrow(run, schema)


def write(docs: DataFrame, tokenizer_json: str, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the token files of docs below path."""
    spark = docs.sparkSession
    raw, raw_path = common.materialize(raw_ids(docs, tokenizer_json, id_col, text_col), "raw-ids")
    counts = global_counts(raw)
    ids = np.array(sorted(counts), np.int64)
    lengths = dict(zip(ids.tolist(), code_lengths(np.array([counts[i] for i in ids.tolist()], np.int64)).tolist(), strict=True))
    spark.createDataFrame(list(lengths.items()), "id long, length long").coalesce(1).write.parquet(f"{path}/code")
    _blocks(raw, lengths).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    done = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("tokens"))
    done.coalesce(1).write.parquet(f"{path}/parts")
    common.discard(spark, raw_path)


def read(spark: SparkSession, path: str, output: str = "ids") -> DataFrame:
    """doc_id, start, n_tokens and ids (array<int>), or ids_crc32 for output "digest", from token files."""
    common.ship(spark)
    lengths = {r["id"]: r["length"] for r in spark.read.parquet(f"{path}/code").collect()}  # bounded by the vocabulary
    base, before = {}, 0
    for r in spark.read.parquet(f"{path}/parts").orderBy("part").collect():  # one row a file
        base[r["part"]], before = before, before + r["tokens"]
    sent = spark.sparkContext.broadcast((lengths, base))
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "start", "doc_ids", "counts", "marks", "bits")
    schema = T.StructType([T.StructField("doc_id", blocks.schema["doc_ids"].dataType.elementType), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()) if output == "digest" else T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, base = sent.value
        code = Code(np.array(list(lengths), np.int64), np.array(list(lengths.values()), np.int64))
        for whole in batches:
            lanes = np.cumsum([len(x) for x in whole.column(4)])
            cuts = np.flatnonzero(np.r_[True, lanes[1:] // _LANES != lanes[:-1] // _LANES]).tolist()
            for a, b in zip(cuts, [*cuts[1:], whole.num_rows], strict=True):
                batch = whole.slice(a, b - a)
                data = batch.column(5).to_pylist()
                bit = np.cumsum([0, *(8 * len(x) for x in data)])
                counts = [np.array(x, np.int64) for x in batch.column(3).to_pylist()]
                marks = [np.array(x, np.int64) + o for x, o in zip(batch.column(4).to_pylist(), bit, strict=False)]
                steps = [np.minimum(STEP, c.sum() - STEP * np.arange(len(m))) for c, m in zip(counts, marks, strict=True)]
                ids = code.unpack(b"".join(data) + b"\0" * 8, np.concatenate(marks), np.concatenate(steps))
                n = np.concatenate(counts)
                ends = np.cumsum(n)
                start = np.concatenate([base[p] + s + np.cumsum(c) - c for p, s, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), counts, strict=True)])
                raw = memoryview(ids.astype("<u4").tobytes())
                if output == "digest":
                    last = pa.array([zlib.crc32(raw[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), n.tolist(), strict=True)], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(2).flatten(), pa.array(start), pa.array(n), last], names=schema.names)

    return blocks.mapInArrow(run, schema)


def op7_token_file(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        json = f.read()
    path = common.new_path(spark, "token-files")
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), json, path)
    return read(spark, path, output="digest")
