"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The distinct pre-tokens of a block of documents form one corpus of linked symbols. An inverted index leads from a pair's merged
rank to the positions where the pair stands; ranks are taken in ascending order, each merge is applied to all its positions
at once, and only the pairs of the touched neighbours are looked up and indexed anew. A pre-token is replayed once for as
long as a worker remembers it; documents gather the ids of their pre-tokens. Nothing is shuffled: a block is a bounded piece of
a task's documents, and the worker's memory of pre-tokens is bounded too.

Defined cases. Null or empty text: no ids. Null ids make no difference. Very long texts are encoded whole. Text is ordinary text throughout; there are no special tokens. Repeated rows are
encoded alike. Pre-tokens may be as long as the text. Columns named like ours are replaced in the result; an empty table
gives an empty result. Decoding any list of ids gives their bytes; an id out of range raises.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraline.llm import common

_BLOCK = 6 << 20
#: Pre-tokens and their bytes that a worker remembers at most beyond the current block.
_KNOWN, _KNOWN_BYTES = 600_000, 24 << 20
_NONE = np.int32(2**31 - 1)


def load_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


@lru_cache
def newer_characters() -> tuple[str, str]:
    """Letters and numbers that the regex module knows and the tiktoken library doesn't (yet), as the insides of character
    classes. The two libraries follow different versions of Unicode; the pattern must split as the latter does."""
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out = []
    for kind in (r"\p{L}", r"\p{N}"):
        plain = tiktoken.Encoding(kind, pat_str=f"{kind}+", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        known = set(plain.decode(plain.encode_ordinary(every)))
        new = sorted(ord(c) for c in set("".join(regex.findall(f"{kind}+", every))) - known)
        ranges: list[list[int]] = []
        for c in new:
            if ranges and c == ranges[-1][1] + 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
        out.append("".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges))
    return out[0], out[1]


class Splitter:
    """findall of the pattern. Texts with a newer character take a pattern whose classes leave those out."""

    def __init__(self, pattern: str, newer: tuple[str, str]) -> None:
        self.plain = regex.compile(pattern).findall
        self.rare = self.exact = None
        if any(newer):
            self.rare = re.compile("[" + "".join(newer) + "]").search
            for kind, new in zip((r"\p{L}", r"\p{N}"), newer, strict=True):
                pattern = pattern.replace(kind, f"[{kind}--[{new}]]" if new else kind)
            self.exact = regex.compile(f"(?V1){pattern}").findall

    def __call__(self, text: str) -> list[str]:
        if self.rare is not None and not text.isascii() and self.rare(text):
            return self.exact(text)
        return self.plain(text)


class PairTable:
    """(left id, right id) -> id of the two joined; open addressing in numpy arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, int(len(keys) * 6).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NONE, np.int32)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] == -1]
            self.keys[slot[free]] = keys[free]  # where several want one slot the last stays
            done = self.keys[slot[todo]] == keys[todo]
            self.values[slot[todo[done]]] = values[todo[done]]
            todo = todo[~done]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.find((left.astype(np.int64) << 32) | right)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys; _NONE where there is none."""
        slot = self._slot(keys)
        out = np.full(len(keys), _NONE, np.int32)
        seen = self.keys[slot]
        hit = seen == keys
        out[hit] = self.values[slot[hit]]
        live = np.flatnonzero(~hit & (seen != -1))
        while len(live):
            slot[live] = (slot[live] + 1) & ((1 << self.bits) - 1)
            seen = self.keys[slot[live]]
            hit = seen == keys[live]
            out[live[hit]] = self.values[slot[live[hit]]]
            live = live[~hit & (seen != -1)]
        return out


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str, newer: tuple[str, str] = ("", "")) -> None:
        self.find = Splitter(pattern, newer)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        keys, values = [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    keys.append((a << 32) | b)
                    values.append(rank)
        self.pairs = PairTable(np.array(keys, np.int64), np.array(values, np.int32))
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token_size = np.fromiter(map(len, tokens), np.int64, size)
        self.token_start = np.cumsum(self.token_size) - self.token_size
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.used = self.token_size > 0
        self.forget()

    def forget(self) -> None:
        self.known = common.Numbered()
        self.known_bytes = 0
        self.ids = np.zeros(0, np.int32)
        self.start = np.zeros(1, np.int64)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words and where each word's begin (with the end appended)."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        n = int(lengths.sum())
        symbol = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        after = np.arange(1, n + 1, dtype=np.int32)
        after[ends[lengths > 0] - 1] = n  # n: no neighbour
        before = np.arange(-1, n, dtype=np.int32)
        before[(ends - lengths)[lengths > 0]] = n
        rank = np.full(n + 1, _NONE, np.int32)
        inner = np.flatnonzero(after < n)
        rank[inner] = self.pairs.get(symbol[inner], symbol[inner + 1])
        at = np.flatnonzero(rank != _NONE).astype(np.int32)
        at = at[np.argsort(rank[at], kind="stable")]
        first = np.flatnonzero(np.r_[True, np.diff(rank[at]) != 0]) if len(at) else np.zeros(0, np.int64)
        todo = rank[at[first]].tolist()
        index: dict[int, list[np.ndarray]] = {r: [at[i:j]] for r, i, j in zip(todo, first.tolist(), [*first[1:].tolist(), len(at)], strict=True)}
        heapq.heapify(todo)
        while todo:
            r = heapq.heappop(todo)
            parts = index.pop(r)
            p = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            p = p[rank[p] == r]
            if not len(p):
                continue
            chained = p[1:] == after[p[:-1]]
            if chained.any():  # of overlapping pairs every other one, from the left
                k = np.arange(len(p))
                head = np.maximum.accumulate(np.where(np.r_[False, chained], 0, k))
                p = p[(k - head) % 2 == 0]
            second = after[p]
            third = after[second]
            symbol[p] = r
            rank[second] = rank[p] = _NONE
            after[p] = third
            inside = third < n
            before[third[inside]] = p[inside]
            left = before[p]
            left = left[left < n]
            touched = np.concatenate([p[inside], left])
            if not len(touched):
                continue
            new = self.pairs.get(symbol[touched], symbol[after[touched]])
            rank[touched] = new
            found = new != _NONE
            touched, new = touched[found], new[found]
            if len(touched) > 1:
                order = np.argsort(new, kind="stable")
                touched, new = touched[order], new[order]
                cut = np.flatnonzero(new[1:] != new[:-1]) + 1
                bounds = [0, *cut.tolist(), len(new)]
            else:
                bounds = [0, len(new)] if len(new) else [0]
            for i, j in zip(bounds, bounds[1:], strict=False):
                key = int(new[i])
                part = touched[i:j] if j - i == 1 else np.unique(touched[i:j])
                if key in index:
                    index[key].append(part)
                else:
                    index[key] = [part]
                    heapq.heappush(todo, key)
        # tokens never overlap: position i is alive iff no alive position before it spans it; spans of dead ones are stale and
        # lie inside the span of the alive one that swallowed them, so a running maximum of ends finds the alive ones
        reach_end = np.maximum.accumulate(np.arange(n) + self.token_size[symbol]) if n else np.zeros(0, np.int64)
        alive = np.r_[True, reach_end[:-1] <= np.arange(1, n)] if n else np.zeros(0, bool)
        kept = np.flatnonzero(alive)
        return symbol[kept], np.r_[0, np.searchsorted(kept, ends)]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and where each text's begin (with the end appended)."""
        if len(self.known) > _KNOWN or self.known_bytes > _KNOWN_BYTES:
            self.forget()
        known, old = self.known, len(self.known)
        number, parts = known.__getitem__, [np.zeros(0, np.int64)]
        for text in texts:
            words = self.find(text) if text else ()
            parts.append(np.fromiter(map(number, words), np.int64, len(words)))
        if len(known) > old:
            fresh = [w.encode() for w in islice(reversed(known), len(known) - old)][::-1]
            self.known_bytes += sum(map(len, fresh))
            ids, start = self.replay(fresh)
            self.start = np.concatenate([self.start, start[1:] + len(self.ids)])
            self.ids = np.concatenate([self.ids, ids])
        w = np.concatenate(parts)
        size = self.start[w + 1] - self.start[w]
        total = np.r_[0, np.cumsum(size)]
        ids = self.ids[np.repeat(self.start[w] - total[:-1], size) + np.arange(total[-1])]
        return ids, total[np.r_[0, np.cumsum(np.fromiter(map(len, parts[1:]), np.int64, len(texts)))]]

    def decode(self, ids: np.ndarray, start: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of lists of ids laid end to end, and where each list's begin (with the end appended)."""
        if len(ids) and (int(ids.min()) < 0 or int(ids.max()) >= len(self.used) or not self.used[ids].all()):
            raise ValueError("an id that the vocabulary doesn't have")
        size = self.token_size[ids]
        total = np.r_[0, np.cumsum(size)]
        data = self.token_bytes[np.repeat(self.token_start[ids] - total[:-1], size) + np.arange(total[-1])]
        return data.tobytes(), total[start]


def encoder_of(data: bytes, pattern: str, newer: tuple[str, str]) -> Encoder:
    return common.only("bpe", hash((data, pattern, newer)), lambda: Encoder(load_ranks(data), pattern, newer))


def encode(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", keep: list[str] | None = None, output: str = "ids") -> DataFrame:
    """The columns in keep (all by default), n_tokens and, by output, ids (array<int>) and decoded (binary), or for "digest"
    ids_sha256 and decoded_sha256. vocabulary: path, on the driver, of a rank file."""
    spark = docs.sparkSession
    common.ship(spark)
    with open(vocabulary, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())  # bounded by the vocabulary
    newer = newer_characters()
    fields = [T.StructField("n_tokens", T.LongType())]
    if output == "digest":
        fields += [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    else:
        fields += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]
    ours = {f.name for f in fields}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ours]
    frame = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("__text"))
    schema = T.StructType([docs.schema[c] for c in keep] + fields)
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder_of(sent.value, pattern, newer)
        for batch in common.pieces(batches, "__text", _BLOCK):
            ids, start = coder.encode(batch.column(n).to_pylist())
            data, at = coder.decode(ids, start)
            cuts = [(int(a), int(b)) for a, b in zip(start, start[1:], strict=False)]
            sides = [(int(a), int(b)) for a, b in zip(at, at[1:], strict=False)]
            arrays = [pa.array(np.diff(start))]
            if output == "digest":
                raw, view = memoryview(ids.astype("<u4").tobytes()), memoryview(data)
                arrays += [pa.array([hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in cuts]), pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in sides])]
            else:
                arrays += [pa.ListArray.from_arrays(pa.array(start.astype(np.int32)), pa.array(ids)), pa.array([data[a:b] for a, b in sides], pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *arrays], names=schema.names)

    return frame.mapInArrow(run, schema)


def tokenized(docs: DataFrame) -> DataFrame:
    """documents -> doc_id, n_tokens, ids_sha256, decoded_sha256 under the public multilingual vocabulary."""
    import public_tokenizers

    return encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep=["doc_id"], output="digest")


def op4_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return tokenized(spark.read.parquet(f"{sf_dir}/documents.parquet"))
