"""Token counts by trie-shared dynamic programming under a unigram model.

A pre-token is a run of non-blank bytes with the word mark in front. The pieces are those of a given sentencepiece vocabulary,
which stays as it is; their unigram scores are estimated from the corpus: Spark counts all distinct pre-tokens, each is
segmented on the best path, and a piece's score is the logarithm of its smoothed share of all pieces used. ROUNDS rounds
start from equal scores, that is, from segmentations into the fewest pieces.

Distinct pre-tokens go into a trie over characters. A node's forward score is the best sum of piece scores over all ways to
split the path from the root to it, which only depends on its ancestors; so it is computed once for all pre-tokens that share
the prefix, together with the fewest pieces that reach it (of equal ones the shorter last piece). All nodes of a depth are
computed at once. The count at a pre-token's last node is stored, and a document adds up its pre-tokens' counts.

A character in no piece costs the least score minus 10 and counts as its UTF-8 bytes, as byte fallback would spell it. A
worker's trie covers the pre-tokens of a piece of documents that it doesn't know yet, and it forgets what it knows beyond a
bound, so its memory is bounded; a prefix is then scored again. Only the counts of pre-tokens are shuffled.

Defined cases. Null, empty or blank text: no tokens. Very long texts are read whole; a pre-token of more than
DEEP characters is computed for itself, character by character, by the same rule. Repeated rows count alike. Null ids make no difference. Columns named
like ours are replaced; an empty table gives an empty result, and equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraline.llm import common
from terraline.llm.bpe import PairTable

MARK = "▁"
#: Rounds of estimation, and what is added to each piece's count.
ROUNDS, SMOOTH = 2, 0.5
#: Characters up to which pre-tokens are computed in the trie, depth by depth.
DEEP = 96
_PIECE = 8 << 20
#: Pre-tokens of one trie; pre-tokens, and their bytes, that a worker remembers or counts at most beyond the current piece.
_TRIE = 100_000
_KNOWN, _KNOWN_BYTES = 600_000, 24 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def load_pieces(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    odd = (model.is_control, model.is_unknown, model.is_unused, model.is_byte)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not any(f(i) for f in odd)]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _hash(codes: np.ndarray) -> int:
    h = 0
    for c in codes.tolist():
        h = (h * int(_BASE) + c + 1) % (1 << 64)
    return h


class UnigramTrie:
    """Forward scores of pre-tokens. Pieces are found by 64-bit polynomial hashes of their characters."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.pieces = list(scores)
        self.scores = np.array([*scores.values(), 0.0])
        self.by_name, self.values = {p: i for i, p in enumerate(self.pieces)}, [float(s) for s in scores.values()]
        self.unknown = min(scores.values(), default=0.0) - 10
        keys = np.array([_hash(_codes(p)) for p in self.pieces], np.uint64).view(np.int64)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces have one hash")
        self.table = PairTable(keys, np.arange(len(keys), dtype=np.int32))
        self.lengths = sorted({len(p) for p in self.pieces})
        self.longest = max(self.lengths, default=1)
        self.power = np.array([pow(int(_BASE), k, 1 << 64) for k in range(self.longest + 1)], np.uint64)
        self.forget()

    def forget(self) -> None:
        self.known = common.Numbered()
        self.known_bytes = 0
        self.counts = np.zeros(0, np.int64)

    def forward(self, words: list[str], path: bool = False) -> tuple[np.ndarray, tuple]:
        """Tokens of each word (with its mark), which must be sorted; and, for path, the last node of each word and, for each node, the piece
        that ends there on the best path (-1: none) and the node before it. Node 0 is the root."""
        m = len(words)
        lengths = np.fromiter(map(len, words), np.int64, m)
        flat = _codes("".join(words)).astype(np.int64)
        at = np.cumsum(lengths) - lengths
        top = int(lengths.max()) if m else 0
        node_of = np.zeros(m, np.int64)  # of each word at this depth
        levels: list[tuple[np.ndarray, ...]] = [(np.zeros(1, np.int64), np.zeros(1, np.uint64), np.zeros(1), np.zeros(1, np.int64))]
        bases, pieces, before = [0], [np.full(1, -1, np.int32)], [np.zeros(1, np.int64)]
        total, out, last = 1, np.zeros(m, np.int64), np.zeros(m, np.int64)
        live = np.arange(m)
        for d in range(1, top + 1):
            live = live[lengths[live] >= d]
            key = (node_of[live] << 21) | flat[at[live] + d - 1]
            head = np.r_[True, key[1:] != key[:-1]]
            node_of[live] = np.cumsum(head) - 1
            key = key[head]
            parent, char = key >> 21, key & 0x1FFFFF
            _, up_hash, up_score, up_used = levels[d - 1]
            h = up_hash[parent] * _BASE + char.astype(np.uint64) + np.uint64(1)
            # by one character: its piece, or else its bytes
            found = self.table.find((char.astype(np.uint64) + np.uint64(1)).view(np.int64))
            known = found < len(self.pieces)
            piece = np.where(known, found, -1).astype(np.int32)
            score = up_score[parent] + np.where(known, self.scores[piece], self.unknown)
            used = up_used[parent] + np.where(known, 1, 1 + (char > 0x7F) + (char > 0x7FF) + (char > 0xFFFF))
            back = np.ones(len(key), np.int64)
            anc = parent
            for size in range(2, min(d, self.longest) + 1):
                anc = levels[d - size + 1][0][anc]
                _, old_hash, old_score, old_used = levels[d - size]
                got = self.table.find((h - old_hash[anc] * self.power[size]).view(np.int64))
                k = np.flatnonzero(got < len(self.pieces))
                if not len(k):
                    continue
                s, u = old_score[anc[k]] + self.scores[got[k]], old_used[anc[k]] + 1
                better = (s > score[k]) | ((s == score[k]) & (u < used[k]))
                k, s, u = k[better], s[better], u[better]
                score[k], used[k], piece[k], back[k] = s, u, got[k], size
            levels.append((parent, h, score, used))
            ended = live[lengths[live] == d]
            out[ended] = used[node_of[ended]]
            if path:
                last[ended] = total + node_of[ended]
                origin, left = parent, back - 1
                for up in range(d - 1, max(-1, d - 1 - self.longest), -1):
                    if not left.any():
                        break
                    origin = np.where(left > 0, levels[up][0][np.where(left > 0, origin, 0)], origin)
                    left = np.maximum(left - 1, 0)
                bases.append(total)
                pieces.append(piece)
                before.append(np.array(bases)[d - back] + origin)
            total += len(key)
            if d > self.longest and not path:
                levels[d - self.longest - 1] = None  # type: ignore[assignment]
        return out, (last, np.concatenate(pieces), np.concatenate(before)) if path else ()

    def one(self, word: str, total: np.ndarray | None = None, times: int = 0) -> int:
        """Tokens of one word, character by character; the pieces on its best path are added to total, if there is one, `times` times.

        Scores are kept for as many characters as the longest piece has, and of the path one byte a character, the size of the piece
        that ends there, so a word of many megabytes takes little more than itself."""
        width = self.longest + 1
        scores, counts = [0.0] * width, [0] * width
        back = bytearray(len(word) + 1) if total is not None else None
        find, value = self.by_name.get, self.values
        for j in range(1, len(word) + 1):
            char = word[j - 1]
            p = find(char)
            s, u = scores[(j - 1) % width], counts[(j - 1) % width]
            s, u, best = (s + self.unknown, u + len(char.encode()), 1) if p is None else (s + value[p], u + 1, 1)
            for size in range(2, min(j, self.longest) + 1):
                p = find(word[j - size : j])
                if p is not None:
                    t, v = scores[(j - size) % width] + value[p], counts[(j - size) % width] + 1
                    if t > s or t == s and v < u:
                        s, u, best = t, v, size
            scores[j % width], counts[j % width] = s, u
            if back is not None:
                back[j] = best
        j = len(word)
        while back is not None and j:
            p = find(word[j - back[j] : j])
            if p is not None:
                total[p] += times
            j -= back[j]
        return counts[len(word) % width]

    def count_words(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each pre-token."""
        out = np.zeros(len(words), np.int64)
        for first in range(0, len(words), _TRIE):
            marked = [MARK + w.decode() for w in words[first : first + _TRIE]]
            order = sorted((k for k, w in enumerate(marked) if len(w) <= DEEP), key=marked.__getitem__)
            out[np.array(order, np.int64) + first] = self.forward([marked[k] for k in order])[0]
            for k, w in enumerate(marked):
                if len(w) > DEEP:
                    out[first + k] = self.one(w)
        return out

    def use(self, words: list[bytes], n: np.ndarray) -> np.ndarray:
        """How often each piece is used on the best paths of pre-tokens that occur n times."""
        total = np.zeros(len(self.pieces), np.int64)
        for first in range(0, len(words), _TRIE):
            marked = [MARK + w.decode() for w in words[first : first + _TRIE]]
            order = sorted((k for k, w in enumerate(marked) if len(w) <= DEEP), key=marked.__getitem__)
            at, piece, before = self.forward([marked[k] for k in order], path=True)[1]
            weight = n[np.array(order, np.int64) + first]
            while len(at):
                got = piece[at]
                np.add.at(total, got[got >= 0], weight[got >= 0])
                at = before[at]
                at, weight = at[at > 0], weight[at > 0]
            for k, w in enumerate(marked):
                if len(w) > DEEP:
                    self.one(w, total, n[first + k])
        return total

    def count(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Pre-tokens and tokens of each text."""
        if len(self.known) > _KNOWN or self.known_bytes > _KNOWN_BYTES:
            self.forget()
        number, old = self.known.__getitem__, len(self.known)
        parts = [np.fromiter(map(number, words), np.int64, len(words)) for words in (x.split() if x else [] for x in texts)]
        if len(self.known) > old:
            fresh = list(islice(reversed(self.known), len(self.known) - old))[::-1]
            self.known_bytes += sum(map(len, fresh))
            self.counts = np.concatenate([self.counts, self.count_words(fresh)])
        n = np.fromiter(map(len, parts), np.int64, len(parts))
        return n, np.fromiter((self.counts[p].sum() for p in parts), np.int64, len(parts))


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word (binary) and n for every distinct pre-token of all documents."""
    frame = docs.select(F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total, size = common.Numbered(), np.zeros(0, np.int64), 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(known), pa.binary()), pa.array(total)], names=["word", "n"])

        for batch in common.pieces(batches, "text", _PIECE):
            number = known.__getitem__
            for text in common.texts_of(batch, "text"):
                if not text:
                    continue
                words = text.split()
                got, old = np.fromiter(map(number, words), np.int64, len(words)), len(total)
                if len(known) > old:
                    if len(known) > len(total):
                        total = np.pad(total, (0, max(len(known), 2 * len(total)) - len(total)))
                np.add.at(total, got, 1)
                size += len(text)
            total = total[: len(known)]
            if len(known) > _KNOWN or size > 16 * _KNOWN_BYTES:
                yield flush()
                known, total, size = common.Numbered(), np.zeros(0, np.int64), 0
        if known:
            yield flush()

    return frame.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def estimate(docs: DataFrame, pieces: list[str], text_col: str = "text", rounds: int = ROUNDS) -> dict[str, float]:
    """Unigram scores of the pieces over all documents. Runs jobs; a row a piece reaches the driver."""
    spark = docs.sparkSession
    common.ship(spark)
    scores = dict.fromkeys(pieces, -float(np.log(max(len(pieces), 1))))
    if not pieces:
        return scores
    words, path = common.materialize(word_counts(docs, text_col), "pre-tokens")
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(scores)  # bounded by the vocabulary

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            trie = trie_of(sent.value)
            total = np.zeros(len(trie.pieces), np.int64)
            for batch in common.pieces(batches, "word", _PIECE):
                total += trie.use(batch.column(0).to_pylist(), batch.column(1).to_numpy())
            at = np.flatnonzero(total)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["piece", "n"])

        used = np.zeros(len(pieces))
        for r in words.mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect():
            used[r["piece"]] = r["n"]
        share = np.log(used + SMOOTH) - np.log(used.sum() + SMOOTH * len(pieces))
        scores = dict(zip(pieces, share.tolist(), strict=True))
        sent.destroy()
    common.discard(spark, path)
    return scores


def trie_of(scores: dict[str, float]) -> UnigramTrie:
    return common.only("trie", hash(frozenset(scores.items())), lambda: UnigramTrie(scores))


def count_tokens(docs: DataFrame, scores: dict[str, float], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns in keep (all by default), n_pretokens and n_tokens under the pieces' scores."""
    spark = docs.sparkSession
    common.ship(spark)
    sent = spark.sparkContext.broadcast(scores)  # bounded by the vocabulary
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_pretokens", "n_tokens")]
    frame = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("__text"))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType())])
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = trie_of(sent.value)
        for batch in common.pieces(batches, "__text", _PIECE):
            words, tokens = trie.count(common.texts_of(batch, "__text"))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(words), pa.array(tokens)], names=schema.names)

    return frame.mapInArrow(run, schema)


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, estimate(docs, load_pieces(public_tokenizers.path("piece_bpe_32k.model"))), keep=["doc_id"])
