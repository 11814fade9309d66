"""Language ID by cross-parsing entropy.

Each language has a suffix automaton of a sample of its labelled text. A document is parsed greedily into phrases, each
the longest match that continues in the language's sample; the phrases a text needs, times the bits that one pointer
into the sample costs, over the letters of the text, estimate the cross entropy. The language with the fewest
normalised phrases wins.

Defined cases. Null, empty or letterless text: `und`, score 0. No labelled row at all: every text is `und`. An empty table gives an empty result. Ties: the
language with more labelled documents, then the smaller name. Long texts are read whole and parsed as one: blocks
of BLOCK symbols run side by side, but phrases cross them. Repeated rows, null ids and
extra columns (also of our columns' names) make no difference: a prediction depends on the text alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraline.llm import common

#: Bound of the training sample: so many characters for each language at most.
SAMPLE_CHARS = 60_000
#: And so many labelled documents, from which those characters are taken.
SAMPLE_DOCS = 400
#: Symbols that are parsed side by side with others; it changes no result.
BLOCK = 512
UND = "und"
_NOISE = re.compile(r"[\W\d_]+")
_BATCH = 4 << 20
_PHRASE = np.int32(-(1 << 31))
_STATE = np.int32((1 << 31) - 1)


def normalise(text: str | None) -> bytes | None:
    """Lower-cased words joined by single blanks, as UTF-8; None where no letter is left."""
    if not text:
        return None
    words = _NOISE.sub(" ", text.lower()).strip()
    return words.encode() if any(map(str.isalpha, words)) else None


class SuffixAutomaton:
    """Blumer's on-line construction; states are numbered from 0, the root."""

    def __init__(self, data: bytes) -> None:
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        nxt = self.next
        for c in data:
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(nxt[q].copy())
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and nxt[p].get(c) == q:
                        nxt[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur

    def table(self, codes: np.ndarray, width: int) -> np.ndarray:
        """Dense transitions, states premultiplied by width. Where a match can't go on, a phrase ends (sign bit) and the next begins with this symbol."""
        out = np.zeros((len(self.next), width), np.int32)
        for s, moves in enumerate(self.next):
            for c, to in moves.items():
                out[s, codes[c]] = to * width
        known = out != 0
        root = out[0].copy()
        out[1:] = np.where(known[1:], out[1:], root | _PHRASE)
        out[0, ~known[0]] = _PHRASE
        return out.reshape(-1)


class Model:
    """Automata of all languages over one alphabet of UTF-8 bytes."""

    def __init__(self, samples: list[tuple[str, int, bytes]]) -> None:
        samples = sorted(samples, key=lambda x: (-x[1], x[0]))
        self.langs = [x[0] for x in samples]
        used = sorted(set(b"".join(x[2] for x in samples)))
        self.codes = np.zeros(256, np.uint8 if len(used) < 255 else np.uint16)
        self.codes[used] = np.arange(1, len(used) + 1)
        self.width = len(used) + 1
        self.tables = [SuffixAutomaton(x[2]).table(self.codes, self.width) for x in samples]
        self.bits = np.array([np.log2(max(len(x[2]), 2)) for x in samples])

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each text by each language. All blocks of all texts are parsed in lock step from the root; then each block is
        parsed again from the state in which the block before it ended, until both parses stand in one state, from where they are alike.
        A block whose parses never meet hands a new state on, which `carry` follows. So phrases cross blocks, and BLOCK changes no result."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        flat = self.codes[np.frombuffer(b"".join(texts), np.uint8)]
        blocks = -(-lengths // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = (np.cumsum(lengths) - lengths)[owner] + within * BLOCK
        size = np.minimum(BLOCK, lengths[owner] - within * BLOCK)
        order = np.argsort(-size, kind="stable")
        begin, longest = start[order], size[order]
        live = np.searchsorted(-longest, -np.arange(longest[0] if len(longest) else 0), side="left")  # blocks longer than t
        states = np.zeros((len(self.langs), len(owner)), np.int32)
        counts = np.zeros((len(self.langs), len(owner)), np.int32)
        for t, n in enumerate(live):
            symbols = flat[begin[:n] + t].astype(np.int32)
            for table, state, count in zip(self.tables, states, counts, strict=True):
                s = state[:n]
                s += symbols
                got = table.take(s)
                count[:n] -= got >> 31
                np.bitwise_and(got, _STATE, out=s)
        out = np.zeros((len(self.langs), len(texts)))
        for k, table in enumerate(self.tables):
            count, end = np.empty_like(counts[k]), np.empty_like(states[k])
            count[order], end[order] = counts[k], states[k]
            self.carry(table, flat, start, size, within, count, end)
            out[k] = np.bincount(owner, count, minlength=len(texts)) + (lengths > 0)  # the last phrase ends with the text
        return out

    @staticmethod
    def carry(table: np.ndarray, flat: np.ndarray, start: np.ndarray, size: np.ndarray, within: np.ndarray, count: np.ndarray, end: np.ndarray) -> None:
        """Corrects count and end, which blocks have from the root, to what they are from the end of the block before."""
        entry = np.where(within > 0, np.concatenate([[0], end[:-1]]), 0).astype(np.int32)[: len(end)]
        at = np.flatnonzero(entry)
        at = at[np.argsort(-size[at], kind="stable")]
        root, true, t = np.zeros(len(at), np.int32), entry[at], 0
        while len(at):
            ended = np.searchsorted(-size[at], -t, side="left")  # the first of the blocks that have no symbol t
            end[at[ended:]] = true[ended:]
            at, root, true = at[:ended], root[:ended], true[:ended]
            symbols = flat[start[at] + t].astype(np.int32)
            a, b = table.take(root + symbols), table.take(true + symbols)
            count[at] += (a >> 31) - (b >> 31)
            root, true, t = a & _STATE, b & _STATE, t + 1
            apart = root != true
            at, root, true = at[apart], root[apart], true[apart]
        for k in np.flatnonzero((within[1:] > 0) & (entry[1:] != end[:-1])) + 1:  # in order, so that the block before is right
            while k < len(end) and within[k] and entry[k] != end[k - 1]:
                entry[k] = state = int(end[k - 1])
                n, moves = 0, memoryview(table)
                for c in flat[start[k] : start[k] + size[k]].tolist():
                    state = moves[state + c]
                    if state < 0:
                        n, state = n + 1, state & 0x7FFFFFFF
                count[k], end[k] = n, state
                k += 1

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and bits a symbol. The score is the winner's share when each language's likelihood is 2 to minus its bits for a text of 32 symbols at most."""
        clean = [normalise(x) for x in texts]
        there = [i for i, x in enumerate(clean) if x is not None]
        langs, score, rate = [UND] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan)
        if not there or not self.langs:
            return langs, score, rate
        kept = [clean[i] for i in there]
        size = np.fromiter(map(len, kept), np.int64, len(kept))
        per = self.phrases(kept) * self.bits[:, None] / size
        best = per.argmin(0)
        least = per.min(0)
        share = 1 / np.exp2((least - per) * np.minimum(size, 32)).sum(0)
        for i, b, s, r in zip(there, best, share, least, strict=True):
            langs[i], score[i], rate[i] = self.langs[b], s, r
        return langs, score, rate


def model_of(samples: list[tuple[str, int, bytes]]) -> Model:
    """One model for each worker process, built from the samples it was sent."""
    return common.only("langid", hash(tuple(samples)), lambda: Model(samples))


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, int, bytes]]:
    """(language, labelled documents, normalised sample) from a bounded sample: the SAMPLE_DOCS different texts a language with the
    smallest hash, up to SAMPLE_CHARS characters. The document counts cover all rows, copies too. Bounded on the driver by
    languages times the two limits."""
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(F.col("lang").isNotNull() & (F.length(F.trim("text")) > 0)).withColumn("h", F.xxhash64("text"))
    per = rows.groupBy("lang", "h").agg(F.count("*").alias("n")).groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("different")).collect()
    counts, different = {r["lang"]: r["n"] for r in per}, {r["lang"]: r["different"] for r in per}
    if not counts:
        return []

    def smallest(cuts: dict[str, float]) -> list:
        cut = F.lit(None).cast("double")
        for lang, c in cuts.items():
            cut = F.when(F.col("lang") == lang, F.lit(c)).otherwise(cut)
        few = rows.withColumn("place", F.col("h") / F.lit(2.0**64) + F.lit(0.5)).where(F.col("place") <= cut)
        few = few.groupBy("lang", "h", "place").agg(F.min("text").alias("text"))
        order = Window.partitionBy("lang").orderBy("place", "text")
        few = few.select("lang", F.substring("text", 1, SAMPLE_CHARS).alias("text"), F.row_number().over(order).alias("k"), F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
        return few.where((F.col("k") <= SAMPLE_DOCS) & (F.coalesce("before", F.lit(0)) < SAMPLE_CHARS)).select("lang", "k", "text").collect()

    got = smallest({lang: min(1.0, 2.0 * SAMPLE_DOCS / d) for lang, d in different.items()})
    size = {lang: (0, 0) for lang in counts}
    for r in got:
        size[r["lang"]] = (size[r["lang"]][0] + 1, size[r["lang"]][1] + len(r["text"]))
    short = {lang for lang, (k, chars) in size.items() if k < min(SAMPLE_DOCS, different[lang]) and chars < SAMPLE_CHARS}
    if short:
        got = [r for r in got if r["lang"] not in short] + smallest(dict.fromkeys(short, 1.0))
    out = []
    for lang, n in sorted(counts.items()):
        parts = [normalise(r["text"]) for r in sorted((r for r in got if r["lang"] == lang), key=lambda r: r["k"])]
        if sample := b" ".join(x for x in parts if x)[:SAMPLE_CHARS]:
            out.append((lang, n, sample))
    return out


def identify(docs: DataFrame, samples: list[tuple[str, int, bytes]], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns in keep (all by default), lang_pred, score and bits (a symbol; null for `und`)."""
    spark = docs.sparkSession
    common.ship(spark)
    sent = spark.sparkContext.broadcast(samples)
    keep = docs.columns if keep is None else keep
    frame = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("__text"))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits", T.DoubleType())])
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(sent.value)
        for batch in common.pieces(batches, "__text", _BATCH):
            langs, score, rate = model.predict(batch.column(n).to_pylist())
            arrays = [*batch.columns[:n], pa.array(langs, pa.string()), pa.array(score), pa.array(rate, from_pandas=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return frame.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5)) == 0, F.lit(False))


def language_id(docs: DataFrame) -> DataFrame:
    """documents -> doc_id, held_out, lang_pred, score, bits. Learns from the rows that are not held out."""
    samples = learn(docs.where(~held_out() & F.col("doc_id").isNotNull()))
    base = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify(base, samples, keep=["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score", "bits")


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    return language_id(spark.read.parquet(f"{sf_dir}/documents.parquet"))
