"""Telephony audio columns: mu-law, A-law and IMA ADPCM, resampled PCM, and RIFF/WAVE storage.

Companded bytes are expanded by 256-entry tables built from the companding rules. ADPCM blocks are decoded in lock step: one
numpy step decodes the same nibble of every block at hand. PCM is resampled by linear interpolation at rational positions in
integer arithmetic, so results don't depend on the machine.

A text's bytes are stored as an 8 kHz mono mu-law WAVE file in a table of the shared folder, read back from there, expanded and
resampled to 16 kHz.

Defined cases. Null text: no bytes. Very long texts are one file; a batch holds whole files. Null ids are kept as they are. Payloads are padded with zero bytes to a positive multiple of PAD, so an empty one is one
block of zeros. A step index beyond the table counts as its end. Repeated rows and equal texts get equal values. Columns named like
ours are replaced; an empty table gives an empty result. A stored form that is no WAVE file raises.
"""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraline.llm import common

PAD = 64
RATE, OUT_RATE = 8_000, 16_000
MULAW, ALAW, IMA = 7, 6, 0x11
_PIECE = 2 << 20

# Fixed values of IMA ADPCM.
IMA_STEPS = np.array(
    [
        7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118,
        130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060,
        1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132,
        7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
    ],
    np.int32,
)
IMA_INDEX = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2, np.int32)


def mulaw_table() -> np.ndarray:
    u = ~np.arange(256) & 0xFF
    size = ((((u & 15) << 3) + 132) << ((u >> 4) & 7)) - 132
    return np.where(u & 128, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    a = np.arange(256) ^ 0x55
    seg, size = (a >> 4) & 7, (a & 15) << 4
    size = np.where(seg == 0, size + 8, (size + 264) << np.maximum(seg - 1, 0))
    return np.where(a & 128, size, -size).astype(np.int16)


TABLES = {MULAW: mulaw_table(), ALAW: alaw_table()}


def decode_ima(blocks: np.ndarray) -> np.ndarray:
    """(blocks, bytes) -> (blocks, samples): a 4-byte head (first sample, step index, a spare byte), then nibbles, the low one first."""
    head = np.ascontiguousarray(blocks[:, :2]).view("<i2").reshape(-1)
    value = head.astype(np.int32)
    index = np.minimum(blocks[:, 2], len(IMA_STEPS) - 1).astype(np.int32)
    body = np.ascontiguousarray(blocks[:, 4:].T)
    out = np.empty((2 * len(body) + 1, len(blocks)), np.int16)
    out[0] = value
    for k, byte in enumerate(body):
        for half, nibble in enumerate((byte & 15, byte >> 4)):
            step = IMA_STEPS[index]
            delta = step >> 3
            delta += (step >> 2) * (nibble & 1)
            delta += (step >> 1) * ((nibble >> 1) & 1)
            delta += step * ((nibble >> 2) & 1)
            value += np.where(nibble & 8, -delta, delta)
            np.clip(value, -32768, 32767, out=value)
            index += IMA_INDEX[nibble]
            np.clip(index, 0, len(IMA_STEPS) - 1, out=index)
            out[1 + 2 * k + half] = value
    return out.T


def resample(pcm: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Linear interpolation, rounded down, of every row; the last sample holds beyond the end."""
    n = pcm.shape[-1]
    g = math.gcd(rate, to)
    up, down = to // g, rate // g
    at = np.arange(n * up // down, dtype=np.int64) * down
    i, f = at // up, (at % up).astype(np.int32)
    a, b = pcm[..., i].astype(np.int32), pcm[..., np.minimum(i + 1, n - 1)].astype(np.int32)
    return ((a * (up - f) + b * f) // up).astype(np.int16)


def to_wave(payload: bytes, kind: int = MULAW, rate: int = RATE) -> bytes:
    """A mono WAVE file of companded samples (8 bits each)."""
    body = struct.pack("<4sIHHIIHHH4sII4sI", b"fmt ", 18, kind, 1, rate, rate, 1, 8, 0, b"fact", 4, len(payload), b"data", len(payload)) + payload + b"\0" * (len(payload) % 2)
    return b"RIFF" + struct.pack("<I", len(body) + 4) + b"WAVE" + body


def from_wave(media: bytes) -> tuple[int, int, bytes]:
    """Format tag, rate and sample bytes of a WAVE file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at, kind, rate = 12, 0, 0
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            kind, _, rate = struct.unpack_from("<HHI", media, at + 8)
        if name == b"data":
            return kind, rate, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("a WAVE file without data")


def decode(kind: int, payload: bytes, block: int = PAD) -> np.ndarray:
    """PCM of mu-law, A-law or IMA ADPCM bytes."""
    data = np.frombuffer(payload, np.uint8)
    if kind in TABLES:
        return TABLES[kind][data]
    if kind == IMA:
        return decode_ima(data.reshape(-1, block)).reshape(-1)
    raise ValueError(f"format {kind}")


def _power(pcm: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(np.square(pcm, dtype=np.int64), starts)


def features(payloads: list[bytes]) -> tuple[list[str], list[bytes]]:
    """A feature string and 16 kHz PCM of each payload, from all payloads' blocks together."""
    sizes = np.fromiter(map(len, payloads), np.int64, len(payloads))
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(payloads), np.uint8)
    mu, a = TABLES[MULAW][data], TABLES[ALAW][data]
    ima = decode_ima(data.reshape(-1, PAD))
    per = ima.shape[1]
    powers = [_power(mu, starts), _power(a, starts), _power(ima.reshape(-1), starts // PAD * per)]
    turns = np.zeros(len(data), np.int64)
    turns[1:] = (mu[1:] < 0) != (mu[:-1] < 0)
    turns[starts] = 0
    turns = np.add.reduceat(turns, starts)
    wide = [resample(mu[s : s + n], RATE, OUT_RATE).astype("<i2").tobytes() for s, n in zip(starts, sizes, strict=True)]
    names = []
    for i, n in enumerate(sizes.tolist()):
        rms = [math.isqrt(int(p[i]) // m) for p, m in zip(powers, (n, n, n // PAD * per), strict=True)]
        names.append(f"mulaw_rms={rms[0]};alaw_rms={rms[1]};ima_rms={rms[2]};crossings={turns[i]};pcm_crc32={zlib.crc32(wide[i]):08x}")
    return names, wide


_FIELDS = [("payload_bytes", "long"), ("payload_sha256", "string"), ("tail_crc32", "long"), ("media_bytes", "long"), ("media_sha256", "string"), ("feature", "string")]


def store_media(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """The columns in keep (all by default) as a struct row, n_bytes and media (a WAVE file of the text's padded bytes), as a table in
    the shared folder, and its path."""
    common.ship(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    frame = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text_col).alias("text"))
    schema = T.StructType([frame.schema["row"], T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.pieces(batches, "text", _PIECE):
            texts = [x or b"" for x in common.texts_of(batch, "text")]
            media = [to_wave(x + b"\0" * (-len(x) % PAD or (0 if x else PAD))) for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in texts], pa.int64()), pa.array(media, pa.binary())], names=schema.names)

    return common.materialize(frame.mapInArrow(run, schema), "media")


def media_columns(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, with_data: bool = True) -> DataFrame:
    """The columns in keep (all by default), n_bytes and the measures of the stored files as they are read back, and for with_data
    the file (media) and its resampled pcm. Writes the files first."""
    kinds = {"long": T.LongType(), "string": T.StringType()}
    fields = [T.StructField(n, kinds[k]) for n, k in _FIELDS] + [T.StructField(n, T.BinaryType()) for n in ("media", "pcm") if with_data]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in {"n_bytes", *(f.name for f in fields)}]
    stored, _ = store_media(docs, text_col, keep)
    schema = T.StructType([stored.schema["row"], stored.schema["n_bytes"], *fields])
    types = [pa.int64() if f.dataType == T.LongType() else pa.string() if f.dataType == T.StringType() else pa.binary() for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.pieces(batches, "media", _PIECE):
            media = batch.column(2).to_pylist()
            back = [from_wave(m)[2] for m in media]
            names, wide = features(back)
            columns = [
                [len(x) for x in back], [hashlib.sha256(x).hexdigest() for x in back], [zlib.crc32(x[-PAD:]) for x in back],
                [len(x) for x in media], [hashlib.sha256(x).hexdigest() for x in media], names, *([media, wide] if with_data else []),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=schema.names)

    return stored.mapInArrow(run, schema).select("row.*", "n_bytes", *[f.name for f in fields])


def op9_telephony(spark, sf_dir: str) -> DataFrame:
    return media_columns(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep=["doc_id"], with_data=False)
