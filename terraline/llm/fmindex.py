"""FM-index over integer symbols: wavelet matrix, backward search, location by sampled suffix positions."""

from __future__ import annotations

import numpy as np

from terraline.llm.sais import suffix_array

_ONE = np.uint64(1)


class Bits:
    """A bit vector with ranks: a count for each 64-bit word, the rest by population count."""

    def __init__(self, bits: np.ndarray) -> None:
        self.n = len(bits)
        padded = np.zeros((self.n // 64 + 1) * 64, np.uint8)
        padded[: self.n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])
        self.zeros = self.n - int(self.before[-1])

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & _ONE

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before i."""
        w = i >> 6
        return self.before[w] + np.bitwise_count(self.words[w] & ((_ONE << (i & 63).astype(np.uint64)) - _ONE))


class WaveletMatrix:
    """Rank and access over symbols below 2**levels, one bit vector a level, the highest bit first."""

    def __init__(self, symbols: np.ndarray, sigma: int) -> None:
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits: list[Bits] = []
        for level in range(self.levels - 1, -1, -1):
            b = (symbols >> level) & 1
            self.bits.append(Bits(b))
            symbols = np.concatenate([symbols[b == 0], symbols[b == 1]])
        self.start = np.zeros(1 << self.levels, np.int64)
        counts = np.bincount(symbols, minlength=1 << self.levels)
        where = np.flatnonzero(counts)
        self.start[where] = self._descend(where, np.zeros(len(where), np.int64))

    def _descend(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, v in enumerate(self.bits):
            one = v.rank(i)
            i = np.where((c >> (self.levels - 1 - k)) & 1, v.zeros + one, i - one)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often c stands before i."""
        return self._descend(c, i) - self.start[c]

    def access_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at i and how often it stands before i."""
        c = np.zeros(len(i), np.int64)
        for v in self.bits:
            b = v.get(i).astype(np.int64)
            one = v.rank(i)
            c = (c << 1) | b
            i = np.where(b, v.zeros + one, i - one)
        return c, i - self.start[c]


class FMIndex:
    def __init__(self, symbols: np.ndarray, sigma: int, sample: int = 16) -> None:
        """symbols: from 0, below sigma. Inside, they are one higher, and the end of the text is the only 0."""
        text = np.append(symbols.astype(np.int64) + 1, 0)
        sigma += 1
        sa = suffix_array(text)
        self.n = len(text)
        self.wavelet = WaveletMatrix(text[sa - 1], sigma)
        self.smaller = np.zeros(sigma + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=sigma), out=self.smaller[1:])
        kept = sa % sample == 0
        self.marked = Bits(kept)
        self.positions = sa[kept]

    def search(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-array interval of each pattern (`size` symbols of flat from `start`), by backward search over all of them."""
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.n, np.int64)
        for k in range(int(sizes.max()) if len(sizes) else 0):
            live = np.flatnonzero((sizes > k) & (low < high))
            c = flat[starts[live] + sizes[live] - 1 - k].astype(np.int64) + 1
            low[live] = self.smaller[c] + self.wavelet.rank(c, low[live])
            high[live] = self.smaller[c] + self.wavelet.rank(c, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows: step back until a sampled one."""
        out, rows, steps = np.zeros(len(rows), np.int64), rows.copy(), 0
        live = np.arange(len(rows))
        while len(live):
            hit = self.marked.get(rows).astype(bool)
            out[live[hit]] = self.positions[self.marked.rank(rows[hit])] + steps
            live, rows = live[~hit], rows[~hit]
            c, before = self.wavelet.access_rank(rows)
            rows = self.smaller[c] + before
            steps += 1
        return out
