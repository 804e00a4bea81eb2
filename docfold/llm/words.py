"""Vectorised words, hashes and shingles over Arrow columns of UTF-8 text.

A word is a maximal run of bytes other than space and 0x09-0x0D.  UTF-8 keeps these bytes for ASCII only, so words by
bytes are words by characters.  All work is done piece by piece, so memory beyond the batch itself stays bounded
whatever the length of a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed at once; a piece is longer only if a single word is.
PIECE = 1 << 20
#: Bytes of text that are worked on at once, unless a single text is longer.
SLICE = 1 << 22

_U = np.uint64


def _table(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, n, dtype=np.uint64)


def space_table() -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and n + 1 offsets into them; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE):
    """Parts of a batch, each with at most ``most`` bytes of text or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


class WordHasher:
    """64-bit hashes of words: a sum of random byte values times powers of an odd base, then mixed."""

    def __init__(self, lower: bool = True, seed: int = 11):
        self.space = space_table()
        values = _table(seed, 256)
        self.values = values[lower_table()] if lower else values
        base = int(_table(seed + 1, 1)[0]) | 1
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.powers = self.inverses = np.ones(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, PIECE)
            for name, x in (("powers", self.base), ("inverses", self.inverse)):
                p = np.full(n, x, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of all words, in order; words end where their text does."""
        blank = self.space[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty(len(data), dtype=bool)
        if len(data):
            before[0] = True
            before[1:] = blank[:-1]
        starts = np.flatnonzero(~blank & (before | edge[:-1]))
        after = np.empty(len(data), dtype=bool)
        if len(data):
            after[-1] = True
            after[:-1] = blank[1:]
        ends = np.flatnonzero(~blank & (after | edge[1:])) + 1
        return starts, ends

    def hashes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, start and end of each word, and for each text the number of its first word (n + 1 numbers)."""
        found, first, last = [], [], []
        lo, n = 0, len(data)
        while lo < n:
            hi = min(n, lo + PIECE)
            if hi < n:
                hi = self._cut(data, offsets, lo, hi)
            inside = offsets[np.searchsorted(offsets, lo, "left") : np.searchsorted(offsets, hi, "right")] - lo
            s, e = self.spans(data[lo:hi], inside)
            self._grow(hi - lo + 1)
            sums = np.empty(hi - lo + 1, np.uint64)
            sums[0] = 0
            np.cumsum(self.values[data[lo:hi]] * self.powers[: hi - lo], out=sums[1:])
            found.append(mix((sums[e] - sums[s]) * self.inverses[s] + (e - s).astype(np.uint64)))
            first.append(s + lo)
            last.append(e + lo)
            lo = hi
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        start = np.concatenate(first)
        return np.concatenate(found), start, np.concatenate(last), np.searchsorted(start, offsets, "left")

    def _cut(self, data: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> int:
        """A place for a cut near ``hi`` that splits no word: the end of a text, else a blank."""
        k = np.searchsorted(offsets, hi, "right") - 1
        if offsets[k] > lo:
            return int(offsets[k])
        blanks = np.flatnonzero(self.space[data[lo:hi]])
        if len(blanks) and blanks[-1] > 0:
            return lo + int(blanks[-1])
        end = int(offsets[np.searchsorted(offsets, hi, "left")])
        while hi < end and not self.space[data[hi]]:
            hi += 1
        return hi


def shingle_sets(words: np.ndarray, first: np.ndarray, k: int):
    """For each text the sorted distinct hashes of its ``k``-word shingles; with fewer words, of all its words as one."""
    weights = _table(101, k) | _U(1)
    n = len(words)
    rolled = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k):
        rolled += words[j : n - k + 1 + j] * weights[j]
    rolled = mix(rolled)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= k:
            x = np.sort(rolled[a : b - k + 1])
            keep = np.empty(len(x), dtype=bool)
            keep[0] = True
            np.not_equal(x[1:], x[:-1], out=keep[1:])
            yield x[keep]
        elif b > a:
            yield mix((words[a:b] * weights[: b - a]).sum(dtype=np.uint64, keepdims=True) + _U(b - a))
        else:
            yield np.zeros(0, np.uint64)
