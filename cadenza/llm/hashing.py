"""Vectorised hashes of byte ranges and word ranges over many texts at once.

All texts of a batch lie in one byte buffer; a prefix sum of
``value[byte] * B**i`` (mod 2**64) gives the hash of any byte range with two
lookups, so windows of any length cost the same.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
WORD_STEP = U(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (bijective)."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


@lru_cache(1)
def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U) * U(0xA0761D6478BD642F))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling; kept per worker for usual sizes."""
    key = int(base)
    have = _POWERS.get(key)
    if have is not None and len(have) >= n:
        return have[:n]
    out = np.ones(max(n, 1 << 16), dtype=U)
    done = 1
    step = U(base)
    while done < len(out):
        m = min(done, len(out) - done)
        with np.errstate(over="ignore"):
            out[done:done + m] = out[:m] * step
            step = step * step
        done += m
    if len(out) <= 1 << 19:  # what slices need; a longer single text makes its own
        _POWERS[key] = out
    return out[:n]


class Prefix:
    """Range hashes over a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, base: np.uint64 = BASE):
        n = len(values)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(n + 1, dtype=U)
            np.cumsum(values * powers(base, n), out=self.sums[1:])
            self.back = powers(U(pow(int(base), -1, 1 << 64)), n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of values[start:end], the same wherever the range lies."""
        with np.errstate(over="ignore"):
            h = (self.sums[end] - self.sums[start]) * self.back[start]
            return mix(h + (end - start).astype(U) * U(0x8BB84B93962EACC9))


@dataclass
class Texts:
    """Texts of a batch in one buffer: text i is data[offsets[i]:offsets[i + 1]]."""
    data: np.ndarray
    offsets: np.ndarray


def texts_of(column: pa.Array) -> Texts:
    """The UTF-8 bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pa.compute.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(data, offsets - offsets[0])


@dataclass
class Words:
    """Words of a batch: word w is data[start[w]:end[w]], text i holds words first[i]:first[i + 1]."""
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def words_of(t: Texts, is_gap: np.ndarray) -> Words:
    """Maximal runs of bytes that are no gap; runs never cross texts."""
    n = len(t.data)
    word = ~is_gap[t.data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[t.offsets] = True
    before = np.empty(n, dtype=bool)
    before[:1] = False
    before[1:] = word[:-1]
    start = np.flatnonzero(word & (~before | edge[:n]))
    after = np.empty(n, dtype=bool)
    after[-1:] = False
    after[:-1] = word[1:]
    end = np.flatnonzero(word & (~after | edge[1:])) + 1
    return Words(start, end, np.searchsorted(start, t.offsets))


def white_space() -> np.ndarray:
    """Gap bytes 0x20 and 0x09-0x0D."""
    gap = np.zeros(256, dtype=bool)
    gap[[0x20, *range(0x09, 0x0E)]] = True
    return gap


def lower_ascii() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A"):ord("Z") + 1] += 32
    return table


def word_hashes(t: Texts, w: Words, lower: bool) -> np.ndarray:
    data = lower_ascii()[t.data] if lower else t.data
    return Prefix(byte_values()[data]).of(w.start, w.end)
