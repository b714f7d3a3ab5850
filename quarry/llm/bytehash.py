"""Hashes of substrings and words of many texts at once, with numpy.

A text's bytes are mapped to random 64-bit values and summed with powers of an
odd base, modulo 2^64; the hash of any span follows from two prefix sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_rng = np.random.Generator(np.random.PCG64(20240229))
VALUES = _rng.integers(0, 1 << 64, 256, dtype=U)
#: Of words: A-Z as a-z, white space (space, tab to carriage return) as nothing.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
WORD_VALUES = VALUES.copy()
WORD_VALUES[65:91] = VALUES[97:123]
WORD_VALUES[SPACE] = 0
_powers = {"up": np.ones(1, U), "down": np.ones(1, U)}


def powers(n: int, which: str) -> np.ndarray:
    """base^i (``up``) or base^-i (``down``) for i < n."""
    have = _powers[which]
    if len(have) < n:
        base = _BASE if which == "up" else pow(_BASE, -1, 1 << 64)
        more = np.full(max(n, 2 * len(have)), base, U)
        more[0] = 1
        _powers[which] = have = np.multiply.accumulate(more)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, end to end, and
    the offsets of its rows."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


class Spans:
    """Hashes of any spans of ``data``."""

    def __init__(self, data: np.ndarray, values: np.ndarray = VALUES):
        self.sums = np.zeros(len(data) + 1, U)
        np.cumsum(values[data] * powers(len(data), "up") if len(data) else np.empty(0, U), out=self.sums[1:])
        self.down = powers(len(data) + 1, "down")

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(U))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the offsets of the rows' words."""
    n = len(data)
    if not n:
        return np.empty(0, U), np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Spans(data, WORD_VALUES).hash(starts, ends), np.searchsorted(starts, offsets)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``size``-word shingles of each row as sorted hashes, end
    to end, and their offsets. A row of fewer words has one shingle, the whole
    sequence; a row without words has none."""
    hashes, bounds = words(data, offsets)
    counts = np.diff(bounds)
    rows = len(counts)
    per = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    row = np.repeat(np.arange(rows), per)
    at = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per) + bounds[:-1][row]
    end = bounds[1:][row]
    padded = np.concatenate([hashes, np.zeros(size, U)])
    total = np.zeros(len(row), U)
    for k in range(size):
        total = total * U(0xD6E8FEB86659FD93) + np.where(at + k < end, padded[at + k], U(k + 1))
    total = mix(total)
    order = np.lexsort((total, row))
    total, row = total[order], row[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (total[1:] != total[:-1]) | (row[1:] != row[:-1])
    total, row = total[fresh], row[fresh]
    return total, np.searchsorted(row, np.arange(rows + 1))
