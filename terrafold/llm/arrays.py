"""Words of whole Arrow batches as numpy arrays, and packed rows for exchanging them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one round of array work takes at most, a longer document alone.
ROUND_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)


def lower_table() -> np.ndarray:
    """Maps A-Z to a-z and keeps every other byte."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def spaced_table() -> np.ndarray:
    """True for bytes of words between blanks: everything but 0x20 and 0x09-0x0D."""
    table = np.ones(256, bool)
    table[[9, 10, 11, 12, 13, 32]] = False
    return table


def alnum_table() -> np.ndarray:
    """True for digits, letters and every byte of a character beyond ASCII."""
    table = np.zeros(256, bool)
    table[48:58] = table[65:91] = table[97:123] = table[128:] = True
    return table


def byte_values() -> np.ndarray:
    """A random odd number for each byte, the same everywhere."""
    return np.random.default_rng(20240607).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each row begins; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column) or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def rounds(column: pa.Array, size: int = ROUND_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, bytes and offsets of consecutive rows, about ``size`` bytes at a time."""
    data, offsets = text_bytes(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        end = min(n, max(row + 1, end))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of the first word of each row (one more at the end)."""
    inside = table[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    rows = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[rows] = inside[rows]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    closes[last] = inside[last]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class WordHasher:
    """64-bit hashes of words, equal for equal bytes in every task."""

    def __init__(self) -> None:
        self.values = byte_values()
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            size = max(len(data) + 1, ROUND_BYTES + 1)
            self.up, self.down = powers(_BASE, size), powers(_UNBASE, size)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], dtype=np.uint64, out=total[1:])
        return mixed((total[ends] - total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def joined_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive words, by the first one's number."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total *= np.uint64(0xD6E8FEB86659FD93)
        total += words[i : len(words) - n + 1 + i]
    return mixed(total + np.uint64(n))
