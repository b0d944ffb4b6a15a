"""Texts of Arrow batches as byte arrays: slices, words and hashes in whole-array steps.

Nothing here makes a Python object per word. Hashes are 64-bit and depend on the bytes
alone, so every task gives the same value for the same text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 1 << 20
_STEP = U64(0x9E3779B97F4A7C15)
_BASE = U64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """The SplitMix64 finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE_VALUES = mix((np.arange(256, dtype=U64) + U64(1)) * _STEP)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of words that end at ASCII white space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words of ASCII letters, digits and all that is not ASCII.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x41:0x5B] = ALPHANUMERIC[0x61:0x7B] = True
ALPHANUMERIC[0x80:] = True


class _Powers:
    """Powers of the hash base and of its inverse, grown as needed, one table a process."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES)
            inverse = U64(pow(int(_BASE), -1, 1 << 64))
            self.up, self.down = (self._table(x, size) for x in (_BASE, inverse))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _table(base: np.uint64, n: int) -> np.ndarray:
        table = np.full(n, base, dtype=U64)
        table[0] = 1
        return np.multiply.accumulate(table)


_POWERS = _Powers()


class RollingHash:
    """Hashes of any substrings of ``data`` from prefix sums of byte value times power."""

    def __init__(self, data: np.ndarray, values: np.ndarray = _BYTE_VALUES) -> None:
        up, self._down = _POWERS.get(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum(values[data] * up[: len(data)], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self._sums[end] - self._sums[start]) * self._down[start]
        return mix(raw + (end - start).astype(U64) * _STEP)

    def every(self, length: int) -> np.ndarray:
        """The hash of each substring of ``length`` bytes, by start."""
        n = len(self._sums) - length
        if n <= 0:
            return np.zeros(0, dtype=U64)
        raw = (self._sums[length:][:n] - self._sums[:n]) * self._down[:n]
        return mix(raw + np.array([length], dtype=U64) * _STEP)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and its row offsets; null is empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    elif pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    if data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8), starts


def slices(
    column: pa.Array, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows of about ``limit`` bytes."""
    data, starts = bytes_of(column)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(starts, starts[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), len(column))
        yield (
            low,
            high,
            data[starts[low] : starts[high]],
            starts[low : high + 1] - starts[low],
        )
        low = high


@dataclass
class Words:
    """Words of a slice in order: bounds in its bytes, row, hash of the lower-cased bytes."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    #: Where each row's words start in these arrays, one more than there are rows.
    bounds: np.ndarray


def words(
    data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, *, lower: bool = True
) -> Words:
    """Maximal runs of bytes of ``kind`` that don't cross rows. Long rows go in pieces."""
    starts, ends, hashes = [], [], []
    low = 0
    while low < len(data):
        high = _piece_end(data, low, kind)
        piece = data[low:high]
        start, end = word_bounds(piece, offsets, low, kind)
        rolling = RollingHash(_LOWER[piece] if lower else piece)
        hashes.append(rolling.of(start, end))
        starts.append(start + low)
        ends.append(end + low)
        low = high
    start, end = (_joined(x, np.int64) for x in (starts, ends))
    bounds = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    return Words(start, end, row, _joined(hashes, U64), bounds)


def word_bounds(
    piece: np.ndarray, offsets: np.ndarray, low: int, kind: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``piece``, which begins at ``low`` of its slice."""
    inside = np.zeros(len(piece) + 2, dtype=bool)
    inside[1:-1] = kind[piece]
    rises, falls = inside[1:] & ~inside[:-1], ~inside[1:] & inside[:-1]
    edge = offsets[np.searchsorted(offsets, low) :] - low
    edge = np.unique(edge[edge < len(piece)])
    meets = edge[inside[edge] & inside[edge + 1]]
    rises[meets] = True
    falls[meets] = True
    return np.flatnonzero(rises), np.flatnonzero(falls)


def _piece_end(data: np.ndarray, low: int, kind: np.ndarray) -> int:
    """An end after ``low`` that cuts no word, near two slices' bytes on."""
    limit = 2 * SLICE_BYTES
    high = min(low + limit, len(data))
    while high < len(data):
        gap = np.flatnonzero(~kind[data[max(low, high - 65536) : high]])
        if len(gap):
            return max(low, high - 65536) + int(gap[-1]) + 1
        high = min(high + 65536, len(data))
    return high


def _joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype=kind)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values, by the first of them."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    done = 1
    least = values
    while done * 2 <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    return np.minimum(least[:n], least[width - done : width - done + n])
