"""Words of whole Arrow text columns by array arithmetic, for use in tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes handled at a time; a longer text is a chunk of its own.
CHUNK = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def scramble(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    return h ^ (h >> np.uint64(32))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64: the hash of any
    stretch of bytes is the difference of two running sums times a power."""

    def __init__(self, base: int = _BASE, seed: int = 7):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.codes = scramble((np.arange(256, dtype=np.uint64) + np.uint64(seed)) * np.uint64(base)) \
            | np.uint64(1)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) <= n:
            self.up, self.down = (self._powers(x, max(n + 1, 1 << 16))
                                  for x in (self.base, self.inverse))

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        factors = np.full(n, base, dtype=np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        self.reach(len(data))
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.codes[data] * self.up[:len(data)], out=out[1:])
        return out

    def stretch(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of data[start:end] for arrays of bounds."""
        return (sums[end] - sums[start]) * self.down[start]


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column without nulls, and the bounds of its values."""
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:][:len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)), bounds


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the bounds of its texts; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    return flat_bytes(column.cast(pa.large_binary()))


def chunks(bounds: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``size`` bytes together."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + size, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def spans(data: np.ndarray, bounds: np.ndarray, separator: np.ndarray = _SEPARATOR,
          lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts between ``bounds`` (which starts at 0 in ``data``):
    lower-cased bytes, starts and ends of the words, and the text each is of."""
    data = _LOWER[data] if lower else data
    inside = ~separator[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    begin[edges] = inside[edges]
    starts = np.flatnonzero(begin)
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    last = bounds[1:][bounds[1:] > 0] - 1
    stop[last] = inside[last]
    ends = np.flatnonzero(stop) + 1
    return data, starts, ends, np.searchsorted(bounds, starts, side="right") - 1
