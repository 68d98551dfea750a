"""Words of Arrow text columns as 64-bit numbers, computed on the bytes with numpy.

A word is a run of bytes other than space and 0x09-0x0D; in UTF-8 these bytes are never
part of another character. Its number is a polynomial over the bytes modulo 2^64, mixed
with its length. Equal words have equal numbers everywhere; that two different words of
a corpus of n share one has a chance of about n^2 / 2^65.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute

from starfold.session import ship_by_value

ship_by_value(__name__)

BASE = 0x9E3779B97F4A7C15
STEP = 0xD6E8FEB86659FD93
#: Bytes that are hashed together.
BLOCK = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 on unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(lower: bool) -> np.ndarray:
    """A number for each byte; 0 for white space, upper case as lower case if asked."""
    byte = np.arange(256, dtype=np.uint64)
    if lower:
        byte[65:91] += np.uint64(32)
    value = mixed((byte + np.uint64(1)) * np.uint64(STEP))
    value[[32, 9, 10, 11, 12, 13]] = 0
    return value


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Words:
    """Words of consecutive rows; row i has words first[i] up to first[i + 1]."""

    number: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray

    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, number) of every k consecutive words of one row."""
        n = len(self.number) - k + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        place = np.flatnonzero(np.arange(k, n + k) <= np.repeat(self.first[1:], np.diff(self.first))[:n])
        return place, self.windows_at(place, k)

    def windows_at(self, place: np.ndarray, k: int) -> np.ndarray:
        """Numbers of the k words from each place on; the places must have so many."""
        out = np.zeros(len(place), np.uint64)
        for j in range(k):
            out = out * np.uint64(BASE) + self.number[place + j]
        return mixed(out)


class WordReader:
    """Reads the words of text columns; keeps its tables between calls."""

    def __init__(self, lower: bool = False):
        self.value = _byte_values(lower)
        self.power = _powers(BASE, BLOCK)
        self.inverse = _powers(pow(BASE, -1, 1 << 64), BLOCK)

    def read(self, column: pa.Array) -> Words:
        """Words of a string column; a null is a row without words."""
        column = column.fill_null("").cast(pa.large_string())
        n, buffers = len(column), column.buffers()
        offset = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
        low, high = int(offset[0]), int(offset[-1])
        data = np.frombuffer(buffers[2], np.uint8)[low:high] if high > low else np.empty(0, np.uint8)
        offset = offset - low
        inside = self.value[data] != 0
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        filled = np.diff(offset) > 0  # rows touch each other without a white space between
        begins[offset[:-1][filled]] = inside[offset[:-1][filled]]
        ends[offset[1:][filled] - 1] = inside[offset[1:][filled] - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        return Words(self._numbers(data, start, end), np.searchsorted(start, offset), start, end, data)

    def _numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out, at = np.empty(len(start), np.uint64), 0
        while at < len(start):
            low = int(start[at])
            stop = max(at + 1, int(np.searchsorted(end, low + BLOCK, side="right")))
            size = int(end[stop - 1]) - low
            if size > len(self.power):  # one word longer than a block
                self.power = _powers(BASE, size)
                self.inverse = _powers(pow(BASE, -1, 1 << 64), size)
            terms = self.value[data[low : low + size]] * self.power[:size]
            begin = start[at:stop] - low
            sums = np.add.reduceat(terms, begin) * self.inverse[begin]
            out[at:stop] = mixed(sums + (end[at:stop] - start[at:stop]).astype(np.uint64) * np.uint64(STEP))
            at = stop
        return out


_READERS: dict[bool, WordReader] = {}


def word_reader(lower: bool = False) -> WordReader:
    """A reader that calls in the same task share."""
    if lower not in _READERS:
        _READERS[lower] = WordReader(lower)
    return _READERS[lower]


def slices(batch: pa.RecordBatch, column: int, size: int):
    """The batch in parts of consecutive rows whose texts have about ``size`` bytes."""
    lengths = np.array(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0))
    part = np.cumsum(lengths, dtype=np.int64) // size
    bounds = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *bounds], [*bounds, len(lengths)]):
        if b > a:
            yield batch.slice(a, b - a)
