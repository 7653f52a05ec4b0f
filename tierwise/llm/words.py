"""Words and word windows of many texts at once, as numpy arrays over one UTF-8 buffer.

A word is a longest run of bytes other than space and 0x09 to 0x0D, unless other gaps are given.  All hashes are 64 bits,
the same in every task and on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text looked at together, each of which takes some hundred bytes of arrays meanwhile;
#: one longer text is looked at alone.
SLICE_BYTES = 1 << 19

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII bytes that are neither letters nor digits.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_U = np.uint64


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit over all output bits."""
    with np.errstate(over="ignore"):
        x = (x ^ _U(salt)) * _U(0x9E3779B97F4A7C15)
        x ^= x >> _U(32)
        x *= _U(0xD6E8FEB86659FD93)
        x ^= x >> _U(29)
        return x


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, as far as they were needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (self._run(b, size) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _run(base: int, size: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.cumprod(out)


_BYTE_POWERS = [_Powers(0xA24BAED4963EE407), _Powers(0x9FB21C651E98DF25)]
_WORD_POWERS = [_Powers(0xC2B2AE3D27D4EB4F), _Powers(0x8EBC6AF09C88C6E3)]
_BYTE_VALUES = [mix(np.arange(256, dtype=np.uint64), salt) for salt in (0x5851F42D, 0x14057B7E)]


@dataclass
class Words:
    """``hashes`` of all words; those of text ``i`` are at ``first[i]`` to ``first[i + 1]``."""

    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, k: int, family: int = 0) -> np.ndarray:
        """A hash for each word position of the ``k`` words that start there."""
        n = len(self.hashes)
        up, down = _WORD_POWERS[family].upto(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.hashes * up[:n], out=sums[1:])
        out = np.zeros(n, np.uint64)
        if n >= k:
            out[: n - k + 1] = mix((sums[k:] - sums[: n - k + 1]) * down[: n - k + 1], k)
        return out

    def whole(self, k: int) -> np.ndarray:
        """True at positions where ``k`` words of one text start."""
        out = np.zeros(len(self.hashes) + 1, np.int8)
        long = self.counts >= k
        np.add.at(out, self.first[:-1][long], 1)
        np.add.at(out, self.first[1:][long] - k + 1, -1)
        return np.cumsum(out[:-1]).astype(bool)

    def text_of(self) -> np.ndarray:
        """The number of the text for each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its texts; a null has no bytes."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, ends, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(column: pa.Array, family: int = 0, gaps: np.ndarray = SPACES) -> Words:
    data, offsets = buffers(column)
    n = len(data)
    if not n:
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    gap = gaps[data]
    opens = np.zeros(n, bool)
    opens[offsets[:-1][offsets[:-1] < n]] = True
    opens[1:] |= gap[:-1]
    opens &= ~gap
    starts = np.flatnonzero(opens)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), first)
    up, down = _BYTE_POWERS[family].upto(n)
    value = _BYTE_VALUES[family][data]
    value *= up
    value[gap] = 0
    return Words(mix(np.add.reduceat(value, starts) * down[starts]), first)


def slices(batch: pa.RecordBatch | pa.Table | pa.Array, column: str = "", limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges with about ``limit`` bytes of text each, of a column or of an array of texts."""
    _, offsets = buffers(batch.column(column) if column else batch)
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield low, min(high, n)
        low = high


def sorted_member(keys: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key would stand in ``ordered``, and whether it is there."""
    if not len(ordered):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.searchsorted(ordered, keys)
    at[at == len(ordered)] = 0
    return at, ordered[at] == keys
