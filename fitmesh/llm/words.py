"""Words and word n-grams of Arrow text columns as NumPy arrays.

A word is a maximal run of bytes other than space and 0x09-0x0D. Everything works on slices of an Arrow column with
a bounded number of bytes, so memory follows the longest single text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES) + 1
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans ``data[start:end]``; starts and ends ascend. Equal bytes hash alike anywhere."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE_BYTES, "right")))
        low, high = int(starts[i]), int(ends[j - 1])
        up, down = _power(high - low)
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE[data[low:high]] * up[: high - low], out=total[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


@dataclass
class Words:
    """Words of some consecutive rows. ``first[r]:first[r + 1]`` are the words of the r-th row of this slice."""

    row: int  # the first row
    data: np.ndarray  # bytes of all texts
    bounds: np.ndarray  # where each text begins in ``data``; one more at the end
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.first))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of all n-word windows inside one text, where each begins (word index), and ``first`` of them per row."""
        count = np.maximum(np.diff(self.first) - n + 1, 0)
        first = np.concatenate([[0], np.cumsum(count)])
        at = np.repeat(self.first[:-1] - first[:-1], count) + np.arange(first[-1])
        total, factor = np.zeros(len(at), np.uint64), np.uint64(1)
        with np.errstate(over="ignore"):
            for k in range(n):
                total += self.hash[at + k] * factor
                factor *= _GRAM
        return mix(total + np.uint64(n)), at, first


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges with at most ``limit`` bytes; a longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def words(column: pa.Array, lower: bool = False, hashed: bool = True, limit: int = SLICE_BYTES) -> Iterator[Words]:
    data, offsets = text_buffers(column)
    for i, j in slices(offsets, limit):
        low, high = offsets[i], offsets[j]
        part, bounds = data[low:high], offsets[i : j + 1] - low
        if lower:
            part = _LOWER[part]
        inside = ~_SPACE[part]
        cut = np.zeros(len(part) + 1, bool)
        cut[bounds] = True
        before = np.zeros(len(part), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(part), bool)
        after[:-1] = inside[1:]
        start = np.flatnonzero(inside & (~before | cut[:-1]))
        end = np.flatnonzero(inside & (~after | cut[1:])) + 1
        first = np.searchsorted(start, bounds)
        yield Words(i, part, bounds, start, end, first, span_hash(part, start, end) if hashed else np.zeros(0, np.uint64))
