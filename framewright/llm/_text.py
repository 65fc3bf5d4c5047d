"""Vectorised word handling on Arrow string buffers.

Words are maximal runs without the six ASCII spaces (0x20, 0x09-0x0D).  A batch
is cut into chunks of whole documents of about ``CHUNK_BYTES``, so memory stays
bounded by that size or by the longest single document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so invertible modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_POWERS: dict[str, np.ndarray] = {}


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash pairs of 64-bit values, element by element."""
    x = (a * _U(0x9E3779B97F4A7C15)) ^ (b * _U(0xC2B2AE3D27D4EB4F) + _U(0x165667B19E3779F9))
    x ^= x >> _U(29)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(32)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


@dataclass
class Words:
    """The words of some whole documents: byte offsets into ``data``, the row
    of each word's document, a 64-bit hash, and where each row's words begin."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # rows + 1 entries
    low: int  # rows [low, high) of the batch
    high: int
    total: np.ndarray  # running sums behind the hashes
    lower: bool  # whether data is lower-cased

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges, A-Z lower-cased."""
        up, down = _powers(len(self.data) + 1)
        total = self.total
        if not self.lower:
            total = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_BYTE[LOWER[self.data]] * up[: len(self.data)], out=total[1:])
        return mix((total[end] - total[start]) * down[start], (end - start).astype(np.uint64))

    def joined(self, keep: np.ndarray) -> list[memoryview]:
        """Each row's words for which ``keep`` holds, joined by one space."""
        start, size = self.start[keep], (self.end - self.start)[keep] + 1
        stop = np.cumsum(size)
        n = int(stop[-1]) if len(stop) else 0
        line = np.full(n, 32, np.uint8)
        solid = np.ones(n, bool)
        solid[stop - 1] = False
        held = ~_SPACE[self.data]
        held[held] = np.repeat(keep, self.end - self.start)
        line[solid] = self.data[held]
        first = np.concatenate([[0], np.cumsum(keep)])[self.first]
        cuts = np.concatenate([[0], stop])[first].tolist()
        view = memoryview(line)
        return [view[a : max(a, b - 1)] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def string_parts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string()).cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), off


def spans_of(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows with about ``limit`` bytes each."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def words_of(column: pa.Array | pa.ChunkedArray, lower: bool = False, limit: int = CHUNK_BYTES) -> Iterator[Words]:
    """Cut and hash all words of a string column, chunk by chunk.  ``lower``
    lower-cases A-Z first."""
    data, offsets = string_parts(column)
    for low, high in spans_of(offsets, limit):
        off = offsets[low : high + 1] - offsets[low]
        raw = data[offsets[low] : offsets[high]]
        if lower:
            raw = LOWER[raw]
        n = len(raw)
        solid = ~_SPACE[raw]
        before = np.zeros(n, bool)
        before[1:] = solid[:-1]
        after = np.zeros(n, bool)
        after[:-1] = solid[1:]
        cuts = off[(off > 0) & (off < n)]
        before[cuts] = False
        after[cuts - 1] = False
        start = np.flatnonzero(solid & ~before)
        end = np.flatnonzero(solid & ~after) + 1
        up, down = _powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[raw] * up[:n], out=total[1:])
        hashed = mix((total[end] - total[start]) * down[start], (end - start).astype(np.uint64))
        first = np.searchsorted(start, off)
        row = np.repeat(np.arange(high - low), np.diff(first))
        yield Words(raw, start, end, row, hashed, first, low, high, total, lower)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive values, by doubling; runs may
    cross documents, the caller masks those."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64)
    out, size = hashes, 1
    while 2 * size <= k:
        out = mix(out[:-size], out[size:])
        size *= 2
    if size < k:
        out = mix(out[: len(out) - (k - size)], out[k - size :])
    return out


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost least value in every window of ``width``."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = values[:n].copy(), np.arange(n)
    for j in range(1, width):
        less = values[j : n + j] < best
        best[less] = values[j : n + j][less]
        at[less] = np.flatnonzero(less) + j
    return at
