"""Vectorised word splitting and hashing of Arrow text columns.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``.  Texts are handled in
blocks of rows whose bytes stay under a limit (one row may exceed it alone), so
the scratch arrays of a task are bounded by the block or by its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# One fixed random number per byte; odd factor for the polynomial.
_TABLE = np.random.Generator(np.random.PCG64(20240607)).integers(0, 2**64, 256, np.uint64)
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 2**64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the row offsets (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    at = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def row_blocks(at: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    first, rows = 0, len(at) - 1
    while first < rows:
        last = int(np.searchsorted(at, at[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, bytewise."""
    return _LOWER[data]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the factor and of its inverse, modulo 2**64."""
    if len(_powers["up"]) < n:
        for key, base in (("up", _FACTOR), ("down", _INVERSE)):
            line = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
            line[0] = 1
            _powers[key] = np.multiply.accumulate(line)
    return _powers["up"][:n], _powers["down"][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of a block of rows: byte ranges, hashes, and the first word of every row."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def split_words(data: np.ndarray, at: np.ndarray) -> Words:
    """Words of the rows ``data[at[i]:at[i + 1]]`` (``at[0]`` is 0)."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    begin = inside[1:-1] & ~inside[:-2]
    stop = inside[1:-1] & ~inside[2:]
    edges = at[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    begin[edges] = inside[1:-1][edges]
    stop[edges - 1] = inside[1:-1][edges - 1]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[:n], out=total[1:])
    hashes = mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    return Words(start, end, hashes, np.searchsorted(start, at))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive words; windows that cross a row are included."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=total[1:])
    return mixed((total[width:] - total[:n]) * down[:n])


def windows_in_rows(first: np.ndarray, width: int) -> np.ndarray:
    """Start positions of the windows of ``width`` words that lie inside one row."""
    counts = np.diff(first)
    free = np.maximum(counts - width + 1, 0)
    total = int(free.sum())
    if not total:
        return np.zeros(0, np.int64)
    base = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(free)[:-1]]), free)
    return base + np.arange(total)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
