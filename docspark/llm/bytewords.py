"""Words and their 64-bit hashes for a whole block of texts at once, in numpy.

An Arrow string column is one byte buffer. Word bounds and hashes are found for
all texts of a block together, so that no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once. Larger texts make a block of their own.
BLOCK_BYTES = 1 << 19

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@dataclass
class Block:
    """Rows ``first`` to ``first + len(valid)`` of a batch: their bytes, bounds and null mask."""

    first: int
    data: np.ndarray
    bounds: np.ndarray
    valid: np.ndarray

    def __len__(self) -> int:
        return len(self.valid)

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column into runs of rows of about ``limit`` bytes. A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    valid = np.asarray(column.is_valid())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        stop = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1)
        stop = min(stop, n)
        lo, hi = bounds[first], bounds[stop]
        yield Block(first, raw[lo:hi], bounds[first : stop + 1] - lo, valid[first:stop])
        first = stop


@lru_cache(maxsize=8)
def _table(seed: int, fold: bool) -> np.ndarray:
    """A random 64-bit value per byte; with ``fold`` A-Z have those of a-z."""
    values = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if fold:
        values[65:91] = values[97:123]
    return values


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int, base: np.uint64) -> np.ndarray:
    """Powers 0 to n of ``base`` modulo 2**64, kept and grown as needed."""
    key = str(base)
    have = _POWERS.get(key)
    if have is None or len(have) <= n:
        size = max(n + 1, BLOCK_BYTES // 2)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _POWERS[key] = np.multiply.accumulate(steps)
        if size > 4 * BLOCK_BYTES:  # one very long text must not hold memory for ever
            _POWERS.pop(key)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True, seed: int = 7) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; with ``fold`` A-Z count as a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up = _powers(len(data) + 1, BASE)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_table(seed, fold)[data] * up[: len(data)], out=total[1:])
    down = _powers(len(data) + 1, BASE_INVERSE)
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(block: Block, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of each longest run of bytes for which the table ``inside`` is true."""
    keep = inside[block.data]
    edge = np.zeros(len(keep) + 1, bool)
    edge[block.bounds] = True
    starts = keep.copy()
    starts[1:] &= ~keep[:-1] | edge[1:-1]
    ends = keep.copy()
    ends[:-1] &= ~keep[1:] | edge[1:-1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return np.searchsorted(block.bounds, s, "right") - 1, s, e


def byte_table(*outside: tuple[int, int]) -> np.ndarray:
    """Which bytes belong to words: all but the given closed ranges."""
    table = np.ones(256, bool)
    for lo, hi in outside:
        table[lo : hi + 1] = False
    return table
