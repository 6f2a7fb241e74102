"""Numpy view of Arrow text columns: bytes, word boundaries and 64-bit word hashes.

A batch is cut into blocks of whole rows of about ``BLOCK_BYTES``; a longer
row is a block of its own.  Everything is vectorised over the block, so the
cost is a few nanoseconds a byte whatever the number of distinct words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_MASK = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)

#: Bytes between words: 0x20 and 0x09-0x0D.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, every other byte as it is.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for the next block."""
    key = str(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * BLOCK_BYTES:
            _powers[key] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    bytes_ = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_, offsets


def row_blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [first, last) of rows of at most ``limit`` bytes, or of one longer row."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


class WordBlock:
    """Words of some rows: 64-bit hash and byte span of each, and where each row's words begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True):
        base = int(offsets[0])
        bytes_ = data[base : int(offsets[-1])]
        bounds = (offsets - base).astype(np.int64)
        n = len(bytes_)
        self.rows = len(offsets) - 1
        if n == 0:
            self.hash = np.zeros(0, np.uint64)
            self.starts = self.ends = np.zeros(0, np.int64)
            self.first = np.zeros(self.rows + 1, np.int64)
            return
        word = ~_SPACE[bytes_]
        edge = np.zeros(n + 1, dtype=bool)
        edge[bounds] = True
        start = word.copy()
        start[1:] &= ~word[:-1] | edge[1:n]
        end = word.copy()
        end[:-1] &= ~word[1:] | edge[1:n]
        starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.starts, self.ends = starts, ends
        values = (_LOWER[bytes_] if lower else bytes_).astype(np.uint64)
        values += np.uint64(1)
        values *= _power(_P, n)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values, out=total[1:])
        # The bytes' sum of b[i] * P**i between two positions, moved back to begin at P**0.
        h = (total[ends] - total[starts]) * _power(_P_INV, n)[starts]
        self.hash = mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        self.first = np.searchsorted(starts, bounds).astype(np.int64)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def word_blocks(column: pa.Array, lower: bool = True, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, WordBlock]]:
    data, offsets = text_buffers(column)
    for first, last in row_blocks(offsets, limit):
        yield first, last, WordBlock(data, offsets[first : last + 1], lower)
