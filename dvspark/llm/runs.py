"""Runs of bytes between separators, by array operations over segments of whole texts, with 64-bit hashes.

A text longer than ``SEGMENT`` is cut behind separators of a given kind, so
memory follows the segment, not the text; only a stretch without any such
separator stays whole however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from dvspark.llm.blocks import mix, text_buffers

SEGMENT = 1 << 21

#: A-Z to a-z, every other byte as it is.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_MASK = (1 << 64) - 1


def byte_table(*members: int | range) -> np.ndarray:
    """Truth table of bytes."""
    table = np.zeros(256, dtype=bool)
    for m in members:
        table[list(m) if isinstance(m, range) else m] = True
    return table


def base(seed: int) -> int:
    """An odd number for the polynomial, another one for each seed."""
    return int(mix(np.array([seed + 1], dtype=np.uint64))[0]) | 5


class Powers:
    """P**0 .. P**(n-1) and the inverse's, modulo 2**64."""

    def __init__(self, seed: int = 0):
        self.p = base(seed)
        self.inverse = pow(self.p, -1, 1 << 64)
        self._up = self._down = np.ones(1, np.uint64)

    def _upto(self, n: int, p: int) -> np.ndarray:
        have = np.full(n, p, dtype=np.uint64)
        have[0] = 1
        return np.multiply.accumulate(have, out=have)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            size = max(SEGMENT, n)
            up, down = self._upto(size, self.p), self._upto(size, self.inverse)
            if size > 4 * SEGMENT:  # for one giant segment: not kept
                return up[:n], down[:n]
            self._up, self._down = up, down
        return self._up[:n], self._down[:n]


@dataclass
class Segment:
    """Runs of a stretch of bytes: where each begins and ends, its row (counted from the batch's first) and its hash."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    hash: np.ndarray


def cuts(data: np.ndarray, offsets: np.ndarray, cut: np.ndarray, limit: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Stretches of about ``limit`` bytes that end with a row, or behind a byte of ``cut`` inside a long row."""
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        last = int(offsets[np.searchsorted(offsets, min(at + limit, end), side="right") - 1])
        if last <= at:  # one row is longer
            row_end = int(offsets[np.searchsorted(offsets, at, side="right")])
            last, step = min(at + limit, row_end), limit
            while last < row_end:
                found = np.flatnonzero(cut[data[max(at, last - step) : last]])
                if len(found):
                    last = max(at, last - step) + int(found[-1]) + 1
                    break
                last, step = min(last + step, row_end), step
        yield at, last
        at = last


def segments(column: pa.Array, separator: np.ndarray, cut: np.ndarray, powers: Powers, limit: int = SEGMENT) -> Iterator[Segment]:
    """The runs of bytes outside ``separator`` of all rows, lower-cased; a null row has none.  ``cut`` is a part of ``separator``."""
    data, offsets = text_buffers(column)
    for first, last in cuts(data, offsets, cut, limit):
        part = _LOWER[data[first:last]]
        n = last - first
        inside = ~separator[part]
        edges = offsets[(offsets > first) & (offsets < last)] - first
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        end = inside.copy()
        end[:-1] &= ~inside[1:]
        start[edges] = inside[edges]
        end[edges - 1] = inside[edges - 1]
        starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        up, down = powers.get(n)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
        # The run's sum of byte * P**place, moved back to begin at P**0.
        hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x9E6C63D0676A9A99))
        row = np.searchsorted(offsets, starts + first, side="right") - 1
        yield Segment(part, starts, ends, row, hashes)
