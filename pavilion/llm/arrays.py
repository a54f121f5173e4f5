"""Texts of an Arrow column as one byte array, and hashes of all their windows.

Everything works on slices of half a megabyte with array operations, which keeps the memory
of a worker small; positions in a slice
never cross documents. Hashes are polynomials modulo 2**64, mixed at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)
# odd, and inverse to BASE modulo 2**64
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@dataclass(frozen=True)
class Texts:
    """Documents ``first`` to ``first + len(ends)`` of a column, laid end to end."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, "right") - 1


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Whole documents of about ``limit`` bytes together; a null is an empty text."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    done = 0
    for chunk in chunks:
        filled = pc.fill_null(chunk.cast(pa.large_string()), "")
        _, places, data = filled.buffers()
        edges = np.frombuffer(places, np.int64)[filled.offset : filled.offset + len(filled) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(filled):
            to = int(np.searchsorted(edges, edges[at] + limit, "right")) - 1
            to = min(max(to, at + 1), len(filled))
            base = edges[at]
            yield Texts(
                done + at,
                raw[base : edges[to]],
                edges[at:to] - base,
                edges[at + 1 : to + 1] - base,
            )
            at = to
        done += len(filled)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all bits."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_powers = {BASE: np.ones(1, np.uint64), INVERSE: np.ones(1, np.uint64)}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base``."""
    if len(_powers[base]) < n:
        long = np.full(max(n, 1 << 16), base, np.uint64)
        long[0] = 1
        _powers[base] = np.multiply.accumulate(long)
    return _powers[base][:n]


def sums(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums: the hash of any range follows from two of them."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(values)), out=out[1:])
    return out


def range_hashes(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the ranges of values from ``starts`` to ``ends``."""
    h = (running[ends] - running[starts]) * powers(INVERSE, len(running))[starts]
    return mixed(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass(frozen=True)
class Words:
    """Words of a slice: byte ranges, hashes, and the first word of each document."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    firsts: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.firsts)


def words_of(texts: Texts, lower: bool = False) -> Words:
    """Runs of anything but ASCII white space."""
    data = LOWER[texts.data] if lower else texts.data
    inside = ~SPACE[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    filled = texts.ends > texts.starts
    begins[texts.starts[filled]] |= inside[texts.starts[filled]]
    stops[texts.ends[filled] - 1] |= inside[texts.ends[filled] - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    firsts = np.searchsorted(starts, np.append(texts.starts, len(data)), "left")
    return Words(starts, ends, range_hashes(sums(data), starts, ends), firsts)


def window_starts(firsts: np.ndarray, length: int) -> np.ndarray:
    """Positions at which ``length`` values of one document follow."""
    ok = np.ones(firsts[-1], bool)
    for back in range(1, length):
        ok[np.maximum(firsts[1:] - back, firsts[:-1])[np.diff(firsts) > 0]] = False
    return np.flatnonzero(ok)
