"""Sets of word shingles as sorted hashes, and a global order of shingles.

The order is by how often a shingle's cell occurs in the corpus, then by hash. Cells are
the top bits of the hash: a table of ``2 ** CELL_BITS`` counts, of fixed size whatever the
corpus, which is all that is broadcast. Any order gives the same links; this one puts the
very common shingles last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pavilion.llm.arrays import Texts, range_hashes, slices, sums, window_starts, words_of

CELL_BITS = 20
CHUNK = 1 << 12


def sets_of(texts: Texts, length: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each document, sorted; short texts are one shingle."""
    words = words_of(texts, lower=True)
    counts, running = words.counts(), sums(words.hashes)
    starts = window_starts(words.firsts, length)
    hashes = range_hashes(running, starts, starts + length)
    edges = np.searchsorted(starts, words.firsts)
    out = []
    for i, n in enumerate(counts):
        if n == 0:
            out.append(hashes[:0])
        elif n < length:
            first = words.firsts[i : i + 1]
            out.append(range_hashes(running, first, first + n))
        else:
            out.append(np.unique(hashes[edges[i] : edges[i + 1]]))
    return out


def cell_counts(docs: DataFrame, length: int) -> np.ndarray:
    """How many documents have a shingle in each cell, over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for texts in slices(batch.column(0)):
                found = np.concatenate([np.zeros(0, np.uint64), *sets_of(texts, length)])
                at = (found >> np.uint64(64 - CELL_BITS)).astype(np.int64)
                cells += np.bincount(at, minlength=len(cells))
        rows = cells.reshape(-1, CHUNK)
        used = np.flatnonzero(rows.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([rows[i].tobytes() for i in used], pa.binary())],
            names=["chunk", "counts"],
        )

    def add(part: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_py(), np.int64) for c in part["counts"])
        return pa.table({"chunk": part["chunk"][:1], "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "chunk int, counts binary"
    parts = docs.select("text").mapInArrow(count, schema).groupBy("chunk").applyInArrow(add, schema)
    out = np.zeros(1 << CELL_BITS, np.int64)
    for row in parts.collect():  # 2 ** CELL_BITS counts in all
        out[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["counts"], np.int64)
    return out


def rarest_first(hashes: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """A set in the global order."""
    often = cells[(hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
    return hashes[np.lexsort((hashes, often))]

