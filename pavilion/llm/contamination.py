"""Benchmark decontamination by the q-gram lemma.

Texts are compared as code points, in lower case, with white space as one blank. A
benchmark passage of ``m`` characters that occurs with at most ``e`` edits shares
``m - q + 1 - q * e`` of its q-grams with the place it occurs at, on diagonals that differ
by ``e`` at most. Shared q-grams are counted by passage and by overlapping bands of
diagonals, each as wide as two budgets; bands that reach the bound are kept and verified
by an alignment of the whole passage within the band.

The budget is ``rate * m`` edits, but never so many that less than half of the q-grams
must be shared. Passages shorter than ``q`` characters have no q-grams: a document holds
one only if it is that passage and nothing else. Passages are looked up in blocks of
bounded size: a block is collected and broadcast, and documents are read where they are,
without a shuffle.

Cases: null texts have no passages; null passages and those without characters are
ignored; a null or repeated identifier is carried as it is; repeated passages are found
each; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavilion.llm.arrays import Texts, range_hashes, slices, sums

Q = 10
RATE = 0.05
BLOCK_BYTES = 4 << 20
MAP_BITS = 22
BLANK = 0x20
SCHEMA = "doc_id long, item_id long, edits int, start_byte long, end_byte long"


@dataclass(frozen=True)
class Index:
    """q-grams of the passages of one block, sorted by hash, and the passages without any."""

    ids: list
    passages: list[np.ndarray]
    budgets: np.ndarray
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    seen: np.ndarray
    short: dict[bytes, list[int]]


def normalised(texts: Texts) -> tuple[Texts, np.ndarray]:
    """Code points in lower case and single blanks, and the byte each that is left starts at.

    A letter stays one code point: of a longer lower-case form, the first counts.
    """
    firsts = np.flatnonzero((texts.data & 0xC0) != 0x80)
    points = np.frombuffer(texts.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    found, inverse = np.unique(points, return_inverse=True)
    lower = np.array([BLANK if chr(c).isspace() else ord(chr(c).lower()[0]) for c in found.tolist()], np.uint32)
    data = lower[inverse] if len(found) else points
    starts, ends = np.searchsorted(firsts, texts.starts), np.searchsorted(firsts, texts.ends)
    space = data == BLANK
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    filled = ends > starts
    keep[starts[filled]] = ~space[starts[filled]]
    came_from = np.flatnonzero(keep)
    clean = Texts(
        texts.first, data[came_from], np.searchsorted(came_from, starts), np.searchsorted(came_from, ends)
    )
    return clean, firsts[came_from]


def grams(texts: Texts, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each q-gram inside a document."""
    n = len(texts.data) - q + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ok = np.ones(n + q, bool)
    for back in range(1, q):
        at = texts.ends - back
        ok[at[at >= texts.starts]] = False
    starts = np.flatnonzero(ok[:n])
    return starts, range_hashes(sums(texts.data), starts, starts + q)


def trimmed(points: np.ndarray) -> np.ndarray:
    """Without the blank that may be left at the end."""
    return points[:-1] if len(points) and points[-1] == BLANK else points


def build_index(ids: list, texts: list[str | None], q: int = Q, rate: float = RATE) -> Index:
    passages, hashes, item, place, budgets, kept = [], [], [], [], [], []
    short: dict[bytes, list[int]] = defaultdict(list)
    for one in slices(pa.array(texts, pa.string()), 1):
        passage = trimmed(normalised(one)[0].data)
        if not len(passage):
            continue
        if len(passage) < q:
            short[passage.tobytes()].append(len(passages))
        else:
            at, h = grams(Texts(0, passage, np.array([0]), np.array([len(passage)])), q)
            hashes.append(h)
            place.append(at)
            item.append(np.full(len(at), len(passages)))
        budgets.append(max(0, min(int(rate * len(passage)), (len(passage) - q + 1) // (2 * q))))
        passages.append(passage)
        kept.append(ids[one.first])
    empty = np.zeros(0, np.int64)
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    order = np.argsort(h, kind="stable")
    seen = np.zeros(1 << MAP_BITS, bool)
    seen[h >> np.uint64(64 - MAP_BITS)] = True
    return Index(
        kept,
        passages,
        np.array(budgets, np.int64),
        h[order],
        np.concatenate(item)[order] if item else empty,
        np.concatenate(place)[order] if place else empty,
        seen,
        dict(short),
    )


def banded_edits(passage: np.ndarray, target: np.ndarray, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """Least edits of the passage against a part of the target: edits, start, end.

    Only cells on diagonals (place in the target less place in the passage) from ``low`` to
    ``high`` are computed, row by row over the passage. A cell holds the edits and, to break
    ties and to know the start, where its alignment began. None above ``most`` edits.
    """
    m, size, width = len(passage), len(target), high - low + 1
    shift = np.int64(size + 2)
    never = np.int64(m + size + 4) * shift
    # the target with room on both sides, so that every diagonal has a place in every row
    left, right = max(0, -low), max(0, m + high - size)
    padded = np.concatenate([np.zeros(left, target.dtype), target, np.zeros(right, target.dtype)])
    at = np.arange(low, high + 1)
    # edits * shift + start, so that the least value has the fewest edits
    row = np.where((at >= 0) & (at <= size), at, never)
    steps = np.arange(width, dtype=np.int64) * shift
    for i in range(m):
        own = padded[low + i + left : low + i + left + width]
        # from the same diagonal: one character of each; from the next: one of the passage
        new = row + (own != passage[i]) * shift
        new[:-1] = np.minimum(new[:-1], row[1:] + shift)
        if low + i + 1 < 0 or high + i + 1 > size:  # a corner of the band lies outside
            new[(at + i < 0) & (at + i + 1 != 0) | (at + i + 1 > size)] = never
            if low <= -i - 1 <= high:
                new[-i - 1 - low] = (i + 1) * shift
        # along the row: one character of the target
        row = np.minimum.accumulate(new - steps) + steps
        if low + i + 1 < 0 or high + i + 1 > size:
            row[(at + i + 1 < 0) | (at + i + 1 > size)] = never
        if row.min() // shift > most:
            return None
    end = int(np.argmin(row // shift))
    edits, start = divmod(int(row[end]), int(shift))
    return (edits, start, m + low + end) if edits <= most else None


def regions(texts: Texts, index: Index, q: int = Q) -> list[tuple[int, int, int, int, int]]:
    """Document, passage, edits, start and end byte of each best verified region."""
    clean, came_from = normalised(texts)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    if index.short:
        for d in np.flatnonzero((clean.ends > clean.starts) & (clean.ends - clean.starts <= q)).tolist():
            own = trimmed(clean.data[clean.starts[d] : clean.ends[d]])
            for i in index.short.get(own.tobytes(), []):
                best[d, i] = (0, int(clean.starts[d]), int(clean.starts[d]) + len(own))
    starts, h = grams(clean, q)
    maybe = index.seen[h >> np.uint64(64 - MAP_BITS)]
    starts, h = starts[maybe], h[maybe]
    low = np.searchsorted(index.hashes, h, "left")
    many = np.searchsorted(index.hashes, h, "right") - low
    if many.sum():
        for spot in candidates(clean, index, q, starts, low, many):
            verify(clean, index, *spot, best)
    out = []
    for (d, i), (edits, first, last) in sorted(best.items()):
        base = int(texts.starts[d])
        end = int(came_from[last]) if last < len(came_from) else len(texts.data)
        # the bytes of the last character, without white space behind it
        tail = came_from[max(first, last - 1)]
        end = min(end, int(tail) + 4, int(texts.ends[d]))
        while end - 1 > tail and (texts.data[end - 1] & 0xC0) != 0x80:
            end -= 1
        out.append((d, i, edits, int(came_from[first]) - base, end - base))
    return out


def candidates(clean: Texts, index: Index, q: int, starts: np.ndarray, low: np.ndarray, many: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Document, passage and band of diagonals where enough q-grams are shared."""
    at = np.repeat(starts, many)
    entry = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
    item, place = index.item[entry], index.place[entry]
    doc = clean.doc_of(at)
    length = np.array([len(p) for p in index.passages])
    width = index.budgets + 1
    needed = length - q + 1 - q * index.budgets
    diagonal = at - clean.starts[doc] - place + length[item] + width[item]
    band = diagonal // width[item]
    # neighbouring bands overlap: band b holds the diagonals of widths b and b + 1
    doc, item, place = (np.concatenate([x, x]) for x in (doc, item, place))
    band = np.concatenate([band, band - 1])
    order = np.lexsort((place, band, item, doc))
    doc, item, place, band = doc[order], item[order], place[order], band[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
    distinct = new.copy()
    distinct[1:] |= place[1:] != place[:-1]
    heads = np.flatnonzero(new)
    shared = np.add.reduceat(distinct.astype(np.int64), heads)
    for head in heads[shared >= needed[item[heads]]]:
        yield int(doc[head]), int(item[head]), int(band[head])


def verify(clean: Texts, index: Index, d: int, i: int, band: int, best: dict) -> None:
    """Align a passage along a band of a document, and keep the best place."""
    passage, budget = index.passages[i], int(index.budgets[i])
    begin, stop = int(clean.starts[d]), int(clean.ends[d])
    # the diagonals of the band, and as many to both sides as edits can lead
    first = band * (budget + 1) - len(passage) - (budget + 1) - budget
    last = first + 2 * (budget + 1) + 2 * budget
    lo = max(begin, begin + first)
    hi = min(stop, begin + last + len(passage))
    found = banded_edits(passage, clean.data[lo:hi], first - (lo - begin), last - (lo - begin), budget)
    if found is not None:
        edits, start, end = found
        spot = (edits, lo + start, lo + end)
        if (d, i) not in best or spot < best[d, i]:
            best[d, i] = spot


def indexes(benchmark: DataFrame, q: int = Q, rate: float = RATE) -> Iterator[Broadcast]:
    """Broadcast indexes of the benchmark, block after block of about ``BLOCK_BYTES``."""
    context = benchmark.sparkSession.sparkContext
    n_bytes = benchmark.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    blocks = max(1, -(-n_bytes // BLOCK_BYTES))
    for block in range(blocks):
        chosen = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
        rows = benchmark.where(chosen).select("item_id", "text").collect()
        index = build_index([r["item_id"] for r in rows], [r["text"] for r in rows], q, rate)
        yield context.broadcast(index)


def leaks(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE) -> DataFrame:
    """A row per document and benchmark item that it contains, with the best place."""
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
    names = ("doc_id", "item_id", "edits", "start_byte", "end_byte")

    def scan(shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                ids, rows = batch.column(0), []
                for texts in slices(batch.column(1)):
                    for d, i, *place in regions(texts, index, q):
                        rows.append((ids[texts.first + d].as_py(), index.ids[i], *place))
                columns = [pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

        return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)

    return reduce(DataFrame.unionByName, map(scan, indexes(benchmark, q, rate)))


def without_leaks(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE) -> DataFrame:
    """The rows whose text holds no benchmark passage, in all their columns; no shuffle."""
    at = docs.columns.index("text")

    def keep(rest: DataFrame, shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for texts in slices(batch.column(at)):
                    clean[[texts.first + d for d, *_ in regions(texts, index, q)]] = False
                yield batch.filter(pa.array(clean))

        return rest.mapInArrow(run, docs.schema)

    return reduce(keep, indexes(benchmark, q, rate), docs)
