"""Documents in groups of a few megabytes, and packed arrays between them.

Documents are dealt by a hash of their identifier to homes. A home is small, so one task
holds it as arrays; it is ordered by identifier and text, so a document's place in it is
the same in every pass. All passes over the texts share one exchange.

What homes send to buckets of hashes, and buckets send back, are packed columns: sorted
hashes as differences, every column as planes of bytes, compressed. A pack costs a few
bytes per entry where a row would cost some forty.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOME_BYTES = 3 << 20
KEY_BITS = 40
PACK = "bucket long, home long, kind int, n long, data binary"
LAST_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Corpus:
    """Texts by home, and the bytes of all texts."""

    texts: DataFrame
    n_bytes: int

    def buckets(self, entries_per_byte: float, entries: int) -> int:
        """Buckets of about ``entries`` entries."""
        return max(1, -(-int(self.n_bytes * entries_per_byte) // entries))


def settle(docs: DataFrame) -> Corpus:
    """Deal documents to homes; a null identifier goes by its text."""
    n_bytes = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    homes = max(1, -(-n_bytes // HOME_BYTES))
    key = F.xxhash64(F.coalesce(F.col("doc_id"), F.xxhash64("text")))
    texts = docs.select("doc_id", "text", F.pmod(key, F.lit(homes)).alias("home"))
    return Corpus(texts, n_bytes)


def in_order(home: pa.Table) -> pa.Table:
    """The documents of a home in their fixed order; null identifiers last."""
    keys = [("doc_id", "ascending"), ("text", "ascending")]
    return home.take(pc.sort_indices(home, sort_keys=keys, null_placement="at_end"))


def ids_of(home: pa.Table) -> np.ndarray:
    return pc.fill_null(home["doc_id"], int(LAST_ID)).to_numpy()


def packed(columns: Sequence[np.ndarray], deltas: bool = True) -> bytes:
    """Columns of one length; the first is sorted and unsigned if ``deltas``."""
    planes = []
    for i, column in enumerate(columns):
        if deltas and i == 0:
            column = np.diff(column, prepend=column.dtype.type(0))
        column = np.ascontiguousarray(column)
        planes.append(column.view(np.uint8).reshape(len(column), -1).T.tobytes())
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int, kinds: Sequence, deltas: bool = True) -> list[np.ndarray]:
    sizes = [np.dtype(k).itemsize for k in kinds]
    raw = np.frombuffer(pa.decompress(data, n * sum(sizes), codec="zstd"), np.uint8)
    out, at = [], 0
    for i, (kind, size) in enumerate(zip(kinds, sizes, strict=True)):
        plane = raw[at : at + n * size].reshape(size, n)
        column = np.ascontiguousarray(plane.T).view(kind).ravel()
        out.append(np.cumsum(column, dtype=kind) if deltas and i == 0 else column)
        at += n * size
    return out


def table(rows: list[tuple]) -> pa.Table:
    """Rows of ``PACK``."""
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
    names = ("bucket", "home", "kind", "n", "data")
    columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
    return pa.Table.from_arrays(columns, names=names)


def by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Ranges of sorted ``KEY_BITS``-bit keys by bucket."""
    of = (keys * np.uint64(buckets)) >> np.uint64(KEY_BITS)
    for lo, hi in runs_of(of):
        yield int(of[lo]), slice(lo, hi)


def packs(found: pa.Table, kind: int, kinds: Sequence, deltas: bool = True) -> tuple[np.ndarray, list]:
    """All entries of a kind: their homes, and the columns one after another."""
    homes, columns = [], [[np.zeros(0, k)] for k in kinds]
    for row in found.to_pylist():
        if row["kind"] == kind:
            homes.append(np.full(row["n"], row["home"], np.int64))
            for column, part in zip(columns, unpacked(row["data"], row["n"], kinds, deltas), strict=True):
                column.append(part)
    return np.concatenate([np.zeros(0, np.int64), *homes]), [np.concatenate(c) for c in columns]


def heads_of(ordered: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


def runs_of(ordered: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal values in a sorted array."""
    heads = heads_of(ordered)
    return list(zip(heads, np.append(heads, len(ordered))[1:], strict=True))


def counted(keys: np.ndarray, flags: np.ndarray) -> list[np.ndarray]:
    """Distinct sorted keys with the number of their entries (65,535 at most) and flags."""
    order = np.argsort(keys, kind="stable")
    keys, flags = keys[order], flags[order]
    heads = heads_of(keys)
    if not len(heads):
        return [keys, np.zeros(0, np.uint16), flags]
    many = np.minimum(np.diff(np.append(heads, len(keys))), 65535).astype(np.uint16)
    return [keys[heads], many, np.bitwise_or.reduceat(flags, heads)]


KEYS = (np.uint64, np.uint16, np.uint8)


def send_keys(home: int, keys: np.ndarray, flags: np.ndarray, buckets: int) -> pa.Table:
    """Packs of the distinct keys of a home."""
    columns = counted(keys, flags)
    return table(
        [
            (bucket, home, 0, part.stop - part.start, packed([c[part] for c in columns]))
            for bucket, part in by_bucket(columns[0], buckets)
        ]
    )


def shared_keys(found: pa.Table, flag: int, hot: int) -> pa.Table:
    """Keys of a bucket that occur twice and, once at least, with ``flag``: back to homes.

    Their new flag says whether a key occurs more than ``hot`` times.
    """
    homes, (keys, many, flags) = packs(found, 0, KEYS)
    order = np.argsort(keys, kind="stable")
    homes, keys, many, flags = homes[order], keys[order], many[order].astype(np.int64), flags[order]
    heads = heads_of(keys)
    if not len(heads):
        return table([])
    total = np.add.reduceat(many, heads)
    wanted = (total > 1) & ((np.bitwise_or.reduceat(flags, heads) & flag) == flag)
    length = np.diff(np.append(heads, len(keys)))
    keep, often = np.repeat(wanted, length), np.repeat(total > hot, length)
    homes, keys, often = homes[keep], keys[keep], often[keep].astype(np.uint8)
    order = np.argsort(homes, kind="stable")
    homes, keys, often = homes[order], keys[order], often[order]
    return table(
        [
            (0, int(homes[lo]), 0, hi - lo, packed([keys[lo:hi], often[lo:hi]]))
            for lo, hi in runs_of(homes)
        ]
    )


def hits_of(found: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """What ``shared_keys`` sent to a home, sorted: keys, and whether they are hot."""
    _, (keys, often) = packs(found, 0, (np.uint64, np.uint8))
    order = np.argsort(keys, kind="stable")
    return keys[order], often[order].astype(bool)


def member(keys: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Place of each key among the sorted ``hits``, or -1."""
    if not len(hits):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(hits, keys), len(hits) - 1)
    return np.where(hits[at] == keys, at, -1)


FLAGS = (np.uint32, np.uint32, np.uint32)


def flag_rows(bucket: int, homes: np.ndarray, doc: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[tuple]:
    """Packs by home of places that go: document of the home, first and last start."""
    order = np.lexsort((first, doc, homes))
    homes = homes[order]
    columns = [x[order].astype(np.uint32) for x in (doc, first, last)]
    return [
        (bucket, int(homes[lo]), 1, hi - lo, packed([c[lo:hi] for c in columns]))
        for lo, hi in runs_of(homes)
    ]


def flags_of(found: pa.Table) -> list[np.ndarray]:
    """Document, first and last start of all places that go from a home, by document."""
    _, columns = packs(found, 1, FLAGS)
    order = np.argsort(columns[0], kind="stable")
    return [c[order].astype(np.int64) for c in columns]
