"""Substring dedup by fixed-block anchors, on words.

Each document is cut into non-overlapping reference blocks of ``BLOCK`` words. A window
of ``WINDOW`` words holds at least one whole block of its document wherever it starts,
so the block of an earlier occurrence shows up, at the same offset, in every later one.
All rolling windows of ``BLOCK`` words are probed against the blocks of all documents.
Around each hit, every window of ``WINDOW`` words is compared with all others by its own
hash, and consecutive equal windows extend the hit to a maximal exact repeat. All but the
first occurrence, by document and place, go.

1. homes send the distinct hashes of their rolling windows to buckets of hashes; marked are
   those of reference blocks. 2. Buckets send back what is a block somewhere and occurs
   twice. 3. Homes send the windows around hits, the first of equal ones only, and flag
   the others. 4. Buckets flag all but the first. 5. Homes remove flagged words.

Hashes have 64 bits (anchors 40, which may only add candidates). Cases: null texts have no
words; null identifiers come after all others; rows of an equal identifier are documents
of their own, by text; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pavilion.llm import homes as H
from pavilion.llm.arrays import Texts, Words, range_hashes, slices, sums, window_starts, words_of

WINDOW = 20
BLOCK = 10
ENTRIES = 1_000_000
WINDOWS = (np.uint64, np.int64, np.uint32, np.uint32)
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
KEY = np.uint64(64 - H.KEY_BITS)


def rolling(words: Words, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and key of each rolling window, and whether it is a reference block."""
    starts = window_starts(words.firsts, block)
    keys = range_hashes(sums(words.hashes), starts, starts + block) >> KEY
    doc = np.searchsorted(words.firsts, starts, "right") - 1
    return starts, keys, (starts - words.firsts[doc]) % block == 0


def send_anchors(home: pa.Table, block: int, buckets: int) -> pa.Table:
    keys, flags = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
    for texts in slices(home["text"]):
        _, k, aligned = rolling(words_of(texts), block)
        keys.append(k)
        flags.append(aligned.astype(np.uint8))
    number = home["home"][0].as_py()
    return H.send_keys(number, np.concatenate(keys), np.concatenate(flags), buckets)


def near_hits(words: Words, hits: np.ndarray, window: int, block: int) -> np.ndarray:
    """Starts of the windows that hold a hit."""
    starts, keys, _ = rolling(words, block)
    anchors = starts[H.member(keys, hits) >= 0]
    change = np.zeros(words.firsts[-1] + 1, np.int64)
    np.add.at(change, np.maximum(anchors - (window - block), 0), 1)
    np.add.at(change, anchors + 1, -1)
    whole = window_starts(words.firsts, window)
    return whole[np.cumsum(change)[whole] > 0]


def send_windows(home: pa.Table, found: pa.Table, window: int, block: int, buckets: int) -> pa.Table:
    if not len(home):
        return H.table([])
    home = H.in_order(home)
    number, ids = home["home"][0].as_py(), H.ids_of(home)
    hits, _ = H.hits_of(found)
    parts = []
    for texts in slices(home["text"]):
        words = words_of(texts)
        starts = near_hits(words, hits, window, block)
        doc = np.searchsorted(words.firsts, starts, "right") - 1
        hashes = range_hashes(sums(words.hashes), starts, starts + window)
        parts.append((hashes, texts.first + doc, starts - words.firsts[doc]))
    hashes, doc, place = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(hashes, kind="stable")
    hashes, doc, place = hashes[order], doc[order], place[order]
    first = np.zeros(len(hashes), bool)
    first[H.heads_of(hashes)] = True
    again = ~first
    rows = H.flag_rows(
        number % buckets, np.full(again.sum(), number), doc[again], place[again], place[again]
    )
    columns = [
        hashes[first],
        ids[doc[first]],
        doc[first].astype(np.uint32),
        place[first].astype(np.uint32),
    ]
    for bucket, part in H.by_bucket(hashes[first] >> KEY, buckets):
        rows.append((bucket, number, 0, part.stop - part.start, H.packed([c[part] for c in columns])))
    return H.table(rows)


def flag_windows(found: pa.Table) -> pa.Table:
    """All but the first of equal windows, and what homes have flagged themselves."""
    homes, (hashes, ids, doc, place) = H.packs(found, 0, WINDOWS)
    order = np.argsort(hashes, kind="stable")
    heads = H.heads_of(hashes[order])
    many = np.repeat(np.diff(np.append(heads, len(order))), np.diff(np.append(heads, len(order))))
    order = order[many > 1]
    # a home sends one of equal windows: its number decides between null identifiers
    order = order[np.lexsort((homes[order], ids[order], hashes[order]))]
    again = np.ones(len(order), bool)
    again[H.heads_of(hashes[order])] = False
    gone = order[again]
    rows = H.flag_rows(0, homes[gone], doc[gone], place[gone], place[gone])
    passed = found.filter(pa.compute.equal(found["kind"], 1))
    return pa.concat_tables([H.table(rows), passed.cast(H.table([]).schema)])


def joined_kept(texts: Texts, words: Words, kept: np.ndarray) -> list[bytes]:
    """Kept words of each document, with one blank between."""
    doc = np.searchsorted(words.firsts, np.flatnonzero(kept), "right") - 1
    starts, ends = words.starts[kept], words.ends[kept]
    last = np.ones(len(doc), bool)
    last[:-1] = doc[1:] != doc[:-1]
    change = np.zeros(len(texts.data) + 1, np.int8)
    change[starts] += 1
    change[ends] -= 1
    keep = np.cumsum(change[:-1], dtype=np.int8) > 0
    data = texts.data.copy()
    data[ends[~last]] = 0x20
    keep[ends[~last]] = True
    out = data[keep].tobytes()
    edges = np.append(0, np.cumsum(keep))
    return [out[edges[a] : edges[b]] for a, b in zip(texts.starts, texts.ends, strict=True)]


def remove_words(home: pa.Table, found: pa.Table, window: int) -> pa.Table:
    home = H.in_order(home)
    doc, place, _ = H.flags_of(found)
    counts, removed, digests = [], [], []
    for texts in slices(home["text"]):
        words = words_of(texts)
        lo, hi = np.searchsorted(doc, [texts.first, texts.first + len(texts.starts)])
        at = words.firsts[doc[lo:hi] - texts.first] + place[lo:hi]
        change = np.zeros(words.firsts[-1] + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + window, -1)
        kept = np.cumsum(change[:-1]) == 0
        gone = np.append(0, np.cumsum(~kept))
        counts.append(words.counts())
        removed.append(gone[words.firsts[1:]] - gone[words.firsts[:-1]])
        digests += [hashlib.sha256(b).hexdigest() for b in joined_kept(texts, words, kept)]
    none = [np.zeros(0, np.int64)]
    return pa.table(
        {
            "doc_id": home["doc_id"],
            "n_words": np.concatenate(none + counts),
            "n_removed": np.concatenate(none + removed),
            "kept_sha256": pa.array(digests, pa.string()),
        }
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: its words, how many go, and a digest of those that stay."""
    block = max(1, min(BLOCK, window // 2))
    corpus = H.settle(docs)
    # about one word per six bytes
    anchors = corpus.buckets(1 / 6, ENTRIES)
    windows = corpus.buckets(1 / 12, ENTRIES)
    texts = corpus.texts.groupBy("home")
    keys = texts.applyInArrow(lambda t: send_anchors(t, block, anchors), H.PACK)
    hits = keys.groupBy("bucket").applyInArrow(lambda t: H.shared_keys(t, 1, 1 << 62), H.PACK)
    sent = texts.cogroup(hits.groupBy("home")).applyInArrow(
        lambda t, found: send_windows(t, found, window, block, windows), H.PACK
    )
    flags = sent.groupBy("bucket").applyInArrow(flag_windows, H.PACK)
    return texts.cogroup(flags.groupBy("home")).applyInArrow(
        lambda t, found: remove_words(t, found, window), RESULT
    )
