"""Suffix-array dedup on bytes: an LCP interval tree over anchored suffixes.

Every window of ``WINDOW`` bytes has an anchor, the least of its ``ANCHOR``-byte strings by
hash, so equal windows have it at the same place. Only anchors that occur twice anywhere
can lie in a repeat. Their suffixes, with what stands before them, meet in buckets by the
anchor's hash. A bucket sorts them (a suffix array), takes the longest common prefixes of
neighbours, and stack-scans these into the tree of LCP intervals. An interval holds all
occurrences of a common string. Where they agree to the left as well (no left-extension
diversity), they are one maximal repeat, of which all but the first occurrence go; where
they differ, each occurrence is compared with the nearest earlier ones in the order of
the reversed left contexts, which finds the repeats that reach further left.

1. Homes send hashes of anchors to buckets. 2. Buckets send back those that occur twice.
3. Homes send the suffixes at these anchors, the first of equal ones only, and flag the
others. An anchor with very many occurrences is sent in ``SEGMENTS``, each keyed by a
string that all its windows hold, so its occurrences spread over buckets by what
surrounds them. 4. Buckets flag all but the first occurrences. 5. Homes remove bytes.

Candidates come from hashes; matches are compared byte by byte, but for suffixes that a
home sends once for equal 64-bit hashes. Cases: a null text has no bytes; null identifiers
come after all others; rows of an equal identifier are documents of their own, by text;
an empty table gives an empty result; texts above 2**28 bytes are refused with an error;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from pavilion.llm import homes as H
from pavilion.llm.arrays import Texts, mixed, range_hashes, slices, sums

WINDOW = 100
ANCHOR = 28
SEGMENTS = 8
HOT = 4096
KEYS_PER_BUCKET = 500_000
SUFFIX_BYTES_PER_BUCKET = 8 << 20
PLACE_BITS = np.uint64(28)
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
SUFFIX = (np.uint64, np.int64, np.uint32, np.uint32, np.uint16, np.uint16)


@dataclass(frozen=True)
class Anchors:
    """Anchors of a slice: place, key, and the first and last window that has each."""

    place: np.ndarray
    key: np.ndarray
    low: np.ndarray
    high: np.ndarray


def anchors_of(texts: Texts, window: int, anchor: int) -> Anchors:
    """Anchors of all windows, by a running minimum over hashes that carry their place."""
    n = len(texts.data)
    if n < window:
        none = np.zeros(0, np.int64)
        return Anchors(none, np.zeros(0, np.uint64), none, none)
    if n >> int(PLACE_BITS):
        raise ValueError("a text of more than 2**28 bytes has no room for its places")
    at = np.arange(n - anchor + 1)
    hashes = range_hashes(sums(texts.data), at, at + anchor)
    least = (hashes >> PLACE_BITS << PLACE_BITS) | at.astype(np.uint64)
    span, width = window - anchor + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    rest = span - width
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    whole = np.ones(n - window + 1, bool)
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, np.maximum(texts.ends - window + 1, texts.starts), 1)
    np.add.at(change, texts.ends, -1)
    whole &= np.cumsum(change)[: n - window + 1] == 0
    starts = np.flatnonzero(whole)
    chosen = (least[starts] & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    heads = H.heads_of(chosen)
    tails = np.append(heads, len(chosen))[1:] - 1
    place = chosen[heads] if len(heads) else chosen
    # anchors have small hashes: mixed again, their keys spread evenly over buckets
    key = mixed(hashes[place] + np.uint64(1)) >> np.uint64(64 - H.KEY_BITS)
    return Anchors(place, key, starts[heads], starts[tails])


def send_anchors(home: pa.Table, window: int, anchor: int, buckets: int) -> pa.Table:
    keys = [np.zeros(0, np.uint64)]
    keys += [anchors_of(t, window, anchor).key for t in slices(home["text"])]
    keys = np.concatenate(keys)
    return H.send_keys(home["home"][0].as_py(), keys, np.ones(len(keys), np.uint8), buckets)


def segmented(a: Anchors, often: np.ndarray, running: np.ndarray, window: int, anchor: int) -> Anchors:
    """Hot anchors in segments of offsets, keyed by the string that a segment's windows share."""
    hot = np.flatnonzero(often)
    step = -(-(window - anchor + 1) // SEGMENTS)
    parts = [Anchors(*(x[~often] for x in (a.place, a.key, a.low, a.high)))]
    for s in range(SEGMENTS):
        near, far = s * step, (s + 1) * step - 1
        place = a.place[hot]
        low, high = np.maximum(a.low[hot], place - far), np.minimum(a.high[hot], place - near)
        ok = low <= high
        place, low, high = place[ok], low[ok], high[ok]
        # bytes from place - near to place - far + window are in each window of the segment
        core = range_hashes(running, place - near, np.maximum(place - far + window, place))
        key = (core + np.uint64(s)) >> np.uint64(64 - H.KEY_BITS)
        parts.append(Anchors(place, key, low, high))
    return Anchors(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("place", "key", "low", "high")))


def send_suffixes(home: pa.Table, found: pa.Table, window: int, anchor: int, buckets: int) -> pa.Table:
    if not len(home):
        return H.table([])
    home = H.in_order(home)
    number, ids = home["home"][0].as_py(), H.ids_of(home)
    hits, hot = H.hits_of(found)
    columns, bodies = [], []
    for texts in slices(home["text"]):
        a = anchors_of(texts, window, anchor)
        at = H.member(a.key, hits)
        a = Anchors(*(x[at >= 0] for x in (a.place, a.key, a.low, a.high)))
        running = sums(texts.data)
        a = segmented(a, hot[at[at >= 0]], running, window, anchor)
        doc = texts.doc_of(a.place)
        begin, end = a.low, a.high + window
        same = range_hashes(running, begin, end) ^ ((a.place - a.low).astype(np.uint64) << np.uint64(7)) ^ a.key
        columns.append(
            (a.key, same, texts.first + doc, a.place - texts.starts[doc], a.place - begin, end - a.place)
        )
        bodies += [texts.data[b:e].tobytes() for b, e in zip(begin, end, strict=True)]
    key, same, doc, place, left, right = (np.concatenate(c) for c in zip(*columns, strict=True))
    order = np.lexsort((place, doc, same, key))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (same[order][1:] != same[order][:-1])
    again = order[~new]
    rows = H.flag_rows(
        number % buckets,
        np.full(len(again), number),
        doc[again],
        (place - left)[again],
        (place + right - window)[again],
    )
    sent = order[new]
    out = [
        key[sent],
        ids[doc[sent]],
        doc[sent].astype(np.uint32),
        place[sent].astype(np.uint32),
        left[sent].astype(np.uint16),
        right[sent].astype(np.uint16),
    ]
    for bucket, part in H.by_bucket(key[sent], buckets):
        body = pa.compress(b"".join(bodies[i] for i in sent[part]), codec="zstd", asbytes=True)
        head = H.packed([c[part] for c in out])
        size = part.stop - part.start
        rows.append((bucket, number, 0, size, len(head).to_bytes(8, "little") + head + body))
    return H.table(rows)


@dataclass(frozen=True)
class Suffixes:
    """Suffixes of a bucket with their left contexts, and who is earlier."""

    key: np.ndarray
    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray
    before: np.ndarray  # left contexts, backwards from the anchor, padded
    after: np.ndarray  # right contexts from the anchor on, padded

    def take(self, at: np.ndarray) -> Suffixes:
        return Suffixes(*(getattr(self, f)[at] for f in self.__dataclass_fields__))


def received(found: pa.Table, window: int, anchor: int) -> tuple[Suffixes, list[np.ndarray]]:
    """Suffixes of a bucket; and home, document and place of each."""
    columns: list[list[np.ndarray]] = [[] for _ in range(7)]
    bodies = [np.zeros(0, np.uint8)]
    for row in found.to_pylist():
        if row["kind"] != 0:
            continue
        size = int.from_bytes(row["data"][:8], "little")
        part = H.unpacked(row["data"][8 : 8 + size], row["n"], SUFFIX)
        for c, x in zip(columns, [np.full(row["n"], row["home"], np.int64), *part], strict=True):
            c.append(x)
        total = int(part[4].sum(dtype=np.int64) + part[5].sum(dtype=np.int64))
        bodies.append(np.frombuffer(pa.decompress(row["data"][8 + size :], total, codec="zstd"), np.uint8))
    if not columns[0]:
        none = np.zeros(0, np.int64)
        pad = np.zeros((0, 1), np.uint8)
        return Suffixes(none, none, none, none, pad, pad), [none] * 3
    home, key, ids, doc, place, left, right = (np.concatenate(c) for c in columns)
    left, right, place, doc = (x.astype(np.int64) for x in (left, right, place, doc))
    data = np.concatenate(bodies)
    middle = np.cumsum(left + right) - right
    longest = window - anchor
    before = np.zeros((len(key), longest), np.uint8)
    after = np.zeros((len(key), window), np.uint8)
    for at in range(longest):
        ok = left > at
        before[ok, at] = data[middle[ok] - 1 - at]
    for at in range(window):
        ok = right > at
        after[ok, at] = data[middle[ok] + at]
    order = np.lexsort((place, doc, home, ids))
    rank = np.empty(len(key), np.int64)
    rank[order] = np.arange(len(key))
    return Suffixes(key, rank, left, right, before, after), [home, doc, place]


def as_words(rows: np.ndarray) -> list[np.ndarray]:
    """Rows of bytes as columns of big-endian integers, which sort as the bytes do."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    return list(wide.view(">u8").astype(np.uint64).T)


def common(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Lengths of common prefixes of rows, at most ``most``."""
    differ = a != b
    first = np.where(differ.any(1), differ.argmax(1), a.shape[1])
    return np.minimum(first, most)


Found = list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def equal_suffixes(s: Suffixes, found: Found) -> np.ndarray:
    """Flag all but the first of wholly equal suffixes; the positions of the others."""
    order = np.lexsort((s.rank, *as_words(s.before), *as_words(s.after), s.left, s.right, s.key))
    new = np.ones(len(order), bool)
    if len(order) > 1:
        a, b = order[1:], order[:-1]
        new[1:] = (s.key[a] != s.key[b]) | (s.left[a] != s.left[b]) | (s.right[a] != s.right[b])
        new[1:] |= (s.before[a] != s.before[b]).any(1) | (s.after[a] != s.after[b]).any(1)
    gone = order[~new]
    # offsets of windows: from the last, which ends where the suffix does, to the first
    found.append((gone, s.after.shape[1] - s.right[gone], s.left[gone]))
    return order[new]


def earlier_reach(s: Suffixes, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longest left context that each member shares with an earlier member.

    Members in the order of their left contexts; the nearest earlier one on either side
    shares the most, and what lies between bounds it: one scan with a stack per side.
    """
    order = group[np.lexsort(tuple(reversed(as_words(s.before[group]))))]
    near = common(
        s.before[order[1:]], s.before[order[:-1]], np.minimum(s.left[order[1:]], s.left[order[:-1]])
    )
    rank, reach = s.rank[order].tolist(), [-1] * len(order)
    for turn in (range(len(order)), range(len(order) - 1, -1, -1)):
        stack: list[list[int]] = []
        for i in turn:
            if turn.step > 0:
                shared = int(near[i - 1]) if i else 0
            else:
                shared = int(near[i]) if i < len(order) - 1 else 0
            while stack and stack[-1][0] > rank[i]:
                shared = min(shared, stack.pop()[1])
            if stack:
                reach[i] = max(reach[i], shared)
            stack.append([rank[i], shared])
    return order, np.array(reach, np.int64)


def flag_interval(s: Suffixes, group: np.ndarray, most: int, parent: int, window: int, found: Found) -> None:
    """Flag repeats of one LCP interval: offsets whose windows need more than the parent's prefix."""
    low, high = max(0, window - most), min(s.before.shape[1], window - 1 - parent)
    if low > high:
        return
    sample = s.before[group, :high]
    alike = (sample == sample[0]).all() and (s.left[group] >= high).all()
    if alike:  # no left-extension diversity: one maximal repeat
        gone = group[s.rank[group] != s.rank[group].min()]
        found.append((gone, np.full(len(gone), low), np.full(len(gone), high)))
        return
    order, reach = earlier_reach(s, group)
    ok = reach >= low
    found.append((order[ok], np.full(ok.sum(), low), np.minimum(reach[ok], high)))


def interval_tree(s: Suffixes, array: np.ndarray, window: int, anchor: int, found: Found) -> None:
    """Stack-scan the suffix array of groups with three or more suffixes."""
    if len(array) < 2:
        return
    a, b = array[1:], array[:-1]
    lcp = common(s.after[a], s.after[b], np.minimum(s.right[a], s.right[b]))
    lcp[s.key[a] != s.key[b]] = 0
    least = window - s.before.shape[1]
    stack: list[tuple[int, int]] = [(0, 0)]  # common prefix, first position
    for i, now in enumerate([*lcp.tolist(), 0], start=1):
        start = i - 1
        while stack[-1][0] > now:
            most, start = stack.pop()
            parent = max(now, stack[-1][0])
            if most >= least:
                flag_interval(s, array[start:i], most, max(parent, least - 1), window, found)
        if stack[-1][0] < now:
            stack.append((now, start))


def flag_pairs(s: Suffixes, a: np.ndarray, b: np.ndarray, window: int, found: Found) -> None:
    """Groups of two suffixes: the whole tree is one interval, all pairs at once."""
    right = common(s.after[a], s.after[b], np.minimum(s.right[a], s.right[b]))
    left = common(s.before[a], s.before[b], np.minimum(s.left[a], s.left[b]))
    later = np.where(s.rank[a] > s.rank[b], a, b)
    low = window - right
    ok = low <= left
    found.append((later[ok], low[ok], left[ok]))


def flag_suffixes(found: pa.Table, window: int, anchor: int) -> pa.Table:
    """Flag all but the first occurrence of every repeat in a bucket."""
    s, (home, doc, place) = received(found, window, anchor)
    gone: Found = []
    if len(s.key):
        rest = equal_suffixes(s, gone)
        rest = rest[np.lexsort((*reversed(as_words(s.after[rest])), s.key[rest]))]
        heads = H.heads_of(s.key[rest])
        many = np.diff(np.append(heads, len(rest)))
        pair = heads[many == 2]
        flag_pairs(s, rest[pair], rest[pair + 1], window, gone)
        interval_tree(s, rest[np.repeat(many, many) > 2], window, anchor, gone)
    rows = []
    if gone:
        who, low, high = (np.concatenate(x) for x in zip(*gone, strict=True))
        rows = H.flag_rows(0, home[who], doc[who], place[who] - high, place[who] - low)
    passed = found.filter(pc.equal(found["kind"], 1))
    return pa.concat_tables([H.table(rows), passed.cast(H.table([]).schema)])


def remove_bytes(home: pa.Table, found: pa.Table, window: int) -> pa.Table:
    home = H.in_order(home)
    doc, first, last = H.flags_of(found)
    sizes, removed, spans, digests = [], [], [], []
    for texts in slices(home["text"]):
        lo, hi = np.searchsorted(doc, [texts.first, texts.first + len(texts.starts)])
        base = texts.starts[doc[lo:hi] - texts.first]
        change = np.zeros(len(texts.data) + 1, np.int64)
        np.add.at(change, base + first[lo:hi], 1)
        np.add.at(change, base + last[lo:hi] + window, -1)
        gone = np.cumsum(change[:-1]) > 0
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        filled = texts.starts[texts.ends > texts.starts]
        begins[filled] = gone[filled]
        total, runs = (np.append(0, np.cumsum(x)) for x in (gone, begins))
        sizes.append(texts.ends - texts.starts)
        removed.append(total[texts.ends] - total[texts.starts])
        spans.append(runs[texts.ends] - runs[texts.starts])
        for a, b, some in zip(texts.starts, texts.ends, removed[-1], strict=True):
            kept = texts.data[a:b][~gone[a:b]] if some else texts.data[a:b]
            digests.append(hashlib.sha256(kept.tobytes()).hexdigest())
    none = [np.zeros(0, np.int64)]
    return pa.table(
        {
            "doc_id": home["doc_id"],
            "n_bytes": np.concatenate(none + sizes),
            "n_removed": np.concatenate(none + removed),
            "n_spans": np.concatenate(none + spans),
            "kept_sha256": pa.array(digests, pa.string()),
        }
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """One row per document: its bytes, how many go in how many runs, a digest of the rest."""
    corpus = H.settle(docs)
    # anchors: about one in forty bytes; suffixes: of repeats, several per byte of them
    keys = corpus.buckets(2 / (window - anchor + 2), KEYS_PER_BUCKET)
    suffixes = corpus.buckets(0.5, SUFFIX_BYTES_PER_BUCKET)
    texts = corpus.texts.groupBy("home")
    sent = texts.applyInArrow(lambda t: send_anchors(t, window, anchor, keys), H.PACK)
    hits = sent.groupBy("bucket").applyInArrow(lambda t: H.shared_keys(t, 1, hot), H.PACK)
    bodies = texts.cogroup(hits.groupBy("home")).applyInArrow(
        lambda t, found: send_suffixes(t, found, window, anchor, suffixes), H.PACK
    )
    flags = bodies.groupBy("bucket").applyInArrow(lambda t: flag_suffixes(t, window, anchor), H.PACK)
    return texts.cogroup(flags.groupBy("home")).applyInArrow(
        lambda t, found: remove_bytes(t, found, window), RESULT
    )
