"""SimHash fingerprints and their near-duplicate components by an index of positional bytes.

A fingerprint has 64 bits; a bit is 1 if it is set in over half of the 64-bit hashes of a
text's word shingles, repeats included. Two fingerprints link at ``bits`` (2) or fewer
differing bits. These lie in at most two of the eight bytes, so linked fingerprints share
at least six bytes at their positions: the guaranteed minimum of the count filter.

1. Equal fingerprints are one from the start, so copies cost nothing afterwards.
2. The index holds a posting of each fingerprint under four positional bytes at once: of
   four pairs of positions, linked fingerprints share two whole pairs, so the six choices
   of two pairs lose no link. A single byte's list would hold 1/256 of all rows.
3. Within a list each position adds one to the tally of every pair with equal byte.
   Pairs whose tally reaches the minimum are verified on their bits.
4. A list of more than ``LIST_ROWS`` fingerprints is divided by two more positional bytes,
   in all six ways. Its parts share six bytes, so every tally reaches the minimum. Where a
   part is still longer, the other 16 bits address a table directly: at most 65,536
   entries, whose neighbours are looked up by flipping bits. No part grows beyond that,
   whatever the input.
5. Verified links (a spanning forest per list, never all pairs) make components.

Cases: null texts and texts without words have fingerprint zero and link like any other;
rows without an identifier get their fingerprint, but no component and no links; every
other row counts by itself, also where several share an identifier; empty tables give an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavilion.functions.staging import stage
from pavilion.llm.arrays import LOWER, Texts, slices, words_of
from pavilion.llm.components import components

SEED = 42
BYTES = 8
BITS = 2
LIST_ROWS = 1024
ROWS_PER_TASK = 20_000
# the four pairs of positions, and the choices of two that make a key
PAIRS = [(0, 1), (2, 3), (4, 5), (6, 7)]
KEYS = [a + b for a, b in combinations(PAIRS, 2)]


def shingle_hashes(texts: Texts, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the space-joined shingles of a slice, and each document's first one."""
    words = words_of(texts, lower=True)
    counts = words.counts()
    # all words in a row, each with one space behind it
    sizes = words.ends - words.starts
    edges = np.append(0, np.cumsum(sizes + 1))
    joined = np.full(int(edges[-1]), 0x20, np.uint8)
    inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    joined[np.repeat(edges[:-1], sizes) + inner] = LOWER[texts.data][np.repeat(words.starts, sizes) + inner]
    raw = joined.tobytes()
    many = np.where(counts >= length, counts - length + 1, np.minimum(counts, 1))
    firsts = np.append(0, np.cumsum(many))
    at = np.arange(int(firsts[-1])) - np.repeat(firsts[:-1], many) + np.repeat(words.firsts[:-1], many)
    last = at + np.repeat(np.minimum(counts, length), many)
    digest = xxhash.xxh64_intdigest
    found = (digest(raw[a:b], SEED) for a, b in zip(edges[at].tolist(), (edges[last] - 1).tolist(), strict=True))
    return np.fromiter(found, np.uint64, len(at)), firsts


def fingerprints_of(texts: Texts, length: int) -> np.ndarray:
    """The fingerprint of each document of a slice."""
    hashes, firsts = shingle_hashes(texts, length)
    out = np.zeros(len(firsts) - 1, np.uint64)
    many = np.diff(firsts)
    filled = np.flatnonzero(many)
    if len(filled):
        ones = np.zeros((len(filled), 64), np.int64)
        for bit in range(64):  # a bit at a time keeps memory at one array of hashes
            is_set = ((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)
            ones[:, bit] = np.add.reduceat(is_set, firsts[:-1][filled])
        weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
        out[filled] = ((2 * ones > many[filled][:, None]) * weights).sum(1, dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, length: int = 3) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (its 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(1)):
                found = fingerprints_of(texts, length)
                ids = batch.column(0).slice(texts.first, len(found))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(found.view(np.int64))], names=["doc_id", "fingerprint"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint long")


def positional(fingerprint: Column, places: tuple[int, ...]) -> Column:
    """The bytes at these positions, one behind the other, as long."""
    out = F.lit(0).cast("long")
    for p in places:
        byte = F.shiftrightunsigned(fingerprint, 8 * p).bitwiseAND(F.lit(255))
        out = F.shiftleft(out, 8).bitwiseOR(byte)
    return out


def postings(nodes: DataFrame) -> DataFrame:
    """Fingerprints under each choice of four positional bytes, where others are, too.

    ``choice`` numbers the positions, ``key`` has their bytes. Lists beyond ``LIST_ROWS``
    come divided: ``more`` numbers the choice of two further positions, or is -1.
    """
    keys = [
        F.struct(F.lit(i).alias("choice"), positional(F.col("fingerprint"), places).alias("key"))
        for i, places in enumerate(KEYS)
    ]
    whole = nodes.select("fingerprint", F.explode(F.array(*keys)).alias("p")).select("fingerprint", "p.*")
    lists = whole.groupBy("choice", "key").agg(F.count("*").alias("many")).where("many > 1")
    held = whole.join(lists, ["choice", "key"])
    small = held.where(F.col("many") <= LIST_ROWS).select("fingerprint", "choice", "key", F.lit(-1).alias("more"))
    return small.unionByName(divided(held.where(F.col("many") > LIST_ROWS)))


def further(choice: int) -> list[tuple[int, int]]:
    """The choices of two positions that a key does not hold."""
    return list(combinations([p for p in range(BYTES) if p not in KEYS[choice]], 2))


def divided(large: DataFrame) -> DataFrame:
    """Long lists by two further positional bytes, in every way."""
    ways = []
    for i in range(len(KEYS)):
        two = [
            F.struct(
                F.lit(j).alias("more"),
                F.shiftleft("key", 16).bitwiseOR(positional(F.col("fingerprint"), places)).alias("key"),
            )
            for j, places in enumerate(further(i))
        ]
        ways.append(F.when(F.col("choice") == i, F.array(*two)))
    way = F.explode(F.coalesce(*ways)).alias("p")
    return large.select("fingerprint", "choice", way).select("fingerprint", "choice", "p.*")


def tallied(prints: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of one list, by tallies of shared positional bytes."""
    parts = prints.view(np.uint8).reshape(-1, BYTES)
    tally = np.zeros((len(prints), len(prints)), np.uint8)
    for p in range(BYTES):
        tally += parts[:, p, None] == parts[None, :, p]
    a, b = np.nonzero(np.triu(tally >= BYTES - bits, 1))
    near = np.bitwise_count(prints[a] ^ prints[b]) <= bits
    root = list(range(len(prints)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for x, y in zip(a[near].tolist(), b[near].tolist(), strict=True):
        u, v = find(x), find(y)
        if u != v:
            root[max(u, v)] = min(u, v)
            links.append((x, y))
    return links


def addressed(prints: np.ndarray, places: tuple[int, ...], bits: int) -> list[tuple[int, int]]:
    """Links of the members of a list that differ at two positions only, each to its component's first.

    The two bytes address a table of 65,536 entries; neighbours are the addresses with up
    to ``bits`` bits flipped. Labels fall to the least of the neighbours' until all agree.
    """
    parts = prints.view(np.uint8).reshape(-1, BYTES)
    at = parts[:, places[0]].astype(np.int64) << 8 | parts[:, places[1]]
    label = np.full(1 << 16, len(prints), np.int64)
    label[at] = np.arange(len(prints))
    flips = [sum(1 << b for b in c) for k in range(1, bits + 1) for c in combinations(range(16), k)]
    while True:
        least = label[at]
        for flip in flips:
            least = np.minimum(least, label[at ^ flip])
        if (least == label[at]).all():
            break
        label[at] = least
    return [(i, int(x)) for i, x in enumerate(label[at]) if i != x]


def links_in(found: pa.Table, bits: int) -> pa.Table:
    """Links of all lists of one group of tasks."""
    found = found.sort_by([(c, "ascending") for c in ("choice", "more", "key", "fingerprint")])
    choice, more, key = (found[c].to_numpy() for c in ("choice", "more", "key"))
    signed = found["fingerprint"].to_numpy()
    new = np.ones(len(key), bool)
    new[1:] = (choice[1:] != choice[:-1]) | (more[1:] != more[:-1]) | (key[1:] != key[:-1])
    heads = np.flatnonzero(new)
    links: set[tuple[int, int]] = set()
    for lo, hi in zip(heads, np.append(heads, len(key))[1:], strict=True):
        if hi - lo < 2:
            continue
        own = signed[lo:hi].view(np.uint64)
        if hi - lo <= LIST_ROWS:
            pairs = tallied(own, bits)
        else:
            shared = KEYS[choice[lo]] + further(choice[lo])[more[lo]]
            pairs = addressed(own, tuple(p for p in range(BYTES) if p not in shared), bits)
        links.update((int(signed[lo + a]), int(signed[lo + b])) for a, b in pairs)
    out = np.array(sorted(links), np.int64).reshape(-1, 2)
    return pa.table({"a": out[:, 0], "b": out[:, 1]})


def links(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """Links (``a``, ``b``) that connect the distinct fingerprints of ``nodes``."""
    if not 0 <= bits <= BITS:
        raise ValueError("the index finds fingerprints of at most two differing bits")
    lists = stage(postings(nodes), "postings")
    tasks = max(1, -(-lists.count() // ROWS_PER_TASK))
    return (
        lists.withColumn("task", F.pmod(F.xxhash64("choice", "more", "key"), F.lit(tasks)))
        .groupBy("task")
        .applyInArrow(lambda t: links_in(t, bits), "a long, b long")
    )


def near_duplicates(docs: DataFrame, length: int = 3, bits: int = BITS) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (hexadecimal), ``component_id``."""
    prints = stage(fingerprints(docs, length), "fingerprints")
    nodes = stage(
        prints.where("doc_id IS NOT NULL").groupBy("fingerprint").agg(F.min("doc_id").alias("least")),
        "fingerprint-nodes",
    )
    found = components(links(nodes, bits)).withColumnRenamed("id", "fingerprint")
    of_print = nodes.join(found, "fingerprint", "left").withColumn(
        "component", F.coalesce("component", "fingerprint")
    )
    least = of_print.groupBy("component").agg(F.min("least").alias("of_component"))
    named = of_print.join(least, "component").select("fingerprint", "of_component")
    return prints.join(named, "fingerprint", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("of_component")).alias("component_id"),
    )
