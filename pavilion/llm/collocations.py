"""Phrases whose words belong together, counted by direct addresses in tiles of word ids.

Texts are cut into pieces and words. All counts are per language. Phrases of two to
``longest`` words that occur ``often`` are scored by the weakest place to cut them, and
those that only occur inside a longer one are dropped.

1. Words are counted: a slice of texts sends each distinct word once, Spark adds up. The
   frequent ones get ids by falling frequency within their language. Then whole documents
   are read in blocks. A block keeps its words as numbers, with gaps between pieces and
   where words are rare, and sends the 64-bit hashes of its distinct words, packed by
   bucket; the bucket answers with the ids of the frequent ones. No dictionary is broadcast.
   What is rare is mostly known by a map of ``2 ** MAP_BITS`` bits, of fixed size whatever
   the corpus; the bucket decides. Buckets with many packs are dealt to several tasks.
2. A pair of neighbouring ids has an address: the tile of ``SIDE`` by ``SIDE`` ids it falls
   into, then its place in the tile. Frequent words have low ids, so their pairs crowd in
   few tiles. Blocks send their distinct addresses with counts, packed by bucket of tiles.
   In a bucket, tiles with many entries are counted by one dense ``bincount`` over direct
   addresses, the others as sorted coordinates. Buckets add up in rounds of ``FAN``
   blocks, so that the crowded tiles of very many blocks never meet in one task.
3. Frequent pairs are ranked anew by frequency, and their ids take the place of words. The
   same step then counts pairs of overlapping pairs, which are the phrases of three words,
   and so on. A phrase can only be frequent if its two longest parts are.
4. A phrase carries the counts of its beginnings and ends, got from its parts by two
   equi-joins a level, so scores need no further look at the texts. Products are decimals
   of 38 digits: exact while 1000 * a * n stays below them.
5. A longer phrase with as large a share of a phrase's occurrences implies one that is just
   one word longer, so one join by part finds what to drop.

Cases: null and empty texts have no words; a null language is ``und``; rows without an
identifier and repeated rows count like any other; fewer than ``often`` occurrences
anywhere, and empty tables, give an empty result; further columns are ignored; a text of
any length is read whole. More than 2**32 frequent phrases of one length are refused.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pavilion.functions.staging import stage
from pavilion.llm.arrays import LOWER, Texts, mixed, range_hashes, slices, sums
from pavilion.llm.homes import packed, runs_of, unpacked
from pavilion.operators.positions import positions

NO_LANGUAGE = "und"
GAPS = b" \t"
BREAKS = b".,;:!?\n\x0b\x0c\r"
KIND = np.zeros(256, np.uint8)
KIND[list(GAPS)], KIND[list(BREAKS)] = 1, 2

BLOCK_BYTES = 4 << 20
# log2 of the side of a tile
SIDE_BITS = 6
TILE_BITS = 2 * SIDE_BITS
DENSE = (1 << TILE_BITS) // 8
TILES_AT_ONCE = 512
ENTRIES = 500_000
FAN = 32
ID_BITS = 32

MAP_BITS = 26
CHUNK_BITS = 15

# a block: its sequence, and the hashes of its words at the first level
BLOCKS = "block long, n long, data binary, many long, keys binary"
PACKS = "bucket long, block long, n long, data binary"
NAMES = ["bucket", "block", "n", "data"]


def words_in(texts: Texts) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of a slice; where a new piece begins; the document of each word."""
    data = LOWER[texts.data]
    kind = KIND[data]
    inside = kind == 0
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    filled = texts.ends > texts.starts
    begins[texts.starts[filled]] |= inside[texts.starts[filled]]
    stops[texts.ends[filled] - 1] |= inside[texts.ends[filled] - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    edges = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(edges.tobytes()), pa.py_buffer(data[inside].tobytes())
    )
    doc = texts.doc_of(starts)
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts] if len(starts) else starts
    new = np.ones(len(starts), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (doc[1:] != doc[:-1])
    return words, new, doc


def packed_ids(ids: np.ndarray) -> bytes:
    """Ids from 0, a gap is -1."""
    return packed([(ids + 1).astype(np.uint32)], deltas=False)


def unpacked_ids(data: bytes, n: int) -> np.ndarray:
    return unpacked(data, n, [np.uint32], deltas=False)[0].astype(np.int64) - 1


def without_gaps(ids: np.ndarray) -> np.ndarray:
    """One gap stays of neighbouring ones, and none at the beginning; nothing is one gap."""
    keep = ids >= 0
    keep[1:] |= keep[:-1].copy()
    return ids[keep] if keep.any() else np.full(1, -1, np.int64)


@dataclass(frozen=True)
class Spoken:
    """Words of a slice by language: the distinct ones, and which one each word is."""

    langs: pa.Array
    words: pa.Array
    counts: np.ndarray
    places: np.ndarray
    new: np.ndarray

    @classmethod
    def of(cls, texts: Texts, langs: pa.Array) -> Spoken:
        words, new, doc = words_in(texts)
        coded, spoken = words.dictionary_encode(), langs.dictionary_encode()
        many = max(1, len(coded.dictionary))
        lang = spoken.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        both = lang[doc] * many + coded.indices.to_numpy(zero_copy_only=False)
        del words, doc
        found, places, counts = np.unique(both, return_inverse=True, return_counts=True)
        own = [spoken.dictionary.take(pa.array(found // many)), coded.dictionary.take(pa.array(found % many))]
        return cls(*(x.cast(pa.string()) for x in own), counts, places, new)


def string_hashes(column: pa.Array) -> np.ndarray:
    column = column.cast(pa.large_string())
    _, places, data = column.buffers()
    edges = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    base = int(edges[0])
    return range_hashes(sums(raw[base : edges[-1]]), edges[:-1] - base, edges[1:] - base)


def word_hashes(langs: pa.Array, words: pa.Array) -> np.ndarray:
    if not len(words):
        return np.zeros(0, np.uint64)
    return mixed(string_hashes(words) + mixed(string_hashes(langs)))


def slices_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Spoken]:
    """Slices of whole documents of ``lang`` and ``text``."""
    for batch in batches:
        langs = pc.fill_null(batch.column(0), NO_LANGUAGE)
        for texts in slices(batch.column(1), BLOCK_BYTES):
            yield Spoken.of(texts, langs.slice(texts.first, len(texts.starts)))


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``word`` and ``n`` of the distinct words of every slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices_of(batches):
            yield pa.RecordBatch.from_arrays([s.langs, s.words, pa.array(s.counts)], names=["lang", "word", "n"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, word string, n long")


def hash_map(rows: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray]) -> Broadcast:
    """A broadcast map with a bit for each hash: ``2 ** MAP_BITS`` bits, whatever the rows."""
    width = 1 << (CHUNK_BITS - 3)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (MAP_BITS - 3), np.uint8)
        for batch in batches:
            at = hashes(batch) >> np.uint64(64 - MAP_BITS)
            np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(128) >> (at & np.uint64(7)).astype(np.uint8))
        chunks = bits.reshape(-1, width)
        used = np.flatnonzero(chunks.any(1))
        data = [chunks[i].tobytes() for i in used]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(data, pa.binary())], names=["chunk", "data"])

    def join(found: pa.Table) -> pa.Table:
        parts = [np.frombuffer(d, np.uint8) for d in found["data"].to_pylist()]
        data = np.bitwise_or.reduce(parts).tobytes()
        return pa.table({"chunk": found["chunk"][:1], "data": pa.array([data], pa.binary())})

    schema = "chunk long, data binary"
    found = rows.mapInArrow(mark, schema).groupBy("chunk").applyInArrow(join, schema)
    out = np.zeros((1 << (MAP_BITS - CHUNK_BITS), width), np.uint8)
    for row in found.collect():  # 2 ** MAP_BITS bits in all
        out[row["chunk"]] = np.frombuffer(row["data"], np.uint8)
    return rows.sparkSession.sparkContext.broadcast(out.ravel())


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - MAP_BITS)
    return (bits[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1


def block_table(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary())
    names = ("block", "n", "data", "many", "keys")
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=list(names))


def read_blocks(docs: DataFrame, frequent: Broadcast) -> DataFrame:
    """The sequences of all documents in the block's own numbers of words that may be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << ID_BITS
        for s in slices_of(batches):
            hashes = word_hashes(s.langs, s.words)
            may = marked(frequent.value, hashes)
            order = np.argsort(hashes[may], kind="stable")
            local = np.full(len(may), -1, np.int64)
            local[np.flatnonzero(may)[order]] = np.arange(len(order))
            # a gap before each piece; a block without words is one gap
            ids = np.full(max(1, len(s.places) + int(s.new.sum())), -1, np.int64)
            ids[np.arange(len(s.places)) + np.cumsum(s.new)] = local[s.places]
            ids, keys = without_gaps(ids), hashes[may][order]
            data = packed([keys]) if len(keys) else b""
            yield from block_table([(block, len(ids), packed_ids(ids), len(keys), data)]).to_batches()
            block += 1

    return docs.select("lang", "text").mapInArrow(run, BLOCKS)


def keys_of(row: dict) -> np.ndarray:
    return unpacked(row["keys"], row["many"], [np.uint64])[0] if row["many"] else np.zeros(0, np.uint64)


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of the keys by bucket, and each bucket's range in it; a tile is in one bucket."""
    bucket = mixed(keys >> np.uint64(TILE_BITS)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    return order, [(int(bucket[lo]), lo, hi) for lo, hi in (runs_of(bucket) if len(bucket) else [])]


def asked_words(blocks: DataFrame, buckets: int) -> DataFrame:
    """The hashes of each block's words, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = keys_of(row)
                order, parts = by_bucket(keys, buckets)
                rows = [(b, row["block"], hi - lo, packed([keys[order[lo:hi]]])) for b, lo, hi in parts]
                yield from pack_table(rows).to_batches()

    return blocks.select("block", "many", "keys").mapInArrow(run, PACKS)


def asked_pairs(packs: DataFrame, frequent: Broadcast) -> DataFrame:
    """The pairs of each block that may be frequent, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                keys, _ = unpacked(row["data"], row["n"], (np.uint64, np.uint32))
                keys = keys[marked(frequent.value, mixed(keys))]
                if len(keys):
                    rows.append((row["bucket"], row["block"], len(keys), packed([keys])))
            yield from pack_table(rows).to_batches()

    return packs.mapInArrow(run, PACKS)


def known_ids(rows: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], buckets: int) -> DataFrame:
    """Keys and ids of the frequent phrases (``id`` is the last column), packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = hashes(batch), batch.column(batch.num_columns - 1).to_numpy().astype(np.uint32)
            order = np.argsort(keys, kind="stable")
            keys, ids = keys[order], ids[order]
            order, parts = by_bucket(keys, buckets)
            found = [(b, -1, hi - lo, packed([keys[order[lo:hi]], ids[order[lo:hi]]])) for b, lo, hi in parts]
            yield from pack_table(found).to_batches()

    return rows.mapInArrow(run, PACKS)


def answer(found: pa.Table) -> pa.Table:
    """Per block the ids of its keys, in the order in which it asked; a gap where there is none."""
    rows = found.select(NAMES).to_pylist()
    known = [unpacked(r["data"], r["n"], (np.uint64, np.uint32)) for r in rows if r["block"] < 0]
    out = []
    if known:
        keys, ids = (np.concatenate([k[i] for k in known]) for i in range(2))
        order = np.argsort(keys, kind="stable")
        keys, ids = keys[order], ids[order]
        for r in rows:
            if r["block"] >= 0:
                (own,) = unpacked(r["data"], r["n"], [np.uint64])
                at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                hit = keys[at] == own
                if hit.any():
                    told = np.where(hit, ids[at].astype(np.int64), -1)
                    out.append((r["bucket"], r["block"], len(told), packed_ids(told)))
    return pack_table(out)


def answers(asked: DataFrame, known: DataFrame) -> DataFrame:
    """Ids for every block, from buckets; those with many keys are dealt to several tasks."""
    salts = asked.groupBy("bucket").agg(F.ceil(F.sum("n") / F.lit(ENTRIES)).alias("salts"))
    salted = asked.join(salts, "bucket").withColumn("salt", F.pmod(F.xxhash64("block"), F.col("salts")))
    copied = known.join(salts, "bucket").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))
    )
    return salted.unionByName(copied).groupBy("bucket", "salt").applyInArrow(answer, PACKS)


def renumbering(buckets: int, frequent: Broadcast | None) -> Callable:
    """A block's sequence in new ids, from answers to what it asked; what is not known is a gap.

    At the first level the keys are the hashes of words; later they are the addresses of
    pairs, of which those were asked that may be frequent.
    """

    def run(found: pa.Table) -> pa.Table:
        rows = found.to_pylist()
        row = next(r for r in rows if r["bucket"] is None)
        before = unpacked_ids(row["data"], row["n"])
        known = before >= 0
        if frequent is None:
            keys, places = keys_of(row), before
        else:
            known = known[:-1] & known[1:]
            keys, inverse = np.unique(address(before[:-1][known], before[1:][known]), return_inverse=True)
            places = np.full(len(known), -1, np.int64)
            places[known] = inverse
        order, parts = by_bucket(keys, buckets)
        ranges = {b: order[lo:hi] for b, lo, hi in parts}
        ids = np.full(len(keys) + 1, -1, np.int64)  # the last one is for gaps
        for r in rows:
            if r["bucket"] is not None:
                own = ranges[r["bucket"]]
                if frequent is not None:
                    own = own[marked(frequent.value, mixed(keys[own]))]
                ids[own] = unpacked_ids(r["data"], r["n"])
        after = without_gaps(ids[places])
        return block_table([(row["block"], len(after), packed_ids(after), 0, None)])

    return run


def renumber(blocks: DataFrame, told: DataFrame, buckets: int, frequent: Broadcast | None) -> DataFrame:
    """The sequences of all blocks in new ids."""
    rows = blocks.unionByName(told, allowMissingColumns=True)
    return rows.groupBy("block").applyInArrow(renumbering(buckets, frequent), BLOCKS)


def address(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Tile of a pair of ids, then its place in the tile."""
    a, b = a.astype(np.uint64), b.astype(np.uint64)
    s, low = np.uint64(SIDE_BITS), np.uint64((1 << SIDE_BITS) - 1)
    tile = ((a >> s) << np.uint64(ID_BITS - SIDE_BITS)) | (b >> s)
    return (tile << np.uint64(TILE_BITS)) | ((a & low) << s) | (b & low)


def pair_at(addresses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the pairs at these addresses."""
    s, low = np.uint64(SIDE_BITS), np.uint64((1 << SIDE_BITS) - 1)
    tile = addresses >> np.uint64(TILE_BITS)
    high = np.uint64((1 << (ID_BITS - SIDE_BITS)) - 1)
    a = ((tile >> np.uint64(ID_BITS - SIDE_BITS)) << s) | ((addresses >> s) & low)
    b = ((tile & high) << s) | (addresses & low)
    return a.astype(np.int64), b.astype(np.int64)


def added(addresses: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts by address, in order of addresses.

    Tiles with ``DENSE`` entries or more are arrays that addresses index directly; the
    entries of the others are sorted coordinates.
    """
    if not len(addresses):
        return addresses, counts
    tile = addresses >> np.uint64(TILE_BITS)
    tiles, slot, entries = np.unique(tile, return_inverse=True, return_counts=True)
    dense = np.flatnonzero(entries >= DENSE)
    place = np.full(len(tiles), -1, np.int64)
    place[dense] = np.arange(len(dense))
    where = place[slot]
    inner = (addresses & np.uint64((1 << TILE_BITS) - 1)).astype(np.int64)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for first in range(0, len(dense), TILES_AT_ONCE):
        own = (where >= first) & (where < first + TILES_AT_ONCE)
        size = min(TILES_AT_ONCE, len(dense) - first) << TILE_BITS
        cells = np.bincount(((where[own] - first) << TILE_BITS) | inner[own], counts[own], size)
        full = np.flatnonzero(cells)
        base = tiles[dense[first + (full >> TILE_BITS)]] << np.uint64(TILE_BITS)
        found = base | (full & ((1 << TILE_BITS) - 1)).astype(np.uint64)
        out.append((found, cells[full].astype(np.int64)))
    sparse = where < 0
    order = np.argsort(addresses[sparse], kind="stable")
    rest, many = addresses[sparse][order], counts[sparse][order]
    heads = np.flatnonzero(np.append(True, rest[1:] != rest[:-1])) if len(rest) else order
    if len(rest):
        out.append((rest[heads], np.add.reduceat(many, heads)))
    every = np.concatenate([a for a, _ in out])
    sums = np.concatenate([c for _, c in out])
    order = np.argsort(every, kind="stable")
    return every[order], sums[order]


def send_pairs(blocks: DataFrame, buckets: int) -> DataFrame:
    """Distinct pairs of neighbouring ids of each block with counts, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpacked_ids(row["data"], row["n"])
                a, b = ids[:-1], ids[1:]
                ok = (a >= 0) & (b >= 0)
                found, counts = np.unique(address(a[ok], b[ok]), return_counts=True)
                counts = counts.astype(np.uint32)
                order, parts = by_bucket(found, buckets)
                rows = [
                    (b, row["block"], hi - lo, packed([found[order[lo:hi]], counts[order[lo:hi]]]))
                    for b, lo, hi in parts
                ]
                yield from pack_table(rows).to_batches()

    return blocks.select("block", "n", "data").mapInArrow(run, PACKS)


def pack_table(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=NAMES)


def sums_of(found: pa.Table, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Sums by address over all packs of a group."""
    parts = [unpacked(r["data"], r["n"], (np.uint64, kind)) for r in found.select(["n", "data"]).to_pylist()]
    addresses = np.concatenate([np.zeros(0, np.uint64), *(p[0] for p in parts)])
    counts = np.concatenate([np.zeros(0, np.int64), *(p[1].astype(np.int64) for p in parts)])
    return added(addresses, counts)


def combined(kind: type) -> Callable:
    """Adds up the packs of a bucket and a group of blocks."""

    def run(key, found):
        addresses, counts = sums_of(found, kind)
        return pack_table([(key[0].as_py(), key[1].as_py(), len(counts), packed([addresses, counts]))])

    return run


def often_enough(kind: type, often: int) -> Callable:
    """Adds up the packs of a bucket and keeps the pairs that occur ``often``."""

    def run(found: pa.Table) -> pa.Table:
        addresses, counts = sums_of(found, kind)
        many = counts >= often
        a, b = pair_at(addresses[many])
        return pa.table({"a": a, "b": b, "f": counts[many]})

    return run


def count_pairs(packs: DataFrame, n_blocks: int, often: int) -> DataFrame:
    """``a``, ``b`` and ``f`` of all pairs that occur ``often`` over all blocks."""
    kind: type = np.uint32
    groups = -(-n_blocks // FAN)
    packs = packs.withColumn("block", F.pmod(F.xxhash64("block"), F.lit(groups)))
    while groups > 1:
        packs = packs.groupBy("bucket", "block").applyInArrow(combined(kind), PACKS)
        packs = packs.withColumn("block", F.expr(f"block div {FAN}"))
        kind, groups = np.int64, -(-groups // FAN)
    return packs.groupBy("bucket").applyInArrow(often_enough(kind, often), "a long, b long, f long")


def address_column(a: str, b: str) -> Column:
    """``address`` as an expression on non-negative longs."""
    low = F.lit((1 << SIDE_BITS) - 1)
    high_a, high_b = F.shiftright(a, SIDE_BITS), F.shiftright(b, SIDE_BITS)
    tile = F.shiftleft(high_a, ID_BITS - SIDE_BITS).bitwiseOR(high_b)
    inner = F.shiftleft(F.col(a).bitwiseAND(low), SIDE_BITS).bitwiseOR(F.col(b).bitwiseAND(low))
    return F.shiftleft(tile, TILE_BITS).bitwiseOR(inner)


def ranked(phrases: DataFrame) -> DataFrame:
    """``id`` by falling frequency within the language."""
    ordered = phrases.withColumn("minus", -F.col("f"))
    placed = positions(ordered, ["lang", "minus", "phrase"], name="id", strategy="distributed")
    return placed.withColumn("id", F.col("id") - 1).drop("minus")


def joined_parts(pairs: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases from pairs of overlapping shorter ones, with counts of beginnings and ends."""
    left = shorter.select(F.col("id").alias("a"), "lang", "phrase", "pre")
    right = shorter.select(F.col("id").alias("b"), "last", "suf")
    return pairs.join(left, "a").join(right, "b").select(
        "lang",
        F.concat("phrase", F.lit(" "), "last").alias("phrase"),
        "last",
        "f",
        "a",
        "b",
        F.concat("pre", F.array("f")).alias("pre"),
        F.concat("suf", F.array("f")).alias("suf"),
    )


@dataclass(frozen=True)
class Mined:
    """``totals``: words per language; ``levels``: frequent phrases of 1, 2, ... words."""

    totals: DataFrame
    levels: list[DataFrame]


def mine(docs: DataFrame, longest: int = 5, often: int = 100) -> Mined:
    """All phrases of up to ``longest`` words that occur ``often`` in their language."""
    counts = stage(
        word_counts(docs).groupBy("lang", "word").agg(F.sum("n").alias("f")), "phrase-counts"
    )
    totals = stage(counts.groupBy("lang").agg(F.sum("f").alias("n")), "phrase-totals")
    counted = counts.where(F.col("f") >= often)
    first = stage(ranked(counted.withColumnRenamed("word", "phrase")), "phrase-words")
    first = first.select(
        "id",
        "lang",
        "phrase",
        F.col("phrase").alias("last"),
        "f",
        F.lit(None).cast("long").alias("a"),
        F.lit(None).cast("long").alias("b"),
        F.array("f").alias("pre"),
        F.array("f").alias("suf"),
    )
    levels = [first]
    by_words = lambda b: word_hashes(b.column(0), b.column(1))
    frequent = hash_map(first.select("lang", "phrase"), by_words)
    blocks = stage(read_blocks(docs, frequent), "phrase-blocks")
    keys = blocks.agg(F.sum("many")).first()[0] or 0
    buckets = max(1, -(-keys // ENTRIES))
    told = answers(asked_words(blocks, buckets), known_ids(first.select("lang", "phrase", "id"), by_words, buckets))
    frequent = None
    by_address = lambda b: b.column(0).to_numpy().view(np.uint64)
    while len(levels) < longest:
        blocks = stage(renumber(blocks, told, buckets, frequent).where("n > 1"), "phrase-ids")
        size = blocks.agg(F.count("*").alias("blocks"), F.sum("n").alias("n")).first()
        buckets = max(1, -(-(size["n"] or 0) // ENTRIES))
        packs = stage(send_pairs(blocks, buckets), "phrase-pairs")
        pairs = count_pairs(packs, max(1, size["blocks"]), often)
        level = stage(ranked(joined_parts(pairs, levels[-1])), "phrases")
        largest = level.agg(F.max("id")).first()[0]
        if largest is None:
            break
        if largest >= (1 << ID_BITS) - 1:
            raise ValueError("more than 2**32 frequent phrases of one length")
        levels.append(level)
        if len(levels) < longest:
            known = level.select(address_column("a", "b").alias("key"), "id")
            frequent = hash_map(known, lambda b: mixed(by_address(b)))
            told = answers(asked_pairs(packs, frequent), known_ids(known, by_address, buckets))
    return Mined(totals, levels)


def scored(level: DataFrame, words: int) -> DataFrame:
    """The weakest cut of each phrase of this many words: ``l``, ``r`` and ``score``."""
    wide = lambda c: c.cast("decimal(38,0)")
    top = F.lit(1000).cast("decimal(38,0)") * wide(F.col("f")) * wide(F.col("n"))
    cuts = []
    for k in range(1, words):
        first, rest = F.col("pre")[k - 1], F.col("suf")[words - k - 1]
        cuts.append(
            F.struct(
                F.call_function("div", top, wide(first) * wide(rest)).cast("long").alias("score"),
                F.lit(k).alias("k"),
                first.alias("l"),
                rest.alias("r"),
            )
        )
    weakest = F.array_min(F.array(*cuts)).alias("cut")
    return level.select("lang", "phrase", "id", "f", "n", weakest).select(
        "lang", "phrase", "id", F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score"
    )


def without_inner(level: DataFrame, longer: DataFrame | None, share: int = 100) -> DataFrame:
    """Phrases of which no longer one has ``share`` percent of the occurrences."""
    if longer is None:
        return level
    inside = longer.select(F.explode(F.array("a", "b")).alias("id"), F.col("f").alias("within"))
    most = inside.groupBy("id").agg(F.max("within").alias("within"))
    free = F.col("within").isNull() | (100 * F.col("within") < share * F.col("f"))
    return level.join(most, "id", "left").where(free).drop("within")


def collocations(docs: DataFrame, longest: int = 5, often: int = 100, top: int = 2000) -> DataFrame:
    """The best phrases of each language with their rank, counts and score."""
    mined = mine(docs, longest, often)
    parts = []
    for i, level in enumerate(mined.levels[1:], start=1):
        longer = mined.levels[i + 1] if i + 1 < len(mined.levels) else None
        kept = without_inner(level, longer).join(mined.totals, "lang")
        parts.append(scored(kept, i + 1).drop("id"))
    if not parts:
        empty = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
        return docs.sparkSession.createDataFrame([], empty)
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    placed = every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return placed.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), grams AS (
    SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase
    FROM (
        SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM split, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k
    )
), counted AS (
    SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT *, string_split(phrase, ' ') AS ws FROM counted WHERE k > 1 AND f >= 100
), inner_parts AS (
    SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, max(f) AS within
    FROM (
        SELECT lang, ws, f, m, unnest(range(1, k - m + 2)) AS i
        FROM candidates, (SELECT unnest(range(2, 5)) AS m) WHERE m < k
    ) GROUP BY ALL
), kept AS (
    SELECT c.lang, c.phrase, c.k, c.f, c.ws FROM candidates c
    LEFT JOIN inner_parts p ON p.lang = c.lang AND p.phrase = c.phrase
    WHERE p.within IS NULL OR 100 * p.within < 100 * c.f
), cuts AS (
    SELECT kept.lang, kept.phrase, kept.f AS a, cut, x.f AS l, y.f AS r, n,
        (1000::HUGEINT * kept.f * n) // (x.f::HUGEINT * y.f) AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept) kept
    JOIN totals USING (lang)
    JOIN counted x ON x.lang = kept.lang AND x.phrase = array_to_string(kept.ws[1 : cut], ' ')
    JOIN counted y ON y.lang = kept.lang AND y.phrase = array_to_string(kept.ws[cut + 1 : kept.k], ' ')
), weakest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest
) WHERE rank <= 2000
"""
