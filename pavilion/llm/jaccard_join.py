"""N-gram Jaccard join with a prefix tree, and its connected components.

Two sets of word shingles link if their Jaccard similarity reaches a threshold. Equal sets
are one set from the start; links between different sets are found in these steps:

1. Sets are put into a global order, rarest shingles first (``shingle_sets``). Linked sets
   share a shingle within short prefixes: of the smaller set's prefix for indexing and the
   larger one's for probing. Prefixes meet in buckets of hashes; what has no partner of a
   fitting size is dropped.
2. Sets that share a prefix shingle are compared by sketches: counts of shingles per range
   of hashes bound the overlap from above. Bounds that reach the threshold make candidate
   links; candidate components are the families to be joined.
3. A family's sets are stored in a trie, commonest shingles first, so its sets share long
   paths. All sets of the other side walk down together and share the overlap with a path;
   subtrees are left where overlap and remaining lengths cannot reach the threshold, or
   where everything is linked already. Overlaps at leaves are exact. Families larger than
   a block are split into pairs of blocks.
4. Links give components; equal sets have their representative's.

No pair is ever lost: prefixes, sizes, sketches and remaining lengths are bounds. Shingles
are 64-bit hashes. Within a family, links that would join what is linked already are
skipped, as components are what is returned.

Cases: null texts and texts without words have empty sets and link with nothing; rows
without an identifier have no component and link with nothing; rows of one identifier are
one document in components; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pavilion.functions.staging import stage
from pavilion.llm import homes as H
from pavilion.llm.arrays import mixed, slices
from pavilion.llm.components import components
from pavilion.llm.names import columns_of, free_names
from pavilion.llm.shingle_sets import CELL_BITS, cell_counts, rarest_first, sets_of

ENTRIES = 500_000
BLOCK_SETS = 512
BLOCK_SHINGLES = 1_000_000
FAMILY_SHINGLES = 1_000_000
SKETCH_OF = 8
SETS = "doc_id long, n long, h1 long, h2 long, prefix binary, sketch binary"
PREFIX = (np.uint64, np.int64, np.uint32, np.uint8)


@dataclass(frozen=True)
class Threshold:
    """Similarity of at least ``numerator / denominator``; all bounds in whole numbers."""

    numerator: int = 85
    denominator: int = 100

    def overlap(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least overlap of linked sets of these sizes."""
        t, d = self.numerator, self.denominator
        return -(-t * (a + b) // (t + d))

    def probing(self, n: int) -> int:
        """Prefix of a set that shares a shingle with any smaller linked set."""
        return n - -(-self.numerator * n // self.denominator) + 1

    def indexing(self, n: int) -> int:
        """Prefix of a set that shares a shingle with any linked set not smaller."""
        return n - int(self.overlap(np.int64(n), np.int64(n))) + 1

    def fit(self, small: np.ndarray, large: np.ndarray) -> np.ndarray:
        return self.denominator * small >= self.numerator * large

    def linked(self, overlap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.denominator * overlap >= self.numerator * (a + b - overlap)

    def checked(self) -> Threshold:
        if not Fraction(1, 2) <= Fraction(self.numerator, self.denominator) <= 1:
            raise ValueError("the threshold must lie between 1/2 and 1")
        return self


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Numbers of shingles per equal range of hashes, about ``SKETCH_OF`` each."""
    bits = max(3, min(16, int(len(hashes) // SKETCH_OF).bit_length()))
    at = (mixed(hashes.copy()) >> np.uint64(64 - bits)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=1 << bits), 2**16 - 1).astype(np.uint16)


def measured_sets(docs: DataFrame, length: int, limit: Threshold, cells) -> DataFrame:
    """A row per document: size, digest, prefix and sketch of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = cells.value
        for batch in batches:
            for texts in slices(batch.column(1)):
                sets = sets_of(texts, length)
                rows = []
                for s in sets:
                    ordered = rarest_first(s, counts)
                    digest = np.array(
                        [np.bitwise_xor.reduce(mixed(s + np.uint64(1))), mixed(s).sum(dtype=np.uint64)]
                    ).view(np.int64)
                    prefix = ordered[: limit.probing(len(s))] if len(s) else ordered
                    rows.append((len(s), *digest.tolist(), prefix.tobytes(), sketch(s).tobytes()))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
                ids = batch.column(0).slice(texts.first, len(sets))
                names = ["doc_id", "n", "h1", "h2", "prefix", "sketch"]
                yield pa.RecordBatch.from_arrays([ids, *columns], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, SETS)


def send_prefixes(sets: DataFrame, limit: Threshold, buckets: int) -> DataFrame:
    """Prefixes of distinct sets, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, prefixes = (batch.column(i).to_pylist() for i in range(3))
            parts = [np.frombuffer(p, np.uint64) for p in prefixes]
            if not parts:
                continue
            many = np.array([len(p) for p in parts])
            inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            indexed = inner < np.repeat([limit.indexing(n) for n in sizes], many)
            shingles = np.concatenate(parts)
            order = np.argsort(shingles, kind="stable")
            columns = [
                shingles[order],
                np.repeat(np.array(ids, np.int64), many)[order],
                np.repeat(np.array(sizes, np.uint32), many)[order],
                indexed.astype(np.uint8)[order],
            ]
            rows = [
                (bucket, 0, 0, part.stop - part.start, H.packed([c[part] for c in columns]))
                for bucket, part in H.by_bucket(columns[0] >> np.uint64(64 - H.KEY_BITS), buckets)
            ]
            yield from H.table(rows).to_batches()

    return sets.select("doc_id", "n", "prefix").mapInArrow(run, H.PACK)


def sharing(found: pa.Table, limit: Threshold) -> pa.Table:
    """Shingle and set, where another set of fitting size has the shingle in its prefix."""
    _, (shingle, ids, size, indexed) = H.packs(found, 0, PREFIX)
    size = size.astype(np.int64)
    order = np.lexsort((1 - indexed, size, shingle))
    shingle, ids, size, indexed = shingle[order], ids[order], size[order], indexed[order].astype(bool)
    n = len(ids)
    if n == 0:
        return pa.table({"shingle": pa.array([], pa.int64()), "doc_id": pa.array([], pa.int64())})
    # the nearest indexed set before, not larger, decides for a probing set
    last = np.maximum.accumulate(np.where(indexed, np.arange(n), -1))
    last = np.append(-1, last[:-1])
    before = np.maximum(last, 0)
    probes = (last >= 0) & (shingle[before] == shingle) & limit.fit(size[before], size)
    indexes = np.zeros(n, bool)
    indexes[:-1] = indexed[:-1] & (shingle[1:] == shingle[:-1]) & limit.fit(size[:-1], size[1:])
    keep = probes | indexes
    return pa.table({"shingle": shingle[keep].view(np.int64), "doc_id": ids[keep]})


def folded(rows: list[np.ndarray], width: int) -> np.ndarray:
    return np.stack([r.astype(np.int64).reshape(width, -1).sum(1) for r in rows])


def candidate_links(ids: np.ndarray, sizes: np.ndarray, sketches: list[np.ndarray], limit: Threshold) -> list[tuple]:
    """Links of a spanning forest of the sets whose sketches allow the threshold."""
    order = np.argsort(sizes, kind="stable")
    ids, sizes = ids[order], sizes[order]
    links = []
    cuts = np.flatnonzero(~limit.fit(sizes[:-1], sizes[1:])) + 1
    for part in np.split(np.arange(len(ids)), cuts):
        if len(part) < 2:
            continue
        width = min(len(sketches[order[i]]) for i in part)
        counts = folded([sketches[order[i]] for i in part], width)
        n = sizes[part]
        open_ = np.arange(len(part))
        while len(open_):
            todo, open_ = [int(open_[0])], open_[1:]
            while todo and len(open_):
                x = todo.pop()
                bound = np.minimum(counts[open_], counts[x]).sum(1)
                fit = limit.fit(np.minimum(n[open_], n[x]), np.maximum(n[open_], n[x]))
                near = fit & (bound >= limit.overlap(n[open_], n[x]))
                links += [(int(ids[part[x]]), int(ids[part[y]])) for y in open_[near]]
                todo += open_[near].tolist()
                open_ = open_[~near]
    return links


def compare_sketches(found: pa.Table, limit: Threshold) -> pa.Table:
    """Candidate links among the sets of each shingle of a bucket."""
    found = found.sort_by([("shingle", "ascending"), ("doc_id", "ascending")])
    shingle, ids, sizes = (found[c].to_numpy() for c in ("shingle", "doc_id", "n"))
    raw = found["sketch"].to_pylist()
    links: set[tuple[int, int]] = set()
    for lo, hi in H.runs_of(shingle):
        if hi - lo > 1:
            own = [np.frombuffer(r, np.uint16) for r in raw[lo:hi]]
            links.update(candidate_links(ids[lo:hi], sizes[lo:hi], own, limit))
    pairs = np.array(sorted(links), np.int64).reshape(-1, 2)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


class Trie:
    """Sets as paths of ranks in a global order, kept as sorted rows with common prefixes."""

    def __init__(self, rows: list[np.ndarray], stored: np.ndarray):
        self.at = np.array(sorted(stored, key=lambda i: rows[i].astype(">u4").tobytes()), np.int64)
        self.rows = [rows[i] for i in self.at]
        self.shared = np.zeros(len(self.at), np.int64)  # with the row before
        for k in range(1, len(self.at)):
            a, b = self.rows[k - 1], self.rows[k]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            self.shared[k] = differ[0] if len(differ) else m


def trie_links(rows: list[np.ndarray], stored: np.ndarray, probing: np.ndarray, limit: Threshold, parts: np.ndarray) -> list[tuple[int, int]]:
    """Links between stored and probing sets that join different ``parts``.

    ``parts`` is the component of each set so far, and is brought up to date.
    """
    trie = Trie(rows, stored)
    sizes = np.array([len(r) for r in rows])
    n_probe, n_trie = sizes[probing], sizes[trie.at]
    flat = np.concatenate([rows[i] for i in probing]).astype(np.int64)
    owner = np.repeat(np.arange(len(probing)), n_probe)
    ranks = int(max(flat.max(), max(int(r[-1]) for r in trie.rows))) + 1
    order = np.argsort(flat, kind="stable")
    holders = owner[order]
    first = np.searchsorted(flat[order], np.arange(ranks + 1))
    keyed = owner * ranks + flat  # sorted: owners in order, ranks ascending in each
    base = np.cumsum(n_probe) - n_probe
    links: list[tuple[int, int]] = []
    # range of stored rows, depth so far, overlap of each probing set with the path
    stack = [(0, len(trie.at), 0, np.zeros(len(probing), np.int64))]
    while stack:
        lo, hi, depth, overlap = stack.pop()
        end = int(trie.shared[lo + 1 : hi].min()) if hi - lo > 1 else int(n_trie[lo])
        edge = trie.rows[lo][depth:end]
        if len(edge):
            found = [holders[first[t] : first[t + 1]] for t in edge]
            overlap = overlap + np.bincount(np.concatenate(found), minlength=len(probing))
        inside = n_trie[lo:hi]
        last = int(trie.rows[lo][end - 1]) if end else -1
        used = np.searchsorted(keyed, np.arange(len(probing)) * ranks + last, "right") - base
        reach = overlap + np.minimum(n_probe - used, int(inside.max()) - end)
        needed = limit.overlap(n_probe, np.int64(inside.min()))
        live = reach >= needed
        own = parts[trie.at[lo:hi]]
        if (own == own[0]).all():
            live &= parts[probing] != own[0]
        if not live.any():
            continue
        if hi - lo == 1:
            hit = live & limit.linked(overlap, n_probe, inside[0])
            for p in np.flatnonzero(hit):
                a, b = parts[trie.at[lo]], parts[probing[p]]
                if a != b:
                    links.append((int(trie.at[lo]), int(probing[p])))
                    parts[parts == max(a, b)] = min(a, b)
            continue
        cuts = [lo, *(np.flatnonzero(trie.shared[lo + 1 : hi] == end) + lo + 1), hi]
        stack += [(a, b, end, overlap) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return links


def join_families(found: pa.Table, limit: Threshold, cells: np.ndarray) -> pa.Table:
    """Exact links of the families, or pairs of their blocks, in one task group."""
    names = ["family", "b1", "b2"]
    found = found.sort_by([(n, "ascending") for n in [*names, "doc_id"]])
    keys = [found[n].to_numpy() for n in names]
    ids, block = found["doc_id"].to_numpy(), found["block"].to_numpy()
    raw = found["shingles"].to_pylist()
    new = np.ones(len(ids), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    heads = np.flatnonzero(new)
    links: list[tuple[int, int]] = []
    for lo, hi in zip(heads, np.append(heads, len(ids))[1:], strict=True):
        if hi - lo < 2:
            continue
        sets = [np.frombuffer(r, np.uint64) for r in raw[lo:hi]]
        every, inverse = np.unique(np.concatenate(sets), return_inverse=True)
        often = cells[(every >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
        rank = np.empty(len(every), np.uint32)
        rank[np.lexsort((every, -often))] = np.arange(len(every), dtype=np.uint32)
        edges = np.cumsum([0, *(len(s) for s in sets)])
        rows = [np.sort(rank[inverse[a:b]]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        one, two = keys[1][lo], keys[2][lo]
        at = np.arange(hi - lo)
        stored = at[block[lo:hi] == one] if one != two else at
        probing = at[block[lo:hi] == two] if one != two else at
        if len(stored) and len(probing):
            parts = np.arange(hi - lo)
            links += [(int(ids[lo + a]), int(ids[lo + b])) for a, b in trie_links(rows, stored, probing, limit, parts)]
    pairs = np.array(sorted(set(links)), np.int64).reshape(-1, 2)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def with_blocks(families: DataFrame, sizes: DataFrame) -> DataFrame:
    """``doc_id``, ``family``, its number of ``blocks`` and the set's ``block``."""
    members = families.select(F.col("id").alias("doc_id"), F.col("component").alias("family"))
    members = members.join(sizes, "doc_id")
    count = F.greatest(
        F.ceil(F.count("*") / F.lit(BLOCK_SETS)), F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES))
    )
    blocks = members.groupBy("family").agg(count.cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    return members.join(blocks, "family").select("doc_id", "family", "blocks", block.alias("block"))


def links_in(docs: DataFrame, members: DataFrame, length: int, limit: Threshold, cells, buckets: int) -> DataFrame:
    """Exact links within families."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(4)):
                sets = sets_of(texts, length)
                part = batch.slice(texts.first, len(sets))
                shingles = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(4)), shingles],
                    names=["doc_id", "family", "blocks", "block", "shingles"],
                )

    schema = "doc_id long, family long, blocks int, block int, shingles binary"
    sets = (
        members.join(docs.select("doc_id", "text"), "doc_id")
        .select("doc_id", "family", "blocks", "block", "text")
        .mapInArrow(run, schema)
        .where(F.length("shingles") > 0)
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = sets.withColumn("other", other).select(
        "doc_id",
        "family",
        F.least("block", "other").alias("b1"),
        F.greatest("block", "other").alias("b2"),
        "block",
        "shingles",
    )
    group = F.pmod(F.xxhash64("family", "b1", "b2"), F.lit(buckets))
    return pairs.withColumn("task", group).groupBy("task").applyInArrow(
        lambda t: join_families(t, limit, cells.value), "a long, b long"
    )


@dataclass(frozen=True)
class Joined:
    """``sets``: size and digest per row; ``components``: of representatives that link."""

    sets: DataFrame
    representatives: DataFrame
    components: DataFrame


def join(docs: DataFrame, length: int, limit: Threshold) -> Joined:
    """Sets, representatives of equal sets, and components over their links."""
    spark, limit = docs.sparkSession, limit.checked()
    cells = spark.sparkContext.broadcast(cell_counts(docs, length))
    sets = stage(measured_sets(docs, length, limit, cells), "shingle-sets")
    whole = sets.where("n > 0 AND doc_id IS NOT NULL")
    representatives = stage(
        whole.groupBy("h1", "h2").agg(F.min("doc_id").alias("representative")), "equal-sets"
    )
    chosen = representatives.select(F.col("representative").alias("doc_id")).distinct()
    distinct = whole.join(chosen, "doc_id", "left_semi")
    totals = whole.agg(F.sum(F.length("prefix")).alias("p"), F.sum("n").alias("n")).first()
    buckets = max(1, -(-(totals["p"] or 0) // (8 * ENTRIES)))
    shared = (
        send_prefixes(distinct, limit, buckets)
        .groupBy("bucket")
        .applyInArrow(lambda t: sharing(t, limit), "shingle long, doc_id long")
    )
    sketched = shared.join(distinct.select("doc_id", "n", "sketch"), "doc_id")
    narrow = F.pmod(F.xxhash64("shingle"), F.lit(buckets))
    candidates = (
        sketched.withColumn("bucket", narrow)
        .groupBy("bucket")
        .applyInArrow(lambda t: compare_sketches(t.drop(["bucket"]), limit), "a long, b long")
    )
    families = components(candidates)
    sizes = whole.groupBy("doc_id").agg(F.max("n").alias("n"))
    members = stage(with_blocks(families, sizes), "families")
    tasks = max(1, -(-(totals["n"] or 0) // (4 * FAMILY_SHINGLES)))
    links = links_in(docs, members, length, limit, cells, tasks)
    return Joined(sets, representatives, components(links))


def near_duplicates(docs: DataFrame, length: int, limit: Threshold) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``."""
    joined = join(docs, length, limit)
    linked = joined.components.select(
        F.col("id").alias("representative"), F.col("component").alias("linked")
    )
    of_set = joined.representatives.join(linked, "representative", "left").select(
        "h1", "h2", F.coalesce("linked", "representative").alias("of_set")
    )
    return joined.sets.join(of_set, ["h1", "h2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("of_set")))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
    )


def one_per_component(docs: DataFrame, length: int, limit: Threshold) -> DataFrame:
    """Of each component, the document with the least identifier, in all columns.

    A document is an identifier with a text: different texts of one identifier are judged
    apart, of several that could stay the least by hash of the text does, and equal ones
    are one, the first in the order of the other columns. Rows without an identifier, and
    texts without words, stay.
    """
    mark, rank = free_names(docs.columns, "mark", "rank")
    marked = docs.where("doc_id IS NOT NULL").withColumn(mark, F.xxhash64("doc_id", "text"))
    found = near_duplicates(marked.select(F.col(mark).alias("doc_id"), "text"), length, limit)
    of = found.select(F.col("doc_id").alias(mark), F.col("component_id").alias("component")).distinct()
    ids = marked.select(mark, "doc_id").distinct()
    first = ids.join(of, mark).groupBy("component").agg(F.min(F.struct("doc_id", mark)).alias("first"))
    chosen = stage(first.select(F.col(f"first.{mark}").alias(mark)), "kept-documents")
    order = Window.partitionBy(mark).orderBy(*columns_of(docs.drop("doc_id", "text")))
    known = marked.join(chosen, mark, "left_semi").withColumn(rank, F.row_number().over(order))
    known = known.where(F.col(rank) == 1).select(*columns_of(docs))
    return known.unionByName(docs.where("doc_id IS NULL"))
