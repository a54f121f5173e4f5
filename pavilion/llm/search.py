"""Exact top-k search by term-at-a-time accumulation.

Vectors become rows of integer weights, packed as bytes. Candidates are dealt into blocks;
a block keeps a posting list for each term: the rows that have it, and their weights. Query
rows are taken a tile at a time and term by term: each non-zero query weight scatters its
multiple of the posting list into a dense array of scores, one per candidate of the block.
Partition selection keeps the best of each query and block, and a window merges them.

Every pair of a query block and a candidate block is one task. Blocks hold ``BLOCK_BYTES``
of packed rows: candidates are copied once per query block (``copies``), so for queries of
a hundredth of all rows and 64 terms once per 25 million rows, and queries once per candidate block. No
pair of rows leaves a task but the best ``k`` per query and block.

Cases: vectors that are null or hold null or non-finite components take no part, nor do
rows without an identifier; every row counts by itself, also where rows share an
identifier: each is a query of its own and a candidate for the others; missing components
of shorter vectors are zero; scores beyond 64 bits are held at the limit; ties go to the
smaller identifier; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pavilion.functions.staging import stage

BLOCK_BYTES = 64 << 20
# candidates are dealt into this many blocks, if each still has so many rows
SPREAD, LEAST_ROWS = 64, 1024
# scores of a tile stay in the processor's cache
TILE_CELLS = 1 << 18
LONG_MAX = 2**63 - 1
ROWS = "row long, vec_id long, wide boolean, terms binary"


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights as bytes, four each, or eight (``wide``) if one of the batch needs them."""
    for batch in batches:
        terms = batch.column(2)
        flat = terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        wide = bool(len(flat)) and max(int(flat.max()), -int(flat.min())) >= 2**31
        kind = np.int64 if wide else np.int32
        edges = np.append(0, np.cumsum(pc.list_value_length(terms).to_numpy())) * np.dtype(kind).itemsize
        data = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(),
            len(terms),
            [None, pa.py_buffer(edges.astype(np.int64).tobytes()), pa.py_buffer(flat.astype(kind).tobytes())],
        )
        columns = [batch.column(0), batch.column(1), pa.array(np.full(len(terms), wide)), data.cast(pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "vec_id", "wide", "terms"])


def weighted_rows(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """``row``, ``vec_id`` and packed ``terms``: floor(scale * component), for whole vectors only.

    The table is written: a row keeps its number ``row`` in all later steps.
    """
    fit = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fit)
    terms = F.transform("embedding", lambda v: F.floor(v.cast("double") * float(scale)).cast("long"))
    numbered = whole.select(F.monotonically_increasing_id().alias("row"), "vec_id", terms.alias("terms"))
    return stage(numbered.mapInArrow(packed, ROWS), "vectors")


def _matrix(rows: pa.Table, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, (wide, terms) in enumerate(zip(rows["wide"].to_pylist(), rows["terms"].to_pylist(), strict=True)):
        own = np.frombuffer(terms, np.int64 if wide else np.int32)
        out[i, : len(own)] = own
    return out


def _kind(queries: np.ndarray, block: np.ndarray) -> type:
    """The smallest type in which all scores are exact."""
    top = [max(int(m.max()), -int(m.min())) if m.size else 0 for m in (queries, block)]
    most = top[0] * top[1] * max(1, block.shape[1])
    return np.int32 if most < 2**31 else np.int64 if most < 2**63 else object


def postings(block: np.ndarray, kind: type) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each term the rows that have it, and their weights."""
    out = []
    for t in range(block.shape[1]):
        rows = np.flatnonzero(block[:, t])
        out.append((rows, block[rows, t].astype(kind)))
    return out


def _scores(queries: np.ndarray, lists: list[tuple[np.ndarray, np.ndarray]], size: int, kind: type) -> np.ndarray:
    """Scores of a tile of queries against a block, one term after another."""
    scores = np.zeros((len(queries), size), kind)
    every = np.empty((len(queries), size), kind)
    for t, (rows, weights) in enumerate(lists):
        having = np.flatnonzero(queries[:, t])
        if not len(having) or not len(rows):
            continue
        own = queries[having, t].astype(kind)[:, None]
        if len(rows) < size:
            scores[np.ix_(having, rows)] += own * weights
        elif len(having) < len(queries):
            scores[having] += own * weights
        else:
            scores += np.multiply(own, weights, out=every)
    return scores


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the best ``k`` scores; equal ones in order of position."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        chosen = np.r_[above, np.flatnonzero(scores == least)[: k - len(above)]]
    else:
        chosen = np.arange(len(scores))
    return chosen[np.lexsort((chosen, -scores[chosen]))]


def search_pair(queries: pa.Table, block: pa.Table, k: int) -> pa.Table:
    """The best candidates of one block for one block of queries."""
    found: list[list] = [[], [], [], []]
    if len(queries) and len(block):
        block = block.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        width = max(
            int(pc.max(pc.binary_length(t["terms"])).as_py()) // 4 for t in (queries, block)
        )
        weights, asked = _matrix(block, width), _matrix(queries, width)
        kind = _kind(asked, weights)
        lists = postings(weights, kind)
        del weights
        rows, ids = block["row"].to_numpy(), block["vec_id"].to_numpy()
        own, names = queries["row"].to_numpy(), queries["vec_id"].to_numpy()
        step = max(1, TILE_CELLS // len(rows))
        for tile in range(0, len(own), step):
            scores = _scores(asked[tile : tile + step], lists, len(rows), kind)
            for q, row in enumerate(scores, start=tile):
                best = _best(row, k + 1)
                best = best[rows[best] != own[q]][:k]
                found[0] += [own[q]] * len(best)
                found[1] += [names[q]] * len(best)
                found[2] += ids[best].tolist()
                found[3] += [min(max(int(s), -LONG_MAX - 1), LONG_MAX) for s in row[best]]
    names = ["query", "query_id", "vec_id", "score"]
    return pa.table({n: pa.array(f, pa.int64()) for n, f in zip(names, found, strict=True)})


def copies(queries: DataFrame) -> int:
    """Query blocks, which is how often candidates are copied."""
    size = queries.agg(F.sum(F.length("terms")).alias("b")).first()["b"] or 0
    return max(1, -(-size // BLOCK_BYTES))


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the best ``k`` per query row."""
    held = candidates.agg(F.count("*").alias("n"), F.sum(F.length("terms")).alias("b")).first()
    q_blocks = copies(queries)
    c_blocks = max(1, -(-(held["b"] or 0) // BLOCK_BYTES), min(SPREAD, held["n"] // LEAST_ROWS))

    def dealt(df: DataFrame, own: int, other: int, mine: str, theirs: str) -> DataFrame:
        return df.withColumn(mine, F.pmod(F.xxhash64("row"), F.lit(own)).cast("int")).withColumn(
            theirs, F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        )

    pair = ["q_block", "c_block"]
    asked = dealt(queries, q_blocks, c_blocks, *pair).groupBy(*pair)
    blocks = dealt(candidates, c_blocks, q_blocks, "c_block", "q_block").groupBy(*pair)
    best = asked.cogroup(blocks).applyInArrow(
        lambda q, c: search_pair(q, c, k), "query long, query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH rows AS (
  SELECT row_number() OVER () AS place, vec_id,
    list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS terms
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), numbered AS MATERIALIZED (SELECT * FROM rows), scored AS (
  SELECT q.place AS query, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(
      list_zip(q.terms, c.terms), lambda p: coalesce(p[1] * p[2], 0))) AS BIGINT) AS score
  FROM numbered q JOIN numbered c ON q.vec_id % 100 = 0 AND q.place <> c.place
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
