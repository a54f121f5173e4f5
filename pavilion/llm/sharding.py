"""Sharding by a keyed permutation of global row numbers.

Rows get a global number in the order of a hash of their key. A Feistel network over
the grid ``a x b`` (``a`` = ceil(sqrt(n)), ``a * b`` at least ``n``) permutes all grid
points: each round adds a keyed hash of one half to the other, modulo its length, so
every round can be undone. Points at or beyond ``n`` walk on along their cycle until they
are below ``n``; what results is a permutation of 0 to n - 1. The shard is the permuted
number modulo the number of shards and the slot is the quotient, so counts differ by one
at most, slots have no gaps, and both follow from the number alone.

The law is ``rows``: shards are equal in count, not in bytes.

Cases: a null text has no bytes and the checksum of the empty text; null or repeated
identifiers are ordinary rows; fully equal rows are interchangeable; an empty table gives
an empty result; further columns are ignored, or kept under their names by
``sharded_rows``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavilion.llm.names import free_names
from pavilion.llm.ordering import hash32, running_sum

ROUNDS = 4
LONGEST_WALK = 32


def permuted(number: Column, n: int, key: int = 0) -> Column:
    """A pseudorandom permutation of 0 to n - 1, as an expression.

    Fewer than ``ceil(sqrt(n))`` grid points lie beyond ``n``, so up to n = 1,024 no
    walk can be longer than ``LONGEST_WALK``; above, one that long has a probability
    below ``n ** -15`` and raises an error.
    """
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))

    def once(x: Column) -> Column:
        grid = F.struct((x % a).alias("left"), F.floor(x / F.lit(a)).cast("long").alias("right"))

        def added(half: Column, other: Column, size: int, turn: Column, side: int) -> Column:
            mixed = F.pmod(F.xxhash64(other, turn, F.lit(side), F.lit(key)), F.lit(size))
            return (half + mixed) % size

        def turned(g: Column, turn: Column) -> Column:
            left = added(g["left"], g["right"], a, turn, 0)
            return F.struct(
                left.alias("left"), added(g["right"], left, b, turn, 1).alias("right")
            )

        rounds = F.array(*[F.lit(i) for i in range(ROUNDS)])
        return F.aggregate(rounds, grid, turned, lambda g: g["left"] + g["right"] * a)

    steps = F.array(*[F.lit(i) for i in range(LONGEST_WALK)])
    walked = F.aggregate(
        steps, once(number.cast("long")), lambda x, _: F.when(x < n, x).otherwise(once(x))
    )
    stuck = F.raise_error(F.lit("a cycle walk did not end; use another key")).cast("long")
    return F.when(walked < n, walked).otherwise(stuck)


def numbered(df: DataFrame, key: str, ties: list[str], out: str = "row_number") -> DataFrame:
    """Number all rows from 0 in the order of a hash of ``key`` and ``ties``."""
    rows = df.count()
    hashed, one = free_names([*df.columns, out], "hashed", "one")
    counted = df.withColumns({hashed: hash32(key, *ties), one: F.lit(1).cast("long")})
    return running_sum(counted, [], hashed, [key, *ties], one, out, rows).drop(hashed, one)


def shard(df: DataFrame, key: str, ties: list[str], shards: int, seed: int = 0) -> DataFrame:
    """Add ``shard`` and ``slot``; ``ties`` order rows of an equal key.

    Columns of these names that the input has stay as ``shard_`` and ``slot_``.
    """
    for name in ("shard", "slot"):
        df = df.withColumnRenamed(name, *free_names([*df.columns, name], name))
    number, place = free_names([*df.columns, "shard", "slot"], "row_number", "place")
    return (
        numbered(df, key, ties, number)
        .withColumn(place, permuted(F.col(number), df.count(), seed))
        .withColumn("shard", (F.col(place) % shards).cast("int"))
        .withColumn("slot", F.floor(F.col(place) / F.lit(shards)).cast("long"))
        .drop(place, number)
    )


def text_measures(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size`` (bytes plus 8) and ``text_crc32``: no text is shuffled."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 0) -> DataFrame:
    """One row per document: its size, checksum, shard and slot."""
    sharded = shard(text_measures(docs), "doc_id", ["size", "text_crc32"], shards, seed)
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def sharded_rows(docs: DataFrame, shards: int = 24, seed: int = 0) -> DataFrame:
    """The rows with their shard and slot, in all columns (see ``shard``)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size, crc32 = free_names([*docs.columns, "shard", "slot"], "size", "crc32")
    measured = docs.withColumns({size: F.octet_length(text), crc32: F.crc32(text.cast("binary"))})
    return shard(measured, "doc_id", [size, crc32], shards, seed).drop(size, crc32)
