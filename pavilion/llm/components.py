"""Connected components of a table of links, by alternating stars.

Every round links each node's larger neighbours to its least neighbour (large star), then
its smaller neighbours and itself to the least of them (small star), until nothing
changes. Rounds are few, each a few joins and aggregations; a node with very many
neighbours is an aggregation that is combined before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavilion.functions.staging import stage

SALTS = 16


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the least id) of every node of ``links`` (``a``, ``b``)."""
    edges = stage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        "links",
    )
    before = None
    while True:
        edges = stage(_small_star(_large_star(edges)), "links")
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges with ``m`` of their ``u``; the centre of a star is dealt to several tasks."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return salted.join(least.withColumn("salt", salts), ["u", "salt"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return _with_least(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    edges = edges.where("u <> v")
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    lower = _with_least(edges, least).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (
        lower.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
    )
