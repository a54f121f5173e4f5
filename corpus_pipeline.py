"""Documents made ready for training, stage after stage.

Toxic documents go; of each group of near copies one document stays; documents with
benchmark passages go; the sources are mixed to their target weights, so that documents
may repeat or drop out; the mix is dealt to shards. Each stage works on what the one
before it kept, written as Parquet and read again. SQL cannot express the first stages,
so there is no reference SQL; tests compare with brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pavilion.functions.staging import stage
from pavilion.llm import contamination, jaccard_join, mixing, sharding, toxicity
from pavilion.llm.catalog import table

SHINGLE_WORDS = 5
SIMILARITY = jaccard_join.Threshold(80, 100)
SHARDS = 24


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_per_component(docs, SHINGLE_WORDS, SIMILARITY)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.sharded_rows(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix),
    ("sharding", shard),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
