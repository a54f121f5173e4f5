"""Queries of the corpus operators on the generated tables, and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pavilion.llm import (
    byte_repeats,
    chat,
    collocations,
    contamination,
    html_text,
    jaccard_join,
    mixing,
    search,
    sharding,
    simhash,
    spellings,
    toxicity,
    word_repeats,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best neighbours of every hundredth vector among all others."""
    rows = search.weighted_rows(table(spark, folder, "embeddings"))
    return search.top_k(rows.where("vec_id % 100 = 0"), rows, k=10)


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles are 85% alike."""
    docs = table(spark, folder, "documents")
    return jaccard_join.near_duplicates(docs, 4, jaccard_join.Threshold(85, 100))


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without repeated strings of 100 bytes."""
    return byte_repeats.remove_repeats(table(spark, folder, "documents"))


def op4_block_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without repeated windows of 20 words."""
    return word_repeats.remove_repeats(table(spark, folder, "documents"))


def op5_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document in a mix of 150% with weights 3, 1, 2."""
    return mixing.mix_documents(table(spark, folder, "documents"))


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a passage of the benchmark, with the passage and its place."""
    return contamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_shard(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in 24 shards of equal counts."""
    return sharding.shard_documents(table(spark, folder, "documents"), shards=24)


def op8_extract_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, folder, "pages"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learnt from labels outside the held-out fold."""
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, folder, "labels")))


def op10_format_chats(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of all formatted conversations and of one full of control strings."""
    return chat.format_digests(chat.with_probe(table(spark, folder, "conversations")))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents with their most frequent near word and its root."""
    return spellings.spelling_variants(table(spark, folder, "documents"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 best phrases of each language by their weakest cut."""
    return collocations.collocations(table(spark, folder, "documents"))


def op13_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and their components at two differing bits."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_exact_top_k,
            op2_jaccard_join,
            op3_suffix_dedup,
            op4_block_dedup,
            op5_mix_sources,
            op6_decontaminate,
            op7_shard,
            op8_extract_text,
            op9_toxicity,
            op10_format_chats,
            op11_spelling_variants,
            op12_collocations,
            op13_simhash_dedup,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_top_k": search.ORACLE,
        "op10_format_chats": chat.ORACLE,
        "op12_collocations": collocations.ORACLE,
    }
