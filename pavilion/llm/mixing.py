"""Mixing sources to target weights with a low-discrepancy schedule.

The mix is a row of slots. A source has as many as its target, rounded to words, fills;
all are of one length but its last, which holds the rest, so each source meets its target
at any size. Slot ``k`` has the point ``frac((k + 1/2) / golden ratio)``; in the order of
the points, each source in turn gets its number of slots. Slots are ranked per source. A
source's documents, shuffled by a hash, lie on a line of words, once per epoch, cut into
blocks of the slots' length: the slot of rank ``r`` takes block ``r``. Every prefix of the
schedule is close to the target weights.

Cases: a null text has no words and is never taken; a null source is a source of its own,
last in order; equal rows are interchangeable; documents without words, empty tables and
further columns are handled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pavilion.functions.staging import stage
from pavilion.llm.names import columns_of, free_names
from pavilion.llm.ordering import hash32, running_sum
from pavilion.llm.words import word_count

GOLDEN = 0.6180339887498949
BLOCK_WORDS = 4096
LEAST_SLOTS = 65536
POINTS_PER_CELL = 64
BROADCAST_SOURCES = 50_000
BEFORE = (Window.unboundedPreceding, -1)
SOURCE = ["source_text", "source_null"]


@dataclass(frozen=True)
class MixPlan:
    """What to mix: weights repeat over the sources in order of code points."""

    weights: Sequence[int] = (3, 1, 2)
    share: float = 1.5
    most_epochs: int = 2


def with_source_key(docs: DataFrame) -> DataFrame:
    """Non-null columns that stand for the source."""
    return docs.withColumns(
        {
            "source_text": F.coalesce(F.col("source"), F.lit("")),
            "source_null": F.col("source").isNull(),
        }
    )


def targets(sized: DataFrame, plan: MixPlan) -> DataFrame:
    """One row per source: ``source_size``, ``target`` and ``goal``, the target in whole words.

    Targets are proportional to the weights up to a common level, where a source's own
    limit lies below. In order of limit by weight, the level that the sources not yet
    at their limit would share decides: the first that it does not exceed fixes it.
    """
    totals = sized.groupBy(*SOURCE).agg(
        F.sum("size").alias("source_size"), F.count("*").alias("documents")
    )
    order = Window.orderBy("source_null", "source_text")
    weights = F.array(*[F.lit(float(w)) for w in plan.weights])
    place = (F.row_number().over(order) - 1) % len(plan.weights)
    level = Window.orderBy("ratio", "source_null", "source_text")
    every = Window.partitionBy()
    return (
        totals.withColumn("weight", F.get(weights, place))
        .withColumn("limit", F.col("source_size") * float(plan.most_epochs))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("wanted", F.sum("source_size").over(every) * plan.share)
        .withColumn(
            "full", F.coalesce(F.sum("limit").over(level.rowsBetween(*BEFORE)), F.lit(0.0))
        )
        .withColumn("open", F.sum("weight").over(level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("height", (F.col("wanted") - F.col("full")) / F.col("open"))
        .withColumn(
            "height",
            F.max(F.when(F.col("height") <= F.col("ratio"), F.col("height"))).over(every),
        )
        .withColumn(
            "target", F.least("limit", F.coalesce("height", "ratio") * F.col("weight"))
        )
        .withColumn("goal", F.floor(F.col("target") + 0.5))
        .select(*SOURCE, "source_size", "target", "goal", "documents")
    )


def block_words(total: float) -> int:
    """Length of a slot: short enough for at least ``LEAST_SLOTS`` slots."""
    return max(1, min(BLOCK_WORDS, int(total // LEAST_SLOTS)))


def slots_of(block: int) -> Column:
    """How many slots a source fills; the last may be shorter."""
    return F.ceil(F.col("goal") / F.lit(block))


def schedule(goals: DataFrame, block: int, slots: int) -> DataFrame:
    """One row per slot: its source and ``block``, the rank among the source's slots.

    Places of points and of sources meet in cells of ``POINTS_PER_CELL`` places. Ranks
    come from counts per range of slots, so no window holds a whole source.
    """
    spark = goals.sparkSession
    order = Window.orderBy("source_null", "source_text")
    own = slots_of(block)
    bounds = goals.select(
        *SOURCE, (F.sum(own).over(order) - own).alias("low"), F.sum(own).over(order).alias("high")
    ).where("high > low")

    def cell(at: Column) -> Column:
        return F.floor(at / F.lit(POINTS_PER_CELL))

    bounds = bounds.withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high") - 1))))
    golden = (F.col("id") + 0.5) * GOLDEN
    points = spark.range(slots).select(
        F.col("id").alias("slot"),
        F.floor((golden - F.floor(golden)) * 2.0**32).alias("point"),
        F.lit(1).alias("one"),
    )
    placed = running_sum(points, [], "point", ["slot"], "one", "place", slots)
    filled = (
        placed.withColumn("cell", cell(F.col("place")))
        .join(bounds, "cell")
        .where("place >= low and place < high")
        .select(*SOURCE, "slot", F.shiftright("slot", 13).alias("range"))
    )
    counts = filled.groupBy(*SOURCE, "range").agg(F.count("*").alias("slots"))
    earlier = Window.partitionBy(*SOURCE).orderBy("range").rowsBetween(*BEFORE)
    starts = counts.select(
        *SOURCE, "range", F.coalesce(F.sum("slots").over(earlier), F.lit(0)).alias("first")
    )
    within = Window.partitionBy(*SOURCE, "range").orderBy("slot")
    return (
        filled.withColumn("rank", F.row_number().over(within) - 1)
        .join(starts, [*SOURCE, "range"])
        .select(*SOURCE, "slot", (F.col("first") + F.col("rank")).alias("block"))
    )


def pieces(lined: DataFrame, block: int, epochs: int) -> DataFrame:
    """Parts of documents by block, up to the goal: ``from_word`` to ``to_word`` of an epoch."""
    begin = F.col("start") + F.col("epoch") * F.col("source_size")
    cut = F.col("block") * block
    first = F.floor(F.col("begin") / F.lit(block))
    last = F.floor((F.col("begin") + F.col("size") - 1) / F.lit(block))
    return (
        lined.where(F.col("size") > 0)
        .withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(epochs)])))
        .withColumn("begin", begin)
        .where("begin < goal")
        .withColumn("block", F.explode(F.sequence(first, last)))
        .withColumn("from_word", F.greatest("begin", cut) - F.col("begin"))
        .withColumn(
            "to_word", F.least(F.col("begin") + F.col("size"), cut + block, "goal") - F.col("begin")
        )
        .where("from_word < to_word")
        .drop("begin")
    )


@dataclass(frozen=True)
class Mix:
    """``sources``: a row per source; ``parts``: a row per part of a document in a slot.

    ``documents`` has a row per row of the input that has words. ``start``, its place on
    the line of its source, tells equal rows apart.
    """

    sources: DataFrame
    documents: DataFrame
    parts: DataFrame


def mix(sized: DataFrame, plan: MixPlan) -> Mix:
    """Schedule ``sized`` rows: ``doc_id``, ``size`` and the source key."""
    goals = stage(targets(sized, plan), "mix-targets")
    facts = goals.agg(
        F.sum("target").alias("words"), F.sum("documents").alias("rows"), F.count("*").alias("sources")
    ).first()
    block = block_words(facts["words"] or 0.0)
    slots = goals.agg(F.sum(slots_of(block))).first()[0] or 0
    few = facts["sources"] <= BROADCAST_SOURCES
    per_source = goals.select(*SOURCE, "source_size", "target", "goal")
    per_source = F.broadcast(per_source) if few else per_source
    hashed = sized.where("size > 0").withColumn("hashed", hash32("doc_id", "size"))
    lined = running_sum(
        hashed, SOURCE, "hashed", ["doc_id", "size"], "size", "start", facts["rows"] or 0
    ).drop("hashed")
    lined = lined.join(per_source, SOURCE)
    parts = pieces(lined, block, plan.most_epochs).drop("source_size", "target", "goal")
    return Mix(goals, lined, parts.join(schedule(goals, block, slots), [*SOURCE, "block"]))


def sized_documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size`` in words and the source key, written once: texts are read once."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return stage(with_source_key(sized).drop("source"), "mix-sizes")


def mix_documents(docs: DataFrame, plan: MixPlan | None = None) -> DataFrame:
    """One row per document: how many of its words the mix takes, repeats counted."""
    sized = sized_documents(docs)
    mixed = mix(sized, plan or MixPlan())
    row = [*SOURCE, "start"]
    words = mixed.parts.groupBy(*row).agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    with_words = mixed.documents.join(words, row, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )
    empty = (
        sized.where("size = 0")
        .join(mixed.sources, SOURCE)
        .select("doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    )
    return with_words.unionByName(empty)


def mixed_rows(docs: DataFrame, plan: MixPlan | None = None) -> DataFrame:
    """The documents of the mix, in all columns: a row per epoch that takes most of one.

    A document counts as taken in an epoch if the mix takes at least half of its words
    there. Equal rows share what is taken of them evenly.
    """
    key = F.xxhash64("doc_id", "text")
    size = word_count(F.col("text"))
    keyed = docs.select(key.alias("doc_id"), "source", size.alias("size"))
    sized = stage(with_source_key(keyed).drop("source"), "mix-sizes")
    parts = mix(sized, plan or MixPlan()).parts
    words = F.sum(F.col("to_word") - F.col("from_word"))
    whole = parts.groupBy(*SOURCE, "start", "epoch", "doc_id", "size").agg(words.alias("taken"))
    copies = whole.groupBy("doc_id").agg(
        F.count_distinct("start").alias("rows"),
        F.sum(F.when(F.col("taken") * 2 >= F.col("size"), 1).otherwise(0)).alias("taken"),
    )
    mark, many, copy = free_names(docs.columns, "mark", "copies", "copy")
    copies = copies.select(
        F.col("doc_id").alias(mark), F.round(F.col("taken") / F.col("rows")).cast("int").alias(many)
    ).where(F.col(many) > 0)
    return (
        docs.withColumn(mark, key)
        .join(copies, mark)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(many))))
        .select(*columns_of(docs))
    )
