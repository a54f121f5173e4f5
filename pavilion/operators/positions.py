"""Exact positions (row numbers) over a whole table or within few large groups.

``window`` sorts each group in one task. ``distributed`` sorts by range over all
executors: every row takes its slot in its own partition, and a small table of
partition sizes turns slots into positions. The sorted rows are written out
between the two passes, so both passes see the same slots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pavilion.functions.sizing import broadcast_if_small, pick_strategy
from pavilion.functions.staging import stage

# monotonically_increasing_id keeps the partition number above these bits.
SLOT_BITS = 33


def positions(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = (),
    name: str = "position",
    strategy: str = "auto",
) -> DataFrame:
    """Add the 1-based position within ``keys`` in ascending ``order``.

    The order must be total (end it with an id), or equal rows share no fixed order.
    """
    if pick_strategy(df, strategy) == "window":
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, F.row_number().over(window).cast("long"))
    sort_columns = [*keys, *order]
    slotted = stage(
        df.repartitionByRange(*sort_columns)
        .sortWithinPartitions(*sort_columns)
        .withColumn("slot", F.monotonically_increasing_id()),
        "slots",
    ).withColumn("part", F.shiftright("slot", SLOT_BITS))
    sizes = slotted.groupBy(*keys, "part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("slot").alias("first_slot")
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0))
    shifts = stage(
        sizes.select(
            *[F.col(k).alias(f"of_{k}") for k in keys],
            F.col("part").alias("of_part"),
            (before - F.col("first_slot") + 1).alias("shift"),
        ),
        "slot-shifts",
    )
    # One row per partition and group; checked, because groups may be many.
    shifts = broadcast_if_small(shifts)
    same = F.col("part") == F.col("of_part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"of_{k}"))
    return slotted.join(shifts, same).select(
        *df.columns, (F.col("slot") + F.col("shift")).alias(name)
    )


def head(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order).limit(n)


def chronological_split(
    df: DataFrame, order: Sequence[str], n_train: int, strategy: str = "auto"
) -> DataFrame:
    """Mark the first ``n_train`` rows in time ``train`` and the rest ``test``."""
    placed = positions(df, order, name="position", strategy=strategy)
    part = F.when(F.col("position") <= n_train, F.lit("train")).otherwise(F.lit("test"))
    return placed.withColumn("split", part)
