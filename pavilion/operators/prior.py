"""Prior-only statistics: averages and counts over strictly earlier rows of a key.

``window`` is the plain running window, one task per key. ``distributed`` gives
the same values when single keys are far too large for that. It cuts the order
(day, id) into days, wide blocks of ids within a day and narrow blocks within a
wide one, which needs no sampling, because ids are unique per key: a block can
never hold more rows than its span of ids. Sums then flow from days to rows:

    value(row) = earlier days + earlier wide blocks of the day
               + earlier narrow blocks of the wide one + earlier rows of the narrow one

Every window is bounded, whatever the skew of keys, days or ids: by the number of
days, by 2^23 wide blocks, by 2^20 narrow blocks and by 2^20 rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pavilion.functions.sizing import pick_strategy

# Widths of the blocks of ids, as powers of two, widest first.
BLOCK_BITS = (40, 20)


def prior_stats(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    row_id: str,
    averages: Mapping[str, str],
    counts: Mapping[str, str] | None = None,
    keep: Mapping[str, str] | None = None,
    strategy: str = "auto",
    block_bits: Sequence[int] = BLOCK_BITS,
) -> DataFrame:
    """Average and count earlier rows of the same key, in the order (day, row_id).

    ``averages`` and ``counts`` map output names to input columns; ``keep`` maps
    output names to columns that are passed through. The first row of a key gets
    NULL averages and a count of 0. ``row_id`` must be an integer, unique per key.
    """
    counts = dict(counts or {})
    keep = dict(keep or {c: c for c in [*keys, day, row_id]})
    if pick_strategy(df, strategy) == "window":
        return _running_window(df, keys, day, row_id, averages, counts, keep)
    return _block_sums(df, keys, day, row_id, averages, counts, keep, block_bits)


def _running_window(df, keys, day, row_id, averages, counts, keep) -> DataFrame:
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(day, row_id)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return df.select(
        *[F.col(c).alias(out) for out, c in keep.items()],
        *[F.avg(c).over(earlier).alias(out) for out, c in averages.items()],
        *[F.count(c).over(earlier).alias(out) for out, c in counts.items()],
    )


def _match(keys: Sequence[str], left: str, right: str) -> Column:
    """Null-safe equality on all keys of two aliased DataFrames."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return condition


def _block_sums(df, keys, day, row_id, averages, counts, keep, block_bits) -> DataFrame:
    measures = list(dict.fromkeys([*averages.values(), *counts.values()]))
    sums = [f"sum_{i}" for i in range(len(measures))]
    sizes = [f"size_{i}" for i in range(len(measures))]
    summed = set(averages.values())
    # A column that is only counted has no sum, so it may be of any type.
    tracked = [s for s, m in zip(sums, measures) if m in summed] + sizes

    places = ["at_day", *[f"at_block_{b}" for b in block_bits]]
    # Rows move with each input column once; what is summed follows where they have arrived.
    at = {**{k: k for k in keys}, day: "at_day", row_id: "at_id"}
    others = [c for c in dict.fromkeys([*keep.values(), *measures]) if c not in at]
    at |= {c: f"in_{i}" for i, c in enumerate(others)}
    plain = df.select(
        *[F.col(k) for k in keys],
        F.col(day).alias("at_day"),
        *[F.shiftright(F.col(row_id), b).alias(f"at_block_{b}") for b in block_bits],
        F.col(row_id).alias("at_id"),
        *[F.col(c).alias(at[c]) for c in others],
    )

    def measured(df: DataFrame) -> DataFrame:
        parts = {
            s: F.coalesce(F.col(at[m]).cast("double"), F.lit(0.0))
            for s, m in zip(sums, measures)
            if m in summed
        }
        parts |= {s: F.when(F.col(at[m]).isNull(), 0).otherwise(1) for s, m in zip(sizes, measures)}
        return df.withColumns(parts)

    rows = measured(plain)

    def before(partition: Sequence[str], order: str) -> list[Column]:
        window = (
            Window.partitionBy(*partition)
            .orderBy(order)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        return [F.coalesce(F.sum(c).over(window), F.lit(0)).alias(f"before_{c}") for c in tracked]

    # Totals per narrow block, then per wider block, up to the day.
    totals = []
    below = rows
    for depth in range(len(places), 0, -1):
        below = below.groupBy(*keys, *places[:depth]).agg(*[F.sum(c).alias(c) for c in tracked])
        totals.append(below)

    # From the day down: what lies before each block.
    start = None
    for depth, total_of in enumerate(reversed(totals), 1):
        outer = [*keys, *places[: depth - 1]]
        level = total_of.select(*outer, places[depth - 1], *before(outer, places[depth - 1]))
        if start is not None:
            level = (
                level.alias("l")
                .join(start.alias("u"), _match(outer, "l", "u"))
                .select(
                    *[F.col(f"l.{k}") for k in [*outer, places[depth - 1]]],
                    *[
                        (F.col(f"l.before_{c}") + F.col(f"u.before_{c}")).alias(f"before_{c}")
                        for c in tracked
                    ],
                )
            )
        start = level

    block_keys = [*keys, *places]
    located = (
        plain.alias("r")
        .join(start.alias("s"), _match(block_keys, "r", "s"))
        .select("r.*", *[F.col(f"s.before_{c}").alias(f"start_{c}") for c in tracked])
    )
    inside = measured(located).select("*", *before(block_keys, "at_id"))

    def total(column: str) -> Column:
        return F.col(f"start_{column}") + F.col(f"before_{column}")

    position = {m: i for i, m in enumerate(measures)}
    return inside.select(
        *[F.col(at[c]).alias(out) for out, c in keep.items()],
        *[
            F.try_divide(total(f"sum_{position[c]}"), total(f"size_{position[c]}")).alias(out)
            for out, c in averages.items()
        ],
        *[total(f"size_{position[c]}").cast("long").alias(out) for out, c in counts.items()],
    )
