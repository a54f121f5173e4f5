"""Row numbers and running sums over a hashed order, without one big window.

Rows are ordered by a 32-bit hash of their key inside each group. The top bits of
the hash cut a group into coarse and fine ranges. Totals of ranges are summed up
first, so no window holds more than the rows of one fine range: its bound depends
on the number of rows asked for, not on how large the group is.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pavilion.llm.names import free_names

ROWS_PER_RANGE = 4096


def hash32(*columns: Column | str) -> Column:
    """An unsigned 32-bit hash as long."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 32)


def running_sum(
    df: DataFrame,
    groups: Sequence[str],
    hashed: str,
    ties: Sequence[str],
    value: str,
    out: str,
    rows: int,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before this one in its group.

    The order is by ``hashed`` (0 to 2**32 - 1), then ``ties``. Group columns hold no
    nulls. ``rows`` is the number of rows, from which the ranges are sized.
    """
    c, f, total, outer_sum, inner_sum, inside, first = free_names(
        df.columns, "coarse", "fine", "total", "outer", "inner", "within", "first"
    )
    bits = max(0, math.ceil(math.log2(max(rows, 1) / rows_per_range)))
    low, high = bits // 2, bits - bits // 2
    coarse = F.shiftright(F.col(hashed), 32 - high)
    fine = F.shiftright(F.col(hashed), 32 - high - low).bitwiseAND((1 << low) - 1)
    df = df.withColumns({c: coarse.cast("int"), f: fine.cast("int")})
    totals = df.groupBy(*groups, c, f).agg(F.sum(value).alias(total))

    def before(keys: list[str], order: list[str]) -> Window:
        w = Window.partitionBy(*keys).orderBy(*order)
        return w.rowsBetween(Window.unboundedPreceding, -1)

    def so_far(name: str, w: Window) -> Column:
        return F.coalesce(F.sum(name).over(w), F.lit(0))

    outer = totals.groupBy(*groups, c).agg(F.sum(total).alias(total))
    outer = outer.select(
        *groups, c, so_far(total, before([*groups], [c])).alias(outer_sum)
    )
    inner = totals.select(
        *groups,
        c,
        f,
        so_far(total, before([*groups, c], [f])).alias(inner_sum),
    )
    starts = inner.join(outer, [*groups, c]).select(
        *groups, c, f, (F.col(outer_sum) + F.col(inner_sum)).alias(first)
    )
    ordered = df.withColumn(
        inside, so_far(value, before([*groups, c, f], [hashed, *ties]))
    )
    joined = ordered.join(starts, [*groups, c, f])
    return joined.withColumn(out, F.col(first) + F.col(inside)).drop(c, f, inside, first)
