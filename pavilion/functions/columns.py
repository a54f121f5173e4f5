"""Column expressions used by several operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HALF = 0.500001


def indicator(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def count_or_null(condition: Column) -> Column:
    """Number of rows meeting the condition; NULL, not 0, when there is none."""
    return F.nullif(F.count_if(condition), F.lit(0))


def plain_name(column: Column) -> Column:
    """Comparable form of a name: letter case and trailing blanks do not count."""
    return F.lower(F.rtrim(column))


def rounded(column: Column, digits: int = 6) -> Column:
    """Round halves up by plain double arithmetic, at any size; NaN and infinity stay.

    Half means within a millionth of a unit below it, as the last binary digits of a sum
    depend on its order. Values so large that they have no such digits stay as they are.
    """
    scale = F.lit(10.0**digits)
    above = column * scale + F.lit(HALF)
    nearest = F.rint(above)
    down = nearest - F.when(nearest > above, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(F.abs(above) < F.lit(2.0**52), down / scale).otherwise(column)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating-point column."""
    return df.select(
        *[
            rounded(F.col(f.name).cast("double"), digits).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], value: str = "x") -> DataFrame:
    """One row per (row, feature): the wide table turned long, values as double."""
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(ids), list(columns), "feature", value)
