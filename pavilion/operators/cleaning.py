"""Cleaning: rows with missing values, outliers, population statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: rows this many standard deviations out, in any column, are dropped.
Z_LIMIT = 3.0


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(columns) if columns else None)


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row, one struct: row count, and mean and population deviation per column."""
    parts = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        parts += [F.avg(c).alias(f"mean_{c}"), F.stddev_pop(c).alias(f"sd_{c}")]
    return df.agg(F.struct(*parts).alias("moments"))


def zscores(df: DataFrame, columns: Sequence[str], stats: Column) -> dict[str, Column]:
    return {
        c: F.try_divide(F.col(c) - stats[f"mean_{c}"], stats[f"sd_{c}"]) for c in columns
    }


def zscore_filter(df: DataFrame, columns: Sequence[str], limit: float = Z_LIMIT) -> DataFrame:
    """Keep rows whose every column lies within ``limit`` population deviations.

    A constant column has no z-score, so it removes every row. The statistics are a
    scalar subquery: one aggregate over the table, no join.
    """
    scored = df.withColumn("moments", moments(df, columns).scalar())
    keep = F.lit(True)
    for z in zscores(df, columns, F.col("moments")).values():
        keep = keep & F.coalesce(F.abs(z) < limit, F.lit(False))
    return scored.where(keep).drop("moments")

