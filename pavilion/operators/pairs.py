"""How the response varies with two features: bucket grids for all pairs in one job."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavilion.operators.buckets import COUNT_BUCKETS, with_equal_count_buckets
from pavilion.operators.response import population, squared_differences

PAIR_KEYS = ["feature_1", "feature_2"]


def feature_pairs(columns: Sequence[str]) -> list[tuple[str, str]]:
    """All unordered pairs, in column order."""
    return list(combinations(columns, 2))


def _name_of(index: Column, names: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), index.cast("int") + 1)


def bucket_cells(
    df: DataFrame,
    columns: Sequence[str],
    response: str,
    order: Sequence[str],
    n: int = COUNT_BUCKETS,
    strategy: str = "auto",
) -> DataFrame:
    """Count and response sum per filled cell of every pair's n x n grid.

    A row adds one integer cell number per pair; cells are combined map-side, so at
    most pairs x n x n rows leave a task.
    """
    pairs = feature_pairs(columns)
    bucketed = with_equal_count_buckets(df, columns, order, n, strategy)
    cells = F.array(
        *[
            F.lit(i * n * n) + F.col(f"bucket_{a}") * n + F.col(f"bucket_{b}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return (
        bucketed.select(F.col(response).alias("y"), F.explode(cells).alias("cell"))
        .groupBy("cell")
        .agg(F.count("y").alias("bin_count"), F.sum("y").alias("response_sum"))
    )


def named_cells(cells: DataFrame, columns: Sequence[str], n: int = COUNT_BUCKETS) -> DataFrame:
    """Cell numbers turned into (feature 1, feature 2, bucket 1, bucket 2)."""
    pairs = feature_pairs(columns)
    cell = F.col("cell")
    pair = F.floor(cell / (n * n))
    return cells.select(
        _name_of(pair, [a for a, _ in pairs]).alias("feature_1"),
        _name_of(pair, [b for _, b in pairs]).alias("feature_2"),
        (F.floor(cell / n) % n).cast("int").alias("bucket_1"),
        (cell % n).cast("int").alias("bucket_2"),
        "bin_count",
        F.try_divide(F.col("response_sum"), F.col("bin_count")).alias("bin_mean"),
    )


def bucket_grid(
    df: DataFrame,
    columns: Sequence[str],
    response: str,
    order: Sequence[str],
    n: int = COUNT_BUCKETS,
    strategy: str = "auto",
) -> DataFrame:
    """Every cell of every grid: empty ones with count 0 and NULL mean."""
    cells = bucket_cells(df, columns, response, order, n, strategy)
    total = len(feature_pairs(columns)) * n * n
    every = df.sparkSession.range(total).select(F.col("id").cast("int").alias("cell"))
    full = every.join(cells, "cell", "left").withColumn(
        "bin_count", F.coalesce(F.col("bin_count"), F.lit(0).cast("long"))
    )
    whole = population(df, response).scalar()
    weight = F.col("bin_count") / F.col("all")["rows"]
    gap = F.pow(F.col("bin_mean") - F.col("all")["rate"], F.lit(2.0))
    return (
        named_cells(full, columns, n)
        .withColumn("all", whole)
        .withColumn("mean_sq_diff_weighted", gap * weight)
        .drop("all")
    )


def pair_msd(
    df: DataFrame,
    columns: Sequence[str],
    response: str,
    order: Sequence[str],
    n: int = COUNT_BUCKETS,
    strategy: str = "auto",
) -> DataFrame:
    """Mean squared difference of the response per pair; empty cells do not count."""
    cells = named_cells(bucket_cells(df, columns, response, order, n, strategy), columns, n)
    return squared_differences(cells, PAIR_KEYS, population(df, response).scalar())


def grid_matrix(grid: DataFrame, n: int = COUNT_BUCKETS) -> DataFrame:
    """The grid as a matrix: bucket 1 down, bucket 2 across, weighted difference inside."""
    pivoted = (
        grid.groupBy(*PAIR_KEYS, "bucket_1")
        .pivot("bucket_2", list(range(n)))
        .agg(F.first("mean_sq_diff_weighted"))
    )
    return pivoted.select(
        *PAIR_KEYS, "bucket_1", *[F.col(str(i)).alias(f"b{i}") for i in range(n)]
    )
