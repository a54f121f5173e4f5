"""Seeded fold numbers that depend on the row id only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Number of folds and the seed of the shuffle.
FOLDS = 5
SEED = 42


def fold_of(row_id: Column, folds: int = FOLDS, seed: int = SEED) -> Column:
    """Fold 0..folds-1 from the first 32 bits of md5("id:seed"); same on any cluster."""
    digest = F.md5(F.concat(row_id.cast("string"), F.lit(f":{seed}")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % folds).cast("int")


def with_folds(
    df: DataFrame, row_id: str = "id", folds: int = FOLDS, seed: int = SEED
) -> DataFrame:
    return df.withColumn("fold", fold_of(F.col(row_id), folds, seed))
