"""Pearson correlation of all columns, as a long matrix and as pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pavilion.operators.moments import class_moments

_CELL = T.StructType(
    [
        T.StructField("feature_1", T.StringType()),
        T.StructField("feature_2", T.StringType()),
        T.StructField("place_1", T.IntegerType()),
        T.StructField("place_2", T.IntegerType()),
        T.StructField("correlation", T.DoubleType()),
    ]
)


def correlation_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All cells of the matrix. Only the d x d result reaches the driver."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="v").transform(
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    )
    matrix = class_moments(vectors, features="v")[None].correlation()
    cells = [
        (a, b, i, j, float(matrix[i, j]))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(cells, _CELL)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Symmetric long matrix with ones on the diagonal."""
    return correlation_cells(df, columns).select("feature_1", "feature_2", "correlation")


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each unordered pair once."""
    upper = correlation_cells(df, columns).where(F.col("place_1") < F.col("place_2"))
    return upper.select("feature_1", "feature_2", "correlation")
