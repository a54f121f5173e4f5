"""Feature vectors: assembly, row normalisation, standardisation, principal components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import Normalizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pavilion.operators.moments import Moments, class_moments

# Fixed value: share of the variance the kept components must exceed.
VARIANCE_SHARE = 0.95


def assemble(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns plus one vector column ``features``."""
    wide = df.select(*keep, *[F.col(c).cast("double").alias(f"v_{c}") for c in columns])
    assembler = VectorAssembler(inputCols=[f"v_{c}" for c in columns], outputCol="features")
    return assembler.transform(wide).select(*keep, "features")


def from_array(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns plus an array column turned into the vector ``features``."""
    values: Column = F.col(column).cast("array<double>")
    return df.select(*keep, array_to_vector(values).alias("features"))


def normalise_rows(df: DataFrame) -> DataFrame:
    """Scale every row to length 1; a zero row stays zero."""
    out = Normalizer(p=2.0, inputCol="features", outputCol="scaled").transform(df)
    return _replace(out, "scaled")


def _replace(df: DataFrame, column: str) -> DataFrame:
    return df.drop("features").withColumnRenamed(column, "features")


def linear(df: DataFrame, shift: np.ndarray, matrix: np.ndarray) -> DataFrame:
    """``features`` less ``shift``, times ``matrix`` (a vector stands for a diagonal)."""

    @F.pandas_udf("array<double>")
    def mapped(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            if len(values):
                apart = np.stack(values.to_numpy()) - shift
                yield pd.Series(list(apart * matrix if matrix.ndim == 1 else apart @ matrix))
            else:
                yield pd.Series([], dtype=object)

    return df.withColumn("features", array_to_vector(mapped(vector_to_array("features"))))


@dataclass
class Standardiser:
    """Column scaling to mean 0 and population deviation 1; a column of one value becomes 0."""

    mean: np.ndarray
    factor: np.ndarray

    @classmethod
    def of(cls, moments: Moments) -> Standardiser:
        sd = moments.deviations()
        return cls(moments.mean, np.divide(1.0, sd, out=np.zeros_like(sd), where=sd > 0))

    @classmethod
    def fit(cls, df: DataFrame) -> Standardiser:
        return cls.of(class_moments(df)[None])

    def transform(self, df: DataFrame) -> DataFrame:
        return linear(df, self.mean, self.factor)


@dataclass
class Components:
    """Principal components of standardised vectors, largest loading positive."""

    scaler: Standardiser
    ratios: list[float]
    loadings: list[list[float]]
    kept: int

    @classmethod
    def of(cls, moments: Moments, share: float = VARIANCE_SHARE) -> Components:
        """From the correlation matrix, which is the covariance of standardised vectors."""
        scaler = Standardiser.of(moments)
        shared = moments.covariance(0) * np.outer(scaler.factor, scaler.factor)
        values, axes = np.linalg.eigh(shared)
        values, axes = np.maximum(values[::-1], 0.0), axes[:, ::-1]
        largest = np.abs(axes).argmax(axis=0)
        signs = np.where(axes[largest, np.arange(len(values))] >= 0, 1.0, -1.0)
        ratios = (values / values.sum()).tolist() if values.sum() > 0 else [0.0] * len(values)
        kept, total = 0, 0.0
        while kept < len(ratios) and total <= share:
            total += ratios[kept]
            kept += 1
        return cls(scaler, ratios, (axes * signs).T.tolist(), kept)

    @classmethod
    def fit(cls, df: DataFrame, share: float = VARIANCE_SHARE) -> Components:
        """One read gives means, deviations and correlation."""
        return cls.of(class_moments(df)[None], share)

    def transform(self, df: DataFrame) -> DataFrame:
        """Scores of the kept components from vectors as they are."""
        axes = np.array(self.loadings[: self.kept]).T
        return linear(df, self.scaler.mean, self.scaler.factor[:, None] * axes)


def variance_table(df: DataFrame, parts: Components) -> DataFrame:
    """Explained and cumulative variance ratio of the kept components: one row each."""
    schema = T.StructType(
        [
            T.StructField("component", T.IntegerType()),
            T.StructField("explained_ratio", T.DoubleType()),
        ]
    )
    rows = [(k, parts.ratios[k]) for k in range(parts.kept)]
    so_far = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    table = df.sparkSession.createDataFrame(rows, schema)
    return table.withColumn("cumulative_ratio", F.sum("explained_ratio").over(so_far))


def loadings_table(df: DataFrame, parts: Components, columns: Sequence[str]) -> DataFrame:
    """Loadings of the kept components: (component, feature, loading)."""
    schema = T.StructType(
        [
            T.StructField("component", T.IntegerType()),
            T.StructField("feature", T.StringType()),
            T.StructField("loading", T.DoubleType()),
        ]
    )
    rows = [
        (k, c, parts.loadings[k][i]) for k in range(parts.kept) for i, c in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(rows, schema)


def rebuilt_correlation(df: DataFrame, parts: Components, columns: Sequence[str]) -> DataFrame:
    """Correlation of every pair of features from all components of standardised vectors.

    Each component adds its variance times both loadings; the variances of standardised
    features sum to the number of features that are not constant.
    """
    loadings = np.array(parts.loadings)
    shares = loadings.T @ np.diag(parts.ratios) @ loadings
    varying = np.count_nonzero(np.diag(shares) > 1e-12)
    matrix = shares * varying
    rows = [
        (a, b, float(matrix[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(
        rows, "feature_1 string, feature_2 string, correlation double"
    )
