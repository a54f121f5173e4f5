"""Counts, means and co-moments of vectors, per class, in one read.

A partition adds up its batches to one (count, mean, scatter) per class; partials of
``FAN`` partitions merge, then all. Scatter is the sum of products of deviations from the
mean, and merging adds what the distance of the means contributes, so nothing cancels. A
class that holds most rows is no hot key, as partials are one row per partition and class.
Only classes x d x d numbers reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN = 256
SCHEMA = "label double, part int, rows long, mean binary, scatter binary"


@dataclass(frozen=True)
class Moments:
    """``scatter`` holds the sums of products of deviations from the mean."""

    rows: int
    mean: np.ndarray
    scatter: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        mean = x.mean(axis=0)
        apart = x - mean
        return cls(len(x), mean, apart.T @ apart)

    def __add__(self, other: Moments) -> Moments:
        rows = self.rows + other.rows
        gap = other.mean - self.mean
        mean = self.mean + gap * (other.rows / rows)
        between = np.outer(gap, gap) * (self.rows * (other.rows / rows))
        return Moments(rows, mean, self.scatter + other.scatter + between)

    def covariance(self, lost: int = 1) -> np.ndarray:
        """Divided by the rows less ``lost`` degrees of freedom."""
        return self.scatter / max(self.rows - lost, 1)

    def correlation(self) -> np.ndarray:
        """NaN for a column of one value, but for its own cell."""
        size = np.sqrt(np.diag(self.scatter))
        with np.errstate(invalid="ignore", divide="ignore"):
            out = self.scatter / np.outer(size, size)
        np.fill_diagonal(out, 1.0)
        return out

    def deviations(self) -> np.ndarray:
        """Population deviation of each column; 0 for a column of one value."""
        return np.sqrt(np.diag(self.scatter) / max(self.rows, 1))


def _table(found: dict[float | None, Moments], part: int) -> pa.RecordBatch:
    columns = [
        pa.array(list(found), pa.float64()),
        pa.array([part] * len(found), pa.int32()),
        pa.array([m.rows for m in found.values()], pa.int64()),
        pa.array([m.mean.tobytes() for m in found.values()], pa.binary()),
        pa.array([m.scatter.tobytes() for m in found.values()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["label", "part", "rows", "mean", "scatter"])


def _moments(row: dict) -> Moments:
    mean = np.frombuffer(row["mean"])
    return Moments(row["rows"], mean, np.frombuffer(row["scatter"]).reshape(len(mean), -1))


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[float | None, Moments] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        labels = np.array([np.nan if v is None else v for v in batch.column(0).to_pylist()], float)
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        unlabelled = np.isnan(labels)
        for label in [*np.unique(labels[~unlabelled]).tolist(), *([None] if unlabelled.any() else [])]:
            own = Moments.of(x[unlabelled if label is None else labels == label])
            found[label] = found[label] + own if label in found else own
    yield _table(found, TaskContext.get().partitionId())


def _merged(rows: pa.Table) -> pa.Table:
    total = None
    for row in rows.to_pylist():
        total = _moments(row) if total is None else total + _moments(row)
    return pa.Table.from_batches([_table({row["label"]: total}, row["part"] // FAN)])


def class_moments(df: DataFrame, label: Column | None = None, features: str = "features") -> dict[float | None, Moments]:
    """Moments of the vectors of each class, in order of labels; of all rows under None."""
    label = F.lit(None) if label is None else label
    partials = df.select(label.cast("double").alias("label"), vector_to_array(features).alias("v")).mapInArrow(
        _partials, SCHEMA
    )
    groups = partials.groupBy("label", F.expr(f"part div {FAN}")).applyInArrow(_merged, SCHEMA)
    found = groups.groupBy("label").applyInArrow(_merged, SCHEMA).collect()
    return {r["label"]: _moments(r.asDict()) for r in sorted(found, key=lambda r: (r["label"] is None, r["label"] or 0.0))}
