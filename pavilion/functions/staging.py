"""Materialising intermediate tables in the folder ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import gc
import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavilion.functions.sizing import input_bytes

LEAST_PARTITIONS = 8
PARTITION_BYTES = 64 * 1024 * 1024
# Written tables of which readers choose rows by a column.
FILES_BY = {"model-input": ["fold"]}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a fresh local one only for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="pavilion-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for one written table under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/pavilion/{name}-{uuid.uuid4().hex}"


def kept_path(spark: SparkSession, folder: str, key: str) -> str:
    """The path of a table that later runs find again by its key."""
    return f"{shared_folder(spark).rstrip('/')}/pavilion/{folder}/{key}"


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether the write of a table has ended."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def free(spark: SparkSession) -> None:
    """Let go of what ended jobs left: shuffle files and broadcasts on all executors, and the driver's heap.

    Spark deletes them only after the driver has collected its garbage, which may take long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def spread(df: DataFrame) -> DataFrame:
    """Deal a table to partitions that depend on its rows and size alone.

    Models that draw samples per partition are then the same on any number of cores.
    """
    size = input_bytes(df)
    parts = LEAST_PARTITIONS
    if math.isfinite(size):
        parts = max(parts, math.ceil(size / PARTITION_BYTES))
    row = F.xxhash64(*df.columns)
    return df.repartition(parts, row).sortWithinPartitions(row)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and go on from the written one.

    Later jobs read only the columns they need, know the table's size, and do not
    repeat the work before it when an executor is lost. Each value of a column that ``FILES_BY``
    names has files of its own, so that rows are chosen by it without reading the others.
    """
    by = FILES_BY.get(name, [])
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    reader = df.sparkSession.read
    return (reader.schema(df.schema) if by else reader).parquet(path)
