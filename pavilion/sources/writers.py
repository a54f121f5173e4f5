"""Sinks: replaced tables by path and by name, tab-separated export, report tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table, replacing what was there, and return it as read back."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def replace_named(df: DataFrame, name: str, folder: str) -> DataFrame:
    """Write a table under a name of the catalogue, replacing what was there.

    Every version has a path of its own under ``folder``. The name moves to the new version
    only after all of it is written, so readers see the old rows or the new ones, and a write
    that fails leaves the old ones in place. Earlier versions stay in the folder.
    """
    spark = df.sparkSession
    path = f"{folder.rstrip('/')}/{name}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    quoted = f"`{name}`"
    if spark.catalog.tableExists(name) and plain_schema(spark.table(name)) == plain_schema(df):
        spark.sql(f"ALTER TABLE {quoted} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        # other columns: the name is free for a moment, both versions stay in the folder
        spark.sql(f"DROP TABLE IF EXISTS {quoted}")
        spark.catalog.createTable(name, path, "parquet")
    return spark.table(name)


def plain_schema(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def write_tsv(df: DataFrame, path: str, order: Sequence[str] = (), compression: str = "none") -> None:
    """Tab-separated text with a header row and the word NULL for missing values.

    With an ``order`` the rows are sorted by range over all executors: the files in
    name order hold them in that order. Files are plain unless a ``compression`` is named.
    """
    rows = df.orderBy(*order) if order else df
    (
        rows.write.mode("overwrite")
        .options(sep="\t", header=True, nullValue="NULL", compression=compression)
        .csv(path)
    )


def write_reports(reports: Mapping[str, DataFrame], folder: str) -> None:
    """Store each report as a Parquet table under its name."""
    for name, report in reports.items():
        report.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")
