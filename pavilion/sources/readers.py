"""Reading source tables and exported feature tables with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pavilion.functions.columns import plain_name
from pavilion.sources import schemas

# The columns that hold names, compared without case and trailing blanks.
NAME_COLUMNS = {
    "teams": ["Team_name", "Home_Ground", "Second_Ground"],
    "matches": ["city", "team1", "team2", "toss_winner", "toss_decision", "winner"],
    "deliveries": ["batting_team", "bowling_team", "batsman", "player_dismissed"],
}
SOURCE_SCHEMAS = {
    "teams": schemas.TEAMS,
    "matches": schemas.MATCHES,
    "deliveries": schemas.DELIVERIES,
}


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    format: str = "parquet",
    **options: object,
) -> DataFrame:
    """Read one table in any Spark format, with a given schema when there is one."""
    reader = spark.read.format(format).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def normalise_names(df: DataFrame, columns: list[str]) -> DataFrame:
    """Bring name columns to their comparable form once, at ingest."""
    return df.withColumns({c: plain_name(F.col(c)) for c in columns})


def read_sources(
    spark: SparkSession, folder: str, format: str = "parquet", **options: object
) -> dict[str, DataFrame]:
    """The teams, matches and deliveries tables of a folder, names normalised."""
    return {
        name: normalise_names(
            read_table(spark, f"{folder.rstrip('/')}/{name}.{format}", schema, format, **options),
            NAME_COLUMNS[name],
        )
        for name, schema in SOURCE_SCHEMAS.items()
    }


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Tab-separated text with a header row and the word NULL for missing values."""
    return read_table(
        spark, path, schema, "csv", sep="\t", header=True, nullValue="NULL", mode="FAILFAST"
    )


def read_features(
    spark: SparkSession, path: str, schema: T.StructType = schemas.DATED_DIFF
) -> DataFrame:
    """The exported feature table; team ids are cast strictly, so bad or missing ids fail.

    Its date and id give the order of the rows.
    """
    raw = read_tsv(spark, path, schema)

    def known(name: str) -> Column:
        missing = F.raise_error(F.lit(f"missing {name}")).cast("int")
        return F.coalesce(F.col(name).cast("int"), missing)

    return raw.withColumns({c: known(c) for c in ("Home_team", "Away_team")})
