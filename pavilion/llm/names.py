"""Names of helper columns that no column of the input has."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def free_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, longer by underscores where the input has them; letter case does not count."""
    used = {t.lower() for t in taken}
    out = []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def columns_of(df: DataFrame) -> list[Column]:
    """All columns of a table, whatever their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
