"""Column expressions on words: runs of anything but ASCII white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACES = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACES)), F.lit(0)).cast("long")
