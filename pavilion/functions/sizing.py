"""Size checks: what may be broadcast, and what fits one window partition.

The bound is the sum of the bytes of every relation a DataFrame reads, as stored; an
unknown size counts as large and takes the distributed way. Tables turned long have a
known number of rows per row read, and a limit leaves room for that and for compression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_INPUT_BYTES = 128 * 1024 * 1024
BROADCAST_BYTES = 32 * 1024 * 1024


def input_bytes(df: DataFrame) -> float:
    """Bytes of all leaf relations of the plan; infinity when Spark cannot tell."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return float("inf")
    leaves = plan.queryExecution().analyzed().collectLeaves()
    return float(sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())))


def is_small(df: DataFrame, limit: int = SMALL_INPUT_BYTES) -> bool:
    return input_bytes(df) <= limit


def pick_strategy(df: DataFrame, strategy: str, limit: int = SMALL_INPUT_BYTES) -> str:
    """Resolve ``auto`` to ``window`` (small input) or ``distributed``."""
    if strategy not in ("auto", "window", "distributed"):
        raise ValueError(f"unknown strategy: {strategy}")
    if strategy != "auto":
        return strategy
    return "window" if is_small(df, limit) else "distributed"


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when the size bound allows it; otherwise Spark shuffles."""
    return F.broadcast(df) if is_small(df, limit) else df
