"""Broadcast only what is known to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Size Catalyst expects for a plan, without running it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """Broadcast hint when the estimate is under the limit.

    Beyond it the plain DataFrame is returned and the join is left to the
    shuffle join Spark would plan anyway (with skew handling at run time).
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit else df
