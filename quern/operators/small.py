"""Which side of a join is small enough to be sent to every executor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a dimension that is broadcast; a larger one is joined by shuffle.
MOST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most that many rows; the look stops one row later."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
