"""Join helpers: broadcast only behind a measured size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows a broadcast side may hold (a few tens of MB for narrow key tables).
DEFAULT_BROADCAST_ROWS = 1_000_000


def size_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    ``limit(max_rows + 1)`` lets Spark stop scanning as soon as the bound
    is exceeded, so the check costs at most one pass over the small side.
    Call it on a materialised (checkpointed or written) frame.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def maybe_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint when the size check passes, else a shuffle join.

    Beyond the bound the join stays sort-merge; AQE may still convert it at
    runtime from measured shuffle sizes, and splits skewed partitions.
    """
    return F.broadcast(df) if size_bounded(df, max_rows) else df
