"""Join-side helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Broadcast the history only up to this many rows (~120 bytes each, about
# 60 MB); it holds one row per station and coordinate pair, and a national
# network has a few thousand stations.
HIST_BROADCAST_MAX_ROWS = 500_000


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast a stored table only after counting it.

    ``df`` must be a read of written files, so the count is a cheap scan.
    Above ``max_rows`` the frame is returned unhinted and the join stays
    shuffled (with AQE skew splitting in batch queries).
    """
    return F.broadcast(df) if df.count() <= max_rows else df
