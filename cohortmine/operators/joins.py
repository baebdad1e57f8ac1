"""Size-checked broadcast.

A side is broadcast only behind a proven size bound: a row count measured by an
action the caller already runs, or an arithmetic bound on it, times the bytes of a
row. Otherwise the join is left to the planner, where AQE still converts it to a
broadcast join when the runtime size is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sides above this many bytes are shuffle-joined.
BROADCAST_BYTES = 64 * 1024 * 1024


def itemset_bytes(k: int, arrays: int = 1) -> int:
    """Bytes of an in-memory row of ``arrays`` int arrays of ``k`` items, generously."""
    return 64 + arrays * (32 + 8 * k)


def broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    """``F.broadcast(df)`` when ``small`` (a checked bound), else ``df`` unchanged."""
    return F.broadcast(df) if small else df
