"""Broadcast only what is proven small.

``broadcast_if_bounded`` hints a broadcast when the optimizer's size estimate
of the side is under a limit; otherwise it leaves the side alone and AQE
decides at run time from the real shuffle size (and splits skewed partitions
of a sort-merge join).  The estimate for a file scan is the bytes on disk
scaled by the projection, an upper bound after filters and aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_LIMIT = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # noqa: BLE001 - estimate unavailable (e.g. Connect)
        return None


def broadcast_if_bounded(df: DataFrame, limit: int | None = None) -> DataFrame:
    limit = DEFAULT_LIMIT if limit is None else limit
    est = estimated_bytes(df)
    if est is not None and est <= limit:
        return F.broadcast(df)
    return df
