"""OHLCV bars over tumbling windows (K2, K3, AG3-AG7).

The same function serves batch and streaming inputs: a streaming input gets
an event-time watermark first, so a window is emitted once (append mode) and
its state dropped after the watermark passes its end.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.functions.aggs import first_non_null, max_when, min_when
from bourse.functions.scalars import excludes_any, pct_change

# FIXED VALUES: trade condition codes whose trades do not set the bar's high
# and low (as published for the live-trade pipeline).
EXCLUDED_CONDITIONS = ("4", "7", "9", "11", "12", "14", "22", "23", "27", "29",
                       "33", "38", "52", "53")


def window_aggregate(df: DataFrame, key: str = "symbol", ts: str = "timestamp",
                     price: str = "price", volume: str = "volume",
                     conditions: str | None = "conditions", ref_close: str = "previous_close_price",
                     width: str = "1 minute", tie_break: str | None = None,
                     excluded: Iterable[str] = EXCLUDED_CONDITIONS,
                     watermark: str | None = "30 seconds") -> DataFrame:
    """Group trades by (key, tumbling window) with open/close by time,
    high/low over valid trades, volume, first non-null reference close and a
    count (AG3-AG7).

    ``tie_break`` orders trades with equal timestamps.  Without it the
    ordering is the timestamp alone and every aggregation buffer is
    fixed-width, so Spark plans a hash aggregate (partial and final); with it
    the ordering is a struct and Spark falls back to a sort-based aggregate.
    That is deterministic but slower; use it when equal-timestamp trades must
    resolve the same way on every run (as the oracle comparison needs)."""
    if df.isStreaming and watermark:
        df = df.withWatermark(ts, watermark)
    order = F.struct(F.col(ts), F.col(tie_break)) if tie_break else F.col(ts)
    valid = excludes_any(conditions, excluded) if conditions else F.lit(True)
    return df.groupBy(F.col(key), F.window(F.col(ts), width).alias("window")).agg(
        F.min_by(price, order).alias("open_price"),
        F.max_by(price, order).alias("close_price"),
        F.sum(volume).alias("volume"),
        min_when(valid, price).alias("low_price"),
        max_when(valid, price).alias("high_price"),
        first_non_null(ref_close, order).alias("previous_close_price"),
        F.count(key).alias("snapshot_count"),
    )


def bar_metrics(agg: DataFrame, key: str = "symbol", drift_limit: float = 3.0) -> DataFrame:
    """Window bounds as columns (K3) and the derived bar measures."""
    drift = F.round(pct_change("close_price", "previous_close_price"), 4)
    out = agg.select(
        F.col(key),
        F.to_date(F.col("window.start")).alias("session_date"),
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "open_price", "high_price", "low_price", "close_price", "volume",
        "previous_close_price", "snapshot_count",
        (F.col("close_price") - F.col("previous_close_price")).alias("change"),
        pct_change("close_price", "previous_close_price").alias("percent_change"),
        (F.col("high_price") - F.col("low_price")).alias("intrawindow_spread"),
        drift.alias("price_drift_pct"),
    )
    return out.withColumn("price_anomaly_flag",
                          F.when(F.abs(F.col("price_drift_pct")) > F.lit(drift_limit), True)
                          .otherwise(False))


def bars(df: DataFrame, width: str = "1 minute", **kw) -> DataFrame:
    drift_limit = kw.pop("drift_limit", 3.0)
    key = kw.get("key", "symbol")
    return bar_metrics(window_aggregate(df, width=width, **kw), key=key, drift_limit=drift_limit)


# --- bars in parts that merge ----------------------------------------------------

def bar_partials(df: DataFrame, key: str = "symbol", ts: str = "timestamp", price: str = "price", volume: str = "volume",
                 conditions: str | None = "conditions", ref_close: str = "previous_close_price", width: str = "1 minute",
                 tie_break: str | None = None, excluded: Iterable[str] = EXCLUDED_CONDITIONS) -> DataFrame:
    """One row per key and window that holds all ``window_aggregate`` needs of these rows: partials of any division of
    the rows, put together by ``merge_partials`` in any order, finish as the bars of all rows.  Without a tie-break the
    content of a row decides between trades of equal time."""
    order = F.struct(F.col(ts), F.col(tie_break) if tie_break else F.xxhash64(price, ref_close))
    valid = excludes_any(conditions, excluded) if conditions else F.lit(True)
    ref_at = F.when(F.col(ref_close).isNotNull(), order)
    return df.groupBy(F.col(key), F.window(F.col(ts), width).alias("window")).agg(
        F.min(order).alias("open_at"), F.min_by(price, order).alias("open_price"),
        F.max(order).alias("close_at"), F.max_by(price, order).alias("close_price"),
        F.min(ref_at).alias("ref_at"), F.min_by(ref_close, ref_at).alias("ref_close"),
        F.sum(volume).alias("volume"), min_when(valid, price).alias("low_price"), max_when(valid, price).alias("high_price"),
        F.count(key).alias("snapshot_count"), F.count("*").alias("n_rows"))


def merge_partials(partials: DataFrame, key: str = "symbol") -> DataFrame:
    """Partials of one key and window become one; associative and commutative."""
    return partials.groupBy(F.col(key), F.col("window")).agg(
        F.min("open_at").alias("open_at"), F.min_by("open_price", "open_at").alias("open_price"),
        F.max("close_at").alias("close_at"), F.max_by("close_price", "close_at").alias("close_price"),
        F.min("ref_at").alias("ref_at"), F.min_by("ref_close", "ref_at").alias("ref_close"),
        F.sum("volume").alias("volume"), F.min("low_price").alias("low_price"), F.max("high_price").alias("high_price"),
        F.sum("snapshot_count").alias("snapshot_count"), F.sum("n_rows").alias("n_rows"))


def finish_partials(partials: DataFrame, key: str = "symbol") -> DataFrame:
    """The columns of ``window_aggregate``."""
    return partials.select(F.col(key), "window", "open_price", "close_price", "volume", "low_price", "high_price",
                           F.col("ref_close").alias("previous_close_price"), "snapshot_count")
