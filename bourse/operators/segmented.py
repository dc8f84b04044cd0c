"""Ordered scans per key that stay parallel when one key is hot.

A plain ``Window.partitionBy(key).orderBy(seq)`` sends every row of a key to
one task.  When a key may hold a third of the data, that task is the job.
These helpers add a coarse *segment* column (a monotone function of the order,
e.g. the month of the sequence timestamp) and run the window per
(key, segment).  The few values that must cross a segment boundary (the last
row of the previous segment, the first of the next, a running maximum) come
from a per-(key, segment) summary that is one row per segment, scanned with a
window over key, and joined back on (key, segment).  The big side is already
hash-partitioned on (key, segment) by the window, so that join does not
shuffle it again.

With ``segment=None`` the helpers fall back to a single window per key (right
for keys with bounded row counts and cheapest on small data).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEG = "__seg"


def with_segment(df: DataFrame, segment: Column | None) -> DataFrame:
    """Add the segment column (nothing when ``segment`` is None)."""
    return df if segment is None else df.withColumn(SEG, segment)


def part_cols(keys: Sequence[str], segmented: bool) -> list[str]:
    """Window partition columns: (keys, segment), or the keys alone.  Keeping
    a constant out of the partitioning lets every window, the dedup and the
    per-run aggregate share one hash exchange on the keys."""
    return [*keys, SEG] if segmented else list(keys)


def _join_back(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a per-(key, segment) summary; NULL is a key like any other."""
    summary = summary.withColumnsRenamed({k: f"__on_{k}" for k in [*keys, SEG]})
    on = F.lit(True)
    for k in [*keys, SEG]:
        on = on & F.col(k).eqNullSafe(F.col(f"__on_{k}"))
    return rows.join(summary, on, "left").drop(*[f"__on_{k}" for k in [*keys, SEG]])


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def seg_lag(df: DataFrame, keys: Sequence[str], order: Sequence[str],
            value: Column, out: str, segmented: bool) -> DataFrame:
    """``out`` = ``value`` of the previous row within ``keys`` by ``order``.

    ``df`` must carry the segment column (``with_segment``).  ``order`` must be
    a total order within a key (include a tie-break).
    """
    keys = list(keys)
    w = Window.partitionBy(*part_cols(keys, segmented)).orderBy(*order)
    if not segmented:
        return (df.withColumn("__v", value).withColumn(out, F.lag("__v").over(w))
                  .drop("__v"))
    local = df.withColumns({"__v": value, "__rn": F.row_number().over(w)}) \
              .withColumn("__prev_local", F.lag("__v").over(w))
    # last value of each (key, segment); then the previous segment's last value
    last = (df.withColumn("__v", value)
              .groupBy(*keys, SEG)
              .agg(F.max_by("__v", _order_struct(order)).alias("__last")))
    wb = Window.partitionBy(*keys).orderBy(SEG)
    carry = last.select(*keys, SEG, F.lag("__last").over(wb).alias("__carry"))
    j = _join_back(local, carry, keys)
    return (j.withColumn(out, F.when(F.col("__rn") == 1, F.col("__carry"))
                                .otherwise(F.col("__prev_local")))
             .drop("__v", "__rn", "__prev_local", "__carry"))
