"""Window operators (H1-H9)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourse.operators import segmented as S
from bourse.operators.sizing import broadcast_if_bounded


def _sort(order: Sequence, desc: bool) -> list[Column]:
    out = []
    for c in order:
        c = F.col(c) if isinstance(c, str) else c
        out.append(c.desc_nulls_last() if desc else c.asc_nulls_last())
    return out


def lag_default(df: DataFrame, col: str, part: Sequence[str], order: Sequence[str],
                default=0, out: str = "previous_value",
                segment: Callable[[Column], Column] | None = None) -> DataFrame:
    """``coalesce(lag(col), default)`` per ``part`` by ``order`` (H1).

    ``order`` must be a total order within ``part``.  With ``segment`` (a
    coarse monotone function of ``order[0]``), a hot key is split across tasks.
    """
    seg = segment(F.col(order[0])) if segment is not None else None
    d = S.with_segment(df, seg)
    d = S.seg_lag(d, part, order, F.col(col), "__lag", segment is not None)
    d = d.withColumn(out, F.coalesce(F.col("__lag"), F.lit(default))).drop("__lag")
    return d.drop(S.SEG) if segment is not None else d


def top1_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, desc: bool) -> DataFrame:
    """One row per key, first by ``order``.  ``row_number() = 1`` plans as a
    partial WindowGroupLimit before the exchange, so each map task forwards at
    most one row per key."""
    w = Window.partitionBy(*keys).orderBy(*_sort(order, desc))
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Latest row per key (H2); include a tie-break in ``order``."""
    return top1_per_key(df, keys, order, desc=True)


def earliest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Earliest row per key (H4)."""
    return top1_per_key(df, keys, order, desc=False)


_GRAINS = {"day": lambda c: F.to_date(c),
           "month": lambda c: F.trunc(F.to_date(c), "month"),
           "year": lambda c: F.trunc(F.to_date(c), "year")}


def snapshot_latest(df: DataFrame, ts: str, grain: str = "day",
                    per: Sequence[str] = ()) -> DataFrame:
    """Rows whose ``ts`` equals the greatest ``ts`` of their calendar ``grain``
    (H3).  ``per=()`` takes that max over all rows (the published behaviour);
    ``per=("symbol",)`` is the per-symbol variant.

    A window partitioned by day would put each whole day in one task.  Here the
    max is a partial + final aggregate (one row per grain and task before the
    shuffle), and the result, one row per calendar period, is joined back.
    Without ``per`` its size is bounded by the number of periods in the data,
    so it is broadcast.
    """
    g = _GRAINS[grain](F.col(ts))
    d = df.withColumn("__g", g)
    mx = d.groupBy(*per, "__g").agg(F.max(ts).alias("__mx"))
    if not per:
        mx = F.broadcast(mx)
    else:
        mx = broadcast_if_bounded(mx)
    cond = [d["__g"] == mx["__g"], d[ts] == mx["__mx"]] + [d[p] == mx[p] for p in per]
    return d.join(mx, cond, "left_semi").drop("__g")


def qualify(df: DataFrame, window_expr: Column, predicate: Callable[[Column], Column]) -> DataFrame:
    """SQL QUALIFY: add a window column, filter on it, drop it (H5)."""
    return (df.withColumn("__q", window_expr)
              .filter(predicate(F.col("__q"))).drop("__q"))


def growth(df: DataFrame, keys: Sequence[str], index: Column | str, value: str,
           out: str, step: int = 1, scale: int = 4) -> DataFrame:
    """Growth against exactly ``index - step`` (H6, H7):
    round((v - prev) / abs(nullif(prev, 0)) * 100, scale); NULL without an
    exact prior period.

    An equi-join on (keys, index) rather than a lag: rows are unique on
    (keys, index), so no key can pile up in one task, and a gap in periods
    gives NULL instead of comparing with an older period.
    """
    idx = F.col(index) if isinstance(index, str) else index
    cur = df.withColumn("__idx", idx)
    prev = cur.select(*[F.col(k).alias(f"__p_{k}") for k in keys],
                      (F.col("__idx") + F.lit(step)).alias("__p_idx"),
                      F.col(value).alias("__prev"))
    cond = [cur[k] == prev[f"__p_{k}"] for k in keys] + [cur["__idx"] == prev["__p_idx"]]
    j = cur.join(prev, cond, "left")
    g = F.round(F.try_divide(F.col(value) - F.col("__prev"),
                             F.abs(F.nullif(F.col("__prev"), F.lit(0)))) * F.lit(100), scale)
    return j.withColumn(out, g).drop("__idx", "__prev", *[f"__p_{k}" for k in keys], "__p_idx")


def flag_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                out: str = "is_latest") -> DataFrame:
    """Mark the newest row per key (H9) without a per-key window: the max of
    the order struct per key is a partial + final aggregate; the flag is a
    join back on the key (AQE splits a hot key's partition on that join)."""
    o = F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])
    mx = df.groupBy(*keys).agg(F.max(o).alias("__mx"))
    mx = broadcast_if_bounded(mx)
    j = df.join(mx, on=list(keys), how="left")
    return j.withColumn(out, o.eqNullSafe(F.col("__mx"))).drop("__mx")
