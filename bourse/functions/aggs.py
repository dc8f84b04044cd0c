"""Aggregate column helpers.  All are built-in aggregates, so Catalyst plans a
partial (map-side) and a final aggregation around the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_when(cond: Column, value) -> Column:
    """FIRST(CASE WHEN cond THEN value END IGNORE NULLS)."""
    return F.first(F.when(cond, _c(value)), ignorenulls=True)


def min_when(cond: Column, value) -> Column:
    return F.min(F.when(cond, _c(value)))


def max_when(cond: Column, value) -> Column:
    return F.max(F.when(cond, _c(value)))


def first_non_null(value, order) -> Column:
    """Earliest non-null ``value`` by ``order``; deterministic and mergeable
    across micro-batches, unlike an order-dependent ``first``."""
    v = _c(value)
    return F.min_by(v, F.when(v.isNotNull(), _c(order)))


def priority_first(name_col, value_col, names: Sequence[str], default=0) -> Column:
    """COALESCE(first value of names[0], first of names[1], ..., default).

    One value and its name's place are held a group, however many names there are."""
    n, v = _c(name_col), _c(value_col)
    place = None
    for i, x in enumerate(names):
        place = F.when(n == F.lit(x), F.lit(i)) if place is None else place.when(n == F.lit(x), F.lit(i))
    best = F.min_by(v, F.when(v.isNotNull(), place))
    return best if default is None else F.coalesce(best, F.lit(default).cast("double"))
