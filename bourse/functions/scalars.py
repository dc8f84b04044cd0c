"""Scalar column helpers (built-in expressions only, so they stay in codegen)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_number(col, dtype: str = "double", strict: bool = False) -> Column:
    """String -> number.  Tolerant by default: bad text becomes NULL so the
    quality rules can see it instead of the cast raising under ANSI."""
    c = _c(col)
    return c.cast(dtype) if strict else c.try_cast(dtype)


def to_date_safe(col, fmt: str | None = None) -> Column:
    """``to_date`` that yields NULL on malformed text instead of failing."""
    c = _c(col)
    return F.try_to_date(c, F.lit(fmt)) if fmt else F.try_to_date(c)


def epoch_to_local(seconds, zone: str = "America/New_York") -> Column:
    """Epoch seconds -> wall clock in ``zone`` (independent of the session zone)."""
    return F.from_utc_timestamp(F.timestamp_seconds(to_number(seconds, "bigint")), zone)


def millis_to_timestamp(millis) -> Column:
    return F.timestamp_millis(_c(millis))


def utc_to_zone(ts, zone: str = "America/New_York") -> Column:
    return F.from_utc_timestamp(_c(ts), zone)


def safe_div(num, den) -> Column:
    """Division that gives NULL for a zero or NULL divisor (never raises)."""
    return F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))


def pct_change(cur, base) -> Column:
    """(cur - base) / base * 100, NULL when base is 0 or NULL."""
    return safe_div(_c(cur) - _c(base), base) * F.lit(100)


def ratio_round(num, den, scale: int = 4, pct: bool = False) -> Column:
    r = safe_div(num, den)
    return F.round(r * F.lit(100) if pct else r, scale)


def bucketize(branches: Sequence[tuple[Column | str, object]], else_=None) -> Column:
    """First matching branch wins; NULL conditions fall through to ``else_``.

    ``branches`` is a list of (condition, label); a string condition is parsed
    as SQL.
    """
    out = None
    for cond, label in branches:
        cond = F.expr(cond) if isinstance(cond, str) else cond
        val = label if isinstance(label, Column) else F.lit(label)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(else_ if isinstance(else_, Column) else F.lit(else_))


def period_label(year, quarter) -> Column:
    """FY<year> for quarter 0, else Q<q>-<year>."""
    y, q = _c(year).cast("string"), _c(quarter)
    return F.when(q == 0, F.concat(F.lit("FY"), y)).otherwise(
        F.concat(F.lit("Q"), q.cast("string"), F.lit("-"), y))


def excludes_any(arr, codes: Iterable[str]) -> Column:
    """NOT arrays_overlap(arr, codes): NULL array -> NULL, empty -> TRUE."""
    return ~F.arrays_overlap(_c(arr), F.array(*[F.lit(str(x)) for x in codes]))


def binary_to_text(col) -> Column:
    return _c(col).cast("string")
