"""Rank and percent rank without one task per partition key (H8).

``Window.partitionBy(part).orderBy(v)`` sends a whole partition key (or, with
no key, the whole table) to one task.  A rank only depends on how many rows
have each value, so here rows are first counted by (part, value), combined
map-side: a value that very many rows share is one row from then on.  The
distinct values are dealt into buckets by a monotone function of the value; a
running count within each bucket plus the counts of the buckets before it gives
each value's rank, which joins back on (part, value).  Values keep their own
types, nothing is sampled, materialised or run while the plan is built, and a hot
value is only a skewed join key (split by AQE).

Buckets follow the values' distribution: the first ones are by order of magnitude;
one that holds more than ``FULL`` distinct values is cut into ``CUTS`` equal stretches
between its own least and greatest value, and full ones of those once more.  Numbers,
dates and timestamps are cut by value, strings and binaries by the bytes that follow
what the bucket's least and greatest value have in common, so that narrow ranges and
long common beginnings spread as well.

Result: ``rank`` with SQL semantics (ties share the lowest rank; NaN is the
greatest value) and ``percent_rank`` = (rank - 1) / (n - 1), 0 for a single row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# buckets per factor e of a value's size: values of one magnitude spread over this many
BUCKETS_PER_E = 64
_FAR = 1 << 20
#: Distinct values beyond which a bucket is cut, stretches of a cut, and how often buckets are cut at most
FULL, CUTS, LEVELS = 4096, 1024, 2
#: Bytes compared to find a common beginning, and bytes of a string's place (exact as a double)
COMMON, PLACE = 256, 6


def order_bucket(value: Column, kind: T.DataType) -> Column:
    """A whole number that never falls as the value grows; NULL for NULL.

    Numbers, dates and timestamps: sign(v) * log(1 + |v|), scaled.  Other types
    begin in one bucket.
    """
    v = _number(value, kind)
    if v is None:
        return F.when(value.isNotNull(), F.lit(0).cast("long"))
    spread = F.floor(F.signum(v) * F.log1p(F.abs(v)) * BUCKETS_PER_E)
    return (F.when(F.isnan(v) | (v == float("inf")), F.lit(_FAR).cast("long"))
            .when(v == float("-inf"), F.lit(-_FAR).cast("long")).otherwise(spread.cast("long")))


def _number(value: Column, kind: T.DataType) -> Column | None:
    """A double that never falls as the value grows, if the type has one."""
    if isinstance(kind, T.TimestampNTZType):
        value = value.cast("timestamp")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.NumericType, T.TimestampType, T.TimestampNTZType)):
        return value.cast("double")
    return None


def _common(a: Column, b: Column) -> Column:
    """Number of bytes that two binaries begin with alike, up to COMMON."""
    most = F.least(F.length(a), F.length(b), F.lit(COMMON))
    alike = F.filter(F.sequence(F.lit(0), most), lambda i: F.substring(a, F.lit(1), i) == F.substring(b, F.lit(1), i))
    return F.size(alike) - 1


def _place(value: Column, skip: Column) -> Column:
    """The bytes of a binary behind the first ``skip`` as a double."""
    return F.conv(F.rpad(F.hex(F.substring(value, skip + 1, F.lit(PLACE))), 2 * PLACE, "0"), 16, 10).cast("double")


def cut_full(counts: DataFrame, names: Sequence[str], kind: T.DataType) -> DataFrame:
    """counts (names, ``__rk_v``, ``__rk_n``, ``__rk_b``) with buckets that hold more than FULL values cut into CUTS
    stretches.  One row a bucket is joined to the values: the values themselves stay where they are."""
    v = F.col("__rk_v")
    if _number(v, kind) is None and not isinstance(kind, (T.StringType, T.BinaryType)):
        return counts
    stats = counts.groupBy(*names, "__rk_b").agg(F.count("__rk_v").alias("__rk_d"), F.min("__rk_v").alias("__rk_lo"), F.max("__rk_v").alias("__rk_hi"))
    stats = stats.where(F.col("__rk_d") > FULL)
    if _number(v, kind) is not None:
        stats = stats.withColumns({"__rk_lo": _number(F.col("__rk_lo"), kind), "__rk_hi": _number(F.col("__rk_hi"), kind), "__rk_skip": F.lit(0)})
        at = _number(v, kind)
    else:
        stats = stats.withColumns({"__rk_lo": F.col("__rk_lo").cast("binary"), "__rk_hi": F.col("__rk_hi").cast("binary")})
        stats = stats.withColumn("__rk_skip", _common(F.col("__rk_lo"), F.col("__rk_hi")))
        stats = stats.withColumns({c: _place(F.col(c), F.col("__rk_skip")) for c in ("__rk_lo", "__rk_hi")})
        at = _place(v.cast("binary"), F.col("__rk_skip"))
    on = F.col("__rk_b") == F.col("__rk_sb")
    for n in names:  # NULL is a partition value like any other
        on = on & F.col(n).eqNullSafe(F.col(f"{n}s"))
    stats = stats.select(*[F.col(n).alias(f"{n}s") for n in names], F.col("__rk_b").alias("__rk_sb"), "__rk_lo", "__rk_hi", "__rk_skip")
    share = F.try_divide(at - F.col("__rk_lo"), F.col("__rk_hi") - F.col("__rk_lo"))
    cut = F.coalesce(F.floor(share * (CUTS - 1)).cast("long"), F.lit(0))
    return counts.join(stats, on, "left").select(*names, "__rk_v", "__rk_n", (F.col("__rk_b") * CUTS + cut).alias("__rk_b"))


def value_buckets(df: DataFrame, part: Sequence[str], value: str) -> DataFrame:
    """Distinct (part, value) with their counts ``__rk_n`` and ordered buckets ``__rk_b``."""
    names = [f"__rk_p{i}" for i in range(len(part))]
    kind = df.schema[value].dataType
    keys = [F.col(p).alias(n) for p, n in zip(part, names)]
    counts = df.select(*keys, F.col(value).alias("__rk_v")).groupBy(*names, "__rk_v").agg(F.count(F.lit(1)).alias("__rk_n"))
    counts = counts.withColumn("__rk_b", order_bucket(F.col("__rk_v"), kind))
    for _ in range(LEVELS):
        counts = cut_full(counts, names, kind)
    return counts


def rank_within(df: DataFrame, part: Sequence[str], value: str, out: str = "rank",
                desc: bool = True, pct_out: str | None = None, nulls: str = "last") -> DataFrame:
    """Add ``out`` = rank of ``value`` within ``part`` (bigint; desc by default,
    NULLs last) and optionally ``pct_out`` = percent rank.

    ``nulls="exclude"``: NULL values get NULL ranks and do not count in the
    percent-rank denominator (NULLs sort last, so other ranks are unchanged).
    """
    part = list(part)
    names = [f"__rk_p{i}" for i in range(len(part))]
    v = F.col("__rk_v")

    def ordered(c: str) -> Column:
        return F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last()

    counts = value_buckets(df, part, value)
    before = Window.unboundedPreceding, -1
    inside = counts.withColumn("__rk_in", F.sum("__rk_n").over(
        Window.partitionBy(*names, "__rk_b").orderBy(ordered("__rk_v")).rowsBetween(*before)))
    # one row per part and bucket: a fraction of the distinct values
    sums = counts.groupBy(*names, "__rk_b").agg(
        F.sum("__rk_n").alias("__rk_s"),
        F.sum(F.when(v.isNotNull(), F.col("__rk_n")).otherwise(0)).alias("__rk_sv"))
    off = sums.select(
        *[F.col(n).alias(f"{n}b") for n in names], F.col("__rk_b").alias("__rk_bb"),
        F.sum("__rk_s").over(Window.partitionBy(*names).orderBy(ordered("__rk_b")).rowsBetween(*before)).alias("__rk_off"),
        F.sum("__rk_sv" if nulls == "exclude" else "__rk_s").over(Window.partitionBy(*names)).alias("__rk_tot"))
    same = F.col("__rk_b").eqNullSafe(F.col("__rk_bb"))
    for n in names:  # NULL is a partition value like any other
        same = same & F.col(n).eqNullSafe(F.col(f"{n}b"))
    rank = F.lit(1) + F.coalesce("__rk_in", F.lit(0)) + F.coalesce("__rk_off", F.lit(0))
    if nulls == "exclude":
        rank = F.when(v.isNotNull(), rank)
    ranks = inside.join(off, same).select(*names, "__rk_v", rank.cast("long").alias("__rk_rank"), "__rk_tot")
    back = F.col(value).eqNullSafe(F.col("__rk_v"))
    for p, n in zip(part, names):
        back = back & F.col(p).eqNullSafe(F.col(n))
    res = df.join(ranks, back).withColumn(out, F.col("__rk_rank"))
    if pct_out:
        res = res.withColumn(
            pct_out, F.when(F.col(out).isNull(), F.lit(None))
            .when(F.col("__rk_tot") <= 1, F.lit(0.0))
            .otherwise((F.col(out) - 1).cast("double") / (F.col("__rk_tot") - 1).cast("double")))
    return res.drop(*names, "__rk_v", "__rk_rank", "__rk_tot")
