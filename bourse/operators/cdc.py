"""Change data capture over keyed change feeds.

All functions are pure: the current table and the history table are functions
of the change log, so replaying a micro-batch or receiving rows out of order
gives the same result (the streaming runners keep the log; see
``bourse.streaming.cdc``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourse.operators import segmented as S


def _order(seq: str, tie_break: Sequence[str], desc: bool) -> list[Column]:
    cols = [seq, *tie_break]
    if desc:
        return [F.col(c).desc_nulls_last() for c in cols]
    return [F.col(c).asc_nulls_last() for c in cols]


def content_hash(df: DataFrame) -> Column:
    """A hash of a row's content: the last tie-break, so that results do not depend on arrival order."""
    def plain(f) -> Column:
        c = F.col(f"`{f.name}`")
        return F.to_json(F.struct(c)) if "map<" in f.dataType.simpleString() else c
    return F.xxhash64(*[plain(f) for f in df.schema.fields])


def _any_null(keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def scd1(changes: DataFrame, keys: Sequence[str], seq: str,
         tie_break: Sequence[str] = (), keep_null_keys: bool = False) -> DataFrame:
    """Latest row per key by ``seq`` (D1).  Ties go to the greatest ``tie_break``,
    then to the greatest content hash.  ``keep_null_keys`` passes rows with a NULL
    key on as they are (flag-and-keep tables) instead of treating NULL as one key.
    A late row with a lower sequence never replaces a newer one.  ``row_number() = 1`` is planned as a partial
    ``WindowGroupLimit`` before the shuffle, so a hot key is cut to one row per
    map task before it moves."""
    w = Window.partitionBy(*keys).orderBy(*_order(seq, tie_break, desc=True), content_hash(changes).desc())
    keyed = changes.filter(~_any_null(keys)) if keep_null_keys else changes
    out = (keyed.withColumn("__rn", F.row_number().over(w))
                .filter(F.col("__rn") == 1).drop("__rn"))
    return out.unionByName(changes.filter(_any_null(keys))) if keep_null_keys else out


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
                keep_null_keys: bool = False) -> DataFrame:
    """First row per key (D4).  Batch: earliest by ``order``, ties by content hash.
    Streaming: ``dropDuplicates`` (first arrival wins; state per key)."""
    if df.isStreaming:
        return df.dropDuplicates(list(keys))
    if not order:
        raise ValueError("batch dedup_first needs an order for a deterministic result")
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order], content_hash(df))
    keyed = df.filter(~_any_null(keys)) if keep_null_keys else df
    out = (keyed.withColumn("__rn", F.row_number().over(w))
                .filter(F.col("__rn") == 1).drop("__rn"))
    return out.unionByName(df.filter(_any_null(keys))) if keep_null_keys else out


def dedup_within_watermark(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Bounded-state streaming dedup: state for a key is dropped once the
    watermark passes it."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def scd2(changes: DataFrame, keys: Sequence[str], seq: str,
         tracked: Sequence[str] | None = None, except_cols: Sequence[str] = (),
         tie_break: Sequence[str] = (),
         segment: Callable[[Column], Column] | None = None,
         start_col: str = "__START_AT", end_col: str = "__END_AT") -> DataFrame:
    """History table: one row per version.

    A version opens when the tracked columns differ (NULL-safe) from the
    previous row of the key; ``start_col`` is its first sequence and
    ``end_col`` the next version's start (NULL for the open version).  Columns
    not tracked (``except_cols`` and ``seq`` itself) carry the values of the
    last row of the version, so a change only in them opens nothing.  Rows with
    a NULL key or sequence are not placed (``unplaced`` returns them); equal
    (key, seq) rows keep one, the greatest by ``tie_break``.

    ``segment`` maps the sequence column to a coarse monotone bucket (e.g.
    ``lambda s: F.date_trunc('month', s)``); with it, a key holding a large
    share of the rows is scanned by many tasks (see ``segmented``).
    """
    keys = list(keys)
    cols = changes.columns
    others = [c for c in cols if c not in keys]
    if tracked is None:
        tracked = [c for c in others if c != seq and c not in except_cols]
    segmented = segment is not None
    order_cols = [seq, *tie_break]

    df = changes.filter(F.col(seq).isNotNull())
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    df = S.with_segment(df, segment(F.col(seq)) if segmented else None)
    pcols = S.part_cols(keys, segmented)
    # one hash partitioning on (key[, segment]) serves every window below and,
    # unsegmented, the per-run aggregate and the final lead as well
    df = df.repartition(*pcols)
    # equal (key, seq): keep the greatest tie-break, then a content hash
    wd = Window.partitionBy(*pcols, seq).orderBy(
        *[F.col(c).desc_nulls_last() for c in tie_break],
        F.xxhash64(*[F.col(c) for c in others]).desc())
    df = df.withColumn("__d", F.row_number().over(wd)).filter("__d = 1").drop("__d")

    df = df.withColumn("__t", F.struct(*[F.col(c) for c in tracked]))
    df = _runs_by_segment(df, keys, order_cols, seq) if segmented else _runs(df, keys, order_cols, seq)
    # a version is kept as the last row of its run: the next row opens the next
    # version (or there is none), and its sequence is this version's end
    versions = df.filter(F.col("__next").isNull() | F.col("__next.n"))
    return versions.select(*cols, F.col("__run").alias(start_col),
                           F.col("__next.s").alias(end_col))


def _runs(df: DataFrame, keys: list[str], order: list[str], seq: str) -> DataFrame:
    """Adds ``__run``, the first sequence of a row's run of equal ``__t``, and
    ``__next``, whether the next row opens a run (n) and its sequence (s)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("__new", ~F.col("__t").eqNullSafe(F.lag("__t").over(w)))
    df = df.withColumn("__run", F.max(F.when(F.col("__new"), F.col(seq))).over(upto))
    return df.withColumn("__next", F.lead(F.struct(F.col("__new").alias("n"), F.col(seq).alias("s"))).over(w))


def _runs_by_segment(df: DataFrame, keys: list[str], order: list[str], seq: str) -> DataFrame:
    """The same where a key's rows are spread over segments.

    All windows over rows stay inside (key, segment).  One summary row per
    segment (its first and last ``__t``, first sequence, last run start) is
    scanned per key, which settles whether a segment's first row opens a run,
    which run is open when it begins, and what follows its last row; the summary
    is joined back once.
    """
    part = [*keys, S.SEG]
    w = Window.partitionBy(*part).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first_row = F.col("__i") == 1
    rows = df.withColumns({"__i": F.row_number().over(w), "__before": F.lag("__t").over(w)})
    rows = rows.withColumn("__new", ~first_row & ~F.col("__t").eqNullSafe(F.col("__before"))).drop("__before")
    rows = rows.withColumns({
        "__run_in": F.max(F.when(F.col("__new"), F.col(seq))).over(upto),
        "__next_in": F.lead(F.struct(F.col("__new").alias("n"), F.col(seq).alias("s"))).over(w)})
    at = F.struct(*[F.col(c) for c in order])
    summary = rows.groupBy(*part).agg(
        F.min_by("__t", at).alias("__t0"), F.max_by("__t", at).alias("__t1"), F.min_by(seq, at).alias("__s0"),
        F.max(F.when(F.col("__new"), F.col(seq))).alias("__start_in"))
    by_key = Window.partitionBy(*keys).orderBy(S.SEG)
    summary = summary.withColumn("__opens", ~F.col("__t0").eqNullSafe(F.lag("__t1").over(by_key)))
    start = F.coalesce("__start_in", F.when(F.col("__opens"), F.col("__s0")))
    summary = summary.select(
        *[F.col(c).alias(f"__on_{c}") for c in part], "__opens", "__s0",
        F.last(start, ignorenulls=True).over(by_key.rowsBetween(Window.unboundedPreceding, -1)).alias("__open_run"),
        F.lead(F.struct(F.col("__opens").alias("n"), F.col("__s0").alias("s"))).over(by_key).alias("__after"))
    on = F.lit(True)
    for c in part:  # rows without a key or sequence are not placed, so none of these is NULL
        on = on & (F.col(c) == F.col(f"__on_{c}"))
    j = rows.join(summary, on)
    return j.withColumns({
        "__run": F.coalesce("__run_in", F.when(F.col("__opens"), F.col("__s0")), "__open_run"),
        "__next": F.coalesce("__next_in", "__after")})


def unplaced(changes: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Change rows that ``scd2`` cannot place (NULL key or NULL sequence), so
    they can be quarantined instead of vanishing."""
    cond = F.col(seq).isNull()
    for k in keys:
        cond = cond | F.col(k).isNull()
    return changes.filter(cond)


def current_versions(history: DataFrame, end_col: str = "__END_AT") -> DataFrame:
    """Open versions only."""
    return history.filter(F.col(end_col).isNull())
