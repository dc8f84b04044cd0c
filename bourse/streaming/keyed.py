"""Keyed tables kept in place (K9 with D1, D2): a micro-batch rewrites only what it touches.

``CellTable`` is a Parquet table dealt into cells (folders of its cell columns).  A
batch writes the cells it changes, whole, beside the old ones under its own batch id,
then records them in the commit table; a reader takes each cell from the newest batch
that is recorded.  So a batch that fails or runs twice changes nothing: it reads what
was recorded before it and overwrites its own folder only.  The driver handles names
of cells, never rows.

``LatestTable`` (SCD1) holds one row per key in buckets of the key's hash; a
``DerivedTable`` follows it bucket by bucket.

``HistoryTable`` (SCD2) holds, in cells of key bucket and sequence segment:
  rows      every placed change, equal (key, seq) reduced to one;
  runs      of each run of equal tracked values inside a cell, its first and last row;
  versions  the published history, by bucket.
A late row touches the cell of its sequence: that cell's runs are split or joined
again from its own rows, and the bucket's versions follow from the runs alone, whose
number follows the versions and not the log.  A run is told by its ends: rows between
them open nothing, and excluded columns show the last row's values.  The same holds for
``compact``, which drops the rows between the ends of runs below a sequence from which
on no row can come late any more.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from bourse.operators import cdc
from bourse.streaming.runners import _trigger

BUCKET, SEG = "bucket", "seg"


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


class CellTable:
    """A table in cells, each taken from the newest recorded batch that wrote it."""

    def __init__(self, spark: SparkSession, path: str, cell: Sequence[str]):
        self.spark, self.path, self.cell = spark, path.rstrip("/"), list(cell)
        self._commit = T.StructType([*(T.StructField(c, T.StringType()) for c in self.cell),
                                     T.StructField("n_rows", T.LongType()), T.StructField("batch_id", T.LongType())])

    def commits(self, before: int | None = None) -> DataFrame:
        """The recorded cells of all batches (before one): cell, n_rows, batch_id."""
        fs, p = _files(self.spark, f"{self.path}/commits")
        if not fs.exists(p):
            return self.spark.createDataFrame([], self._commit)
        c = self.spark.read.schema(self._commit).parquet(f"{self.path}/commits")
        return c if before is None else c.where(F.col("batch_id") < before)

    def newest(self, cells: DataFrame | None = None, before: int | None = None) -> DataFrame:
        """One row per cell (of ``cells``): the batch that holds it, and its rows."""
        c = self.commits(before)
        if cells is not None:
            c = c.join(cells.select(*(F.col(x).cast("string").alias(x) for x in self.cell)).distinct(), self.cell, "left_semi")
        return c.groupBy(*self.cell).agg(F.max_by("n_rows", "batch_id").alias("n_rows"), F.max("batch_id").alias("batch_id"))

    def read(self, schema: T.StructType, cells: DataFrame | None = None, before: int | None = None) -> tuple[DataFrame, int]:
        """(rows of the newest state of all or some cells, their number by the records); without cell columns."""
        fs, p = _files(self.spark, f"{self.path}/commits")
        if not fs.exists(p):                                # nothing recorded: no need to find out which cells are asked for
            return self.spark.createDataFrame([], schema), 0
        found = self.newest(cells, before).collect()        # names of cells
        paths = [f"{self.path}/data/batch_id={r['batch_id']}/" + "/".join(f"{c}={r[c]}" for c in self.cell) for r in found if r["n_rows"]]
        if not paths:
            return self.spark.createDataFrame([], schema), 0
        return self.spark.read.schema(schema).parquet(*paths), sum(r["n_rows"] for r in found)

    def write(self, rows: DataFrame, batch_id: int, cells: DataFrame | None = None) -> DataFrame:
        """The cells of ``rows`` (with their cell columns) become these rows, other ``cells`` become empty; returns the cells."""
        own = f"{self.path}/data/batch_id={batch_id}"
        # large cells are split and small ones put together by their real sizes, so a cell may have several files
        rows.hint("rebalance", *self.cell).write.mode("overwrite").partitionBy(*self.cell).parquet(own)
        fs, p = _files(self.spark, own)
        kind = T.StructType([T.StructField(c, T.StringType()) for c in self.cell])
        if any(s.isDirectory() for s in fs.listStatus(p)):
            counted = self.spark.read.schema(kind).parquet(own).groupBy(*self.cell).agg(F.count("*").alias("n_rows"))
        else:
            counted = self.spark.createDataFrame([], kind).withColumn("n_rows", F.lit(0).cast("long"))
        if cells is not None:
            names = cells.select(*(F.col(c).cast("string").alias(c) for c in self.cell)).distinct()
            counted = counted.unionByName(names.join(counted, self.cell, "left_anti").withColumn("n_rows", F.lit(0).cast("long")))
        target = f"{self.path}/commits/batch_id={batch_id}"
        counted.coalesce(1).write.mode("overwrite").parquet(target)
        return self.spark.read.schema(T.StructType([*kind, T.StructField("n_rows", T.LongType())])).parquet(target)

    def vacuum(self, keep: int = 2) -> int:
        """Deletes cells that a recorded batch at least ``keep`` batches back has replaced; returns their number."""
        w = Window.partitionBy(*self.cell).orderBy("batch_id")
        last = self.commits().agg(F.max("batch_id").alias("n")).first()["n"]
        if last is None:
            return 0
        old = self.commits().withColumn("next", F.lead("batch_id").over(w)).where(F.col("next") <= last - keep).collect()
        gone = 0
        for r in old:
            fs, p = _files(self.spark, f"{self.path}/data/batch_id={r['batch_id']}/" + "/".join(f"{c}={r[c]}" for c in self.cell))
            gone += bool(fs.exists(p) and fs.delete(p, True))
        return gone


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class LatestTable:
    """SCD1 in place: the newest row per key, as ``cdc.scd1`` of all changes gives it.

    ``by`` names the keys that choose a row's bucket (else all), for tables derived by bucket."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], seq: str, tie_break: Sequence[str] = (), buckets: int = 64,
                 by: Sequence[str] = ()):
        self.table, self.keys, self.seq, self.tie_break, self.buckets = CellTable(spark, path, [BUCKET]), list(keys), seq, list(tie_break), buckets
        self.by = list(by) or self.keys

    def merge(self, changes: DataFrame, batch_id: int) -> int:
        """Takes a batch of changes in; returns the number of stored rows it read."""
        # a key's bucket follows from the key alone: the batch need not be reduced to know what it touches
        old, read = self.table.read(changes.schema, changes.select(bucket_of(self.by, self.buckets).alias(BUCKET)), before=batch_id)
        whole = cdc.scd1(old.unionByName(changes) if read else changes, self.keys, self.seq, self.tie_break)
        self.table.write(whole.withColumn(BUCKET, bucket_of(self.by, self.buckets)), batch_id)
        return read

    def read(self, schema: T.StructType) -> DataFrame:
        return self.table.read(schema)[0]


class DerivedTable:
    """A table computed from a ``LatestTable``, refreshed where that changed.

    ``fn`` maps rows to rows and treats each value of the source's ``by`` columns, which its result keeps, by itself
    (any grouping, join or window whose keys hold them); so a bucket's result follows from that bucket alone and equals
    ``fn`` of the whole source.  A bucket that ends without rows is recorded as empty."""

    def __init__(self, source: LatestTable, path: str, fn: Callable[[DataFrame], DataFrame]):
        self.source, self.fn, self.table = source, fn, CellTable(source.table.spark, path, [BUCKET])

    def refresh(self, schema: T.StructType, batch_id: int) -> int:
        """Computes the buckets anew that this batch of the source wrote; returns the number of source rows read."""
        cells = self.source.table.commits(batch_id + 1).where(F.col("batch_id") == batch_id).select(BUCKET)
        rows, read = self.source.table.read(schema, cells, before=batch_id + 1)
        self.table.write(self.fn(rows).withColumn(BUCKET, bucket_of(self.source.by, self.source.buckets)), batch_id, cells)
        return read

    def read(self, schema: T.StructType) -> DataFrame:
        """The derived rows; ``schema`` is that of the source."""
        return self.table.read(self.fn(self.table.spark.createDataFrame([], schema)).schema)[0]


def ends_of_runs(rows: DataFrame, part: Sequence[str], seq: str, tracked: Sequence[str]) -> DataFrame:
    """The first and the last row of each run of equal tracked values, in order of ``seq`` within ``part``."""
    w = Window.partitionBy(*part).orderBy(seq)
    t = F.struct(*tracked)
    inner = t.eqNullSafe(F.lag(t).over(w)) & t.eqNullSafe(F.lead(t).over(w))
    return rows.withColumn("__inner", inner).where(~F.col("__inner")).drop("__inner")


class HistoryTable:
    """SCD2 in place: versions per key, as ``cdc.scd2`` of all changes gives them, in any order of arrival.

    ``segment`` maps a sequence to a coarse value that never falls as it grows: a key's
    rows of one segment are one unit of work."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], seq: str, segment: Callable[[Column], Column],
                 except_cols: Sequence[str] = (), tie_break: Sequence[str] = (), buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.seq, self.segment, self.except_cols = list(keys), seq, segment, list(except_cols)
        self.tie_break, self.buckets = list(tie_break), buckets
        self.rows = CellTable(spark, f"{self.path}/rows", [BUCKET, SEG])
        self.runs = CellTable(spark, f"{self.path}/runs", [BUCKET, SEG])
        self.versions = CellTable(spark, f"{self.path}/versions", [BUCKET])

    def _tracked(self, columns: Sequence[str]) -> list[str]:
        return [c for c in columns if c not in self.keys and c != self.seq and c not in self.except_cols]

    def _celled(self, changes: DataFrame) -> DataFrame:
        seg = F.regexp_replace(self.segment(F.col(self.seq)).cast("string"), "[^0-9A-Za-z.-]", "_")      # the name of a folder
        return changes.withColumns({BUCKET: bucket_of(self.keys, self.buckets), SEG: seg})

    def _write(self, rows: DataFrame, schema: T.StructType, batch_id: int) -> int:
        """rows: whole new content of their cells.  Returns the number of runs read for the versions."""
        cells = self.rows.write(rows, batch_id)
        stored = self._celled(self.rows.read(schema, cells, before=batch_id + 1)[0])
        self.runs.write(ends_of_runs(stored, [*self.keys, SEG], self.seq, self._tracked(schema.names)), batch_id)
        touched = cells.select(BUCKET).distinct()
        near = self.runs.commits(batch_id + 1).join(touched, BUCKET, "left_semi").select(BUCKET, SEG)
        runs, read = self.runs.read(schema, near, before=batch_id + 1)
        self.versions.write(self._history(runs).withColumn(BUCKET, bucket_of(self.keys, self.buckets)), batch_id)
        return read

    def _history(self, rows: DataFrame) -> DataFrame:
        return cdc.scd2(rows, self.keys, self.seq, except_cols=self.except_cols, tie_break=self.tie_break, segment=self.segment)

    def merge(self, changes: DataFrame, batch_id: int) -> dict[str, int]:
        """Takes a batch of changes in, late or not; rows without key or sequence are not placed (``cdc.unplaced``).

        Returns how many stored rows and runs it read."""
        placed = changes.where(F.col(self.seq).isNotNull())
        for k in self.keys:
            placed = placed.where(F.col(k).isNotNull())
        new = self._celled(placed)
        old, rows_read = self.rows.read(changes.schema, new.select(BUCKET, SEG), before=batch_id)
        others = [F.col(c) for c in changes.columns if c not in self.keys]
        w = Window.partitionBy(*self.keys, SEG, self.seq).orderBy(*[F.col(c).desc_nulls_last() for c in self.tie_break], F.xxhash64(*others).desc())
        whole = self._celled(old.unionByName(placed)).withColumn("__d", F.row_number().over(w)).where("__d = 1").drop("__d")
        return {"rows": rows_read, "runs": self._write(whole, changes.schema, batch_id)}

    def compact(self, schema: T.StructType, below, batch_id: int) -> int:
        """Drops rows between the ends of runs, where the sequence is below ``below``; returns how many rows are left.

        Lossless as long as later changes have sequences of ``below`` or more: the last row below it stays, so a run
        that such a change splits keeps both its ends."""
        stored = self._celled(self.rows.read(schema)[0])
        early = ends_of_runs(stored.where(F.col(self.seq) < F.lit(below)), [*self.keys, SEG], self.seq, self._tracked(schema.names))
        touched = stored.where(F.col(self.seq) < F.lit(below)).select(BUCKET, SEG).distinct()
        late = stored.where(F.col(self.seq) >= F.lit(below)).join(touched, [BUCKET, SEG], "left_semi").select(*early.columns)
        self._write(early.unionByName(late), schema, batch_id)
        return self.rows.newest().agg(F.sum("n_rows").alias("n")).first()["n"] or 0

    def read(self, schema: T.StructType) -> DataFrame:
        """The history; ``schema`` is that of the changes."""
        empty = self._history(self.spark.createDataFrame([], schema)).schema
        return self.versions.read(empty)[0]

    def vacuum(self, keep: int = 2) -> int:
        return sum(t.vacuum(keep) for t in (self.rows, self.runs, self.versions))


def merge_stream(stream: DataFrame, table, checkpoint: str, trigger: str | None = "availableNow",
                 wait: bool = True) -> StreamingQuery:
    """Every micro-batch is merged into the table (any with ``merge(batch, batch_id)``); a replayed one leaves it as it was."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            table.merge(batch, batch_id)
    q = _trigger(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), trigger).start()
    if wait and trigger in (None, "availableNow", "once"):
        q.awaitTermination()
    return q
