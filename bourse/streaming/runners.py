"""Table runners (A12-A15, K8) and stream helpers.

Sinks are paths in the shared storage (Parquet).  Every streaming runner has
a checkpoint, so a restarted or re-run query resumes where it stopped and a
lost executor only re-runs its tasks.  ``foreachBatch`` writers key their
output by batch id and overwrite it, so a replayed micro-batch is idempotent.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bourse.operators.quality import RuleSet, expectation_counts


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def make_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def _trigger(w, trigger: str | None):
    if trigger in (None, "availableNow"):
        return w.trigger(availableNow=True)
    if trigger == "once":
        return w.trigger(once=True)
    return w.trigger(processingTime=trigger)


def run_append(df: DataFrame, path: str, checkpoint: str, trigger: str | None = "availableNow",
               fmt: str = "parquet", partition_by: tuple[str, ...] = (),
               wait: bool = True) -> StreamingQuery:
    """Append-only streaming table (A12); with ``availableNow`` it drains what
    is there and stops."""
    w = df.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = _trigger(w, trigger).start(path)
    if wait and trigger in (None, "availableNow", "once"):
        q.awaitTermination()
    return q


def run_refresh(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: tuple[str, ...] = ()) -> None:
    """Fully recomputed batch table.

    Written beside the old one, which gives way only to a whole new table: a refresh that fails leaves what was there,
    and one that was broken off between its two renames is put right by the next.  A table may be refreshed from itself."""
    path = path.rstrip("/")
    spark = df.sparkSession
    target, beside, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}__next", f"{path}__old"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(old) and not fs.exists(target):
        fs.rename(old, target)
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(f"{path}__next")
    fs.delete(old, True)
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"cannot put {path} aside")
    if not fs.rename(beside, target):
        raise OSError(f"cannot rename {path}__next to {path}")
    fs.delete(old, True)


def run_sql_view(spark: SparkSession, sql: str, path: str | None = None) -> DataFrame:
    """A SQL text over registered views (A14); written out when ``path`` is given."""
    df = spark.sql(sql)
    if path:
        run_refresh(df, path)
    return df


def temp_view(df: DataFrame, name: str) -> DataFrame:
    """Private intermediate."""
    df.createOrReplaceTempView(name)
    return df


def run_branches(stream: DataFrame, branches: Mapping[str, Callable[[DataFrame], DataFrame]],
                 base_path: str, checkpoint: str, trigger: str | None = "availableNow",
                 wait: bool = True, merges: Sequence[Callable[[DataFrame, int], object]] = ()) -> StreamingQuery:
    """One streaming query feeding several tables (K8): each micro-batch is
    persisted once and every branch (valid, quarantine, ...) is written from it,
    instead of one scan of the source per branch.  Output is keyed by batch id
    (``<base>/<branch>/batch_id=<n>``) and overwritten, so replays are
    idempotent.  ``merges`` take the same batch, with its id, into tables that are kept in place.
    Every branch has a table, though nothing may have arrived yet."""
    spark = stream.sparkSession
    none = spark.createDataFrame([], stream.schema)
    for name, fn in branches.items():
        if not exists(spark, f"{base_path}/{name}"):
            fn(none).write.mode("overwrite").parquet(f"{base_path}/{name}/batch_id=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, fn in branches.items():
                (fn(batch).write.mode("overwrite")
                 .parquet(f"{base_path}/{name}/batch_id={batch_id}"))
            for merge in merges:
                merge(batch, batch_id)
        finally:
            batch.unpersist()
    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    q = _trigger(w, trigger).start()
    if wait and trigger in (None, "availableNow", "once"):
        q.awaitTermination()
    return q


def run_each(stream: DataFrame, fn: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
             trigger: str | None = "availableNow", wait: bool = True) -> StreamingQuery:
    """Writes ``fn(micro-batch)`` to ``<path>/batch_id=<n>`` (overwritten, so replays
    are idempotent).  ``fn`` runs anew for each micro-batch: a reference table that
    it reads is listed again each time and so is never older than the batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        fn(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    q = _trigger(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), trigger).start()
    if wait and trigger in (None, "availableNow", "once"):
        q.awaitTermination()
    return q


def run_expectations(stream: DataFrame, rules: RuleSet, path: str, checkpoint: str,
                     trigger: str | None = "availableNow", wait: bool = True) -> StreamingQuery:
    """Counts the rules of every micro-batch (C6) into a table keyed by batch id;
    unlike progress reports, which keep only the newest batches, none is lost."""
    none = stream.sparkSession.createDataFrame([], stream.schema)
    expectation_counts(none, rules).write.mode("overwrite").parquet(f"{path}/batch_id=-1")
    return run_each(stream, lambda batch: expectation_counts(batch, rules), path, checkpoint, trigger, wait)


def read_expectations(spark: SparkSession, path: str) -> DataFrame:
    """The counts of all micro-batches of ``run_expectations``, one row per rule."""
    return spark.read.parquet(path).groupBy("severity", "rule").agg(
        *[F.sum(c).alias(c) for c in ("passed", "failed", "unknown")])


def read_branch(spark: SparkSession, base_path: str, name: str) -> DataFrame:
    """All micro-batches written for one branch."""
    return spark.read.parquet(f"{base_path}/{name}")
