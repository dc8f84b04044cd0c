"""Streaming keyed upserts (K9) over an append-only change log.

Closed SCD2 versions cannot be re-split by a row that arrives late, so the
stream keeps the change log, not the versions: each micro-batch is written to
``<log>/batch_id=<n>`` (overwrite: a replay is idempotent), and the current
(SCD1) and history (SCD2) tables are pure functions of the whole log.  Their
result is therefore the same for any split of the input into micro-batches
and any arrival order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from bourse.operators import cdc
from bourse.streaming.runners import _trigger


def append_change_log(stream: DataFrame, log_path: str, checkpoint: str,
                      trigger: str | None = "availableNow", wait: bool = True) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")
    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    q = _trigger(w, trigger).start()
    if wait and trigger in (None, "availableNow", "once"):
        q.awaitTermination()
    return q


def read_change_log(spark: SparkSession, log_path: str) -> DataFrame:
    return spark.read.parquet(log_path).drop("batch_id")


def scd1_stream(stream: DataFrame, keys: Sequence[str], seq: str, log_path: str,
                checkpoint: str, tie_break: Sequence[str] = (), **kw) -> Callable[[], DataFrame]:
    """Run the stream into the log; return a function giving the current table."""
    append_change_log(stream, log_path, checkpoint, **kw)
    spark = stream.sparkSession

    def current() -> DataFrame:
        return cdc.scd1(read_change_log(spark, log_path), keys, seq, tie_break)
    return current


def scd2_stream(stream: DataFrame, keys: Sequence[str], seq: str, log_path: str,
                checkpoint: str, except_cols: Sequence[str] = (), tie_break: Sequence[str] = (),
                segment: Callable[[Column], Column] | None = None, **kw) -> Callable[[], DataFrame]:
    """Run the stream into the log; return a function giving the history table."""
    append_change_log(stream, log_path, checkpoint, **kw)
    spark = stream.sparkSession

    def history() -> DataFrame:
        return cdc.scd2(read_change_log(spark, log_path), keys, seq, except_cols=except_cols,
                        tie_break=tie_break, segment=segment)
    return history
