"""Bars of a stream that lose no late row (K2-K4, AG3-AG7).

A watermarked aggregate of a stream drops rows behind the watermark without a trace.
``BarTable`` takes micro-batches and keeps, per batch id,

  ledger    the watermark after the batch: greatest event time so far less ``delay``
  open      partials of windows that are not over yet (what a stream's state would hold)
  bars      partials of windows that the watermark has passed, written once
  late      rows whose window was already closed, and rows without an event time

so rows of the closed bars, of the open ones and of the side table add up to the input.
Partials merge (``operators.bars.bar_partials``): ``bars(corrected=True)`` puts late rows into the bars
they belong to and equals the bars of all rows in one batch.  The ledger is a batch's
record: one that fails or runs twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.operators import bars as B
from bourse.streaming.keyed import _files


class BarTable:
    """``tie_break`` orders trades of equal time; ``schema`` is that of the micro-batches."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, width: str = "1 minute", delay: str = "30 seconds",
                 tie_break: str | None = None, **columns):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.width, self.delay, self.columns = width, delay, dict(columns, tie_break=tie_break)
        self.ts, self.key = columns.get("ts", "timestamp"), columns.get("key", "symbol")
        self._partial = B.bar_partials(spark.createDataFrame([], schema), width=width, **self.columns).schema

    def _ids(self, before: int | None = None) -> list[int]:
        """Recorded batches."""
        fs, p = _files(self.spark, f"{self.path}/ledger")
        if not fs.exists(p):
            return []
        done = [s.getPath() for s in fs.listStatus(p) if fs.exists(_files(self.spark, f"{s.getPath()}/_SUCCESS")[1])]
        ids = sorted(int(x.getName().split("=")[1]) for x in done)
        return ids if before is None else [i for i in ids if i < before]

    def _read(self, what: str, schema: T.StructType, ids: list[int]) -> DataFrame:
        if not ids:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{what}/batch_id={i}" for i in ids])

    def ledger(self) -> DataFrame:
        """watermark, n_rows, n_late and batch_id of every recorded batch."""
        return self.spark.read.parquet(f"{self.path}/ledger")

    def _watermark(self, ids: list[int]):
        if not ids:
            return None
        return self.spark.read.parquet(f"{self.path}/ledger/batch_id={ids[-1]}").first()["watermark"]

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        ids = self._ids(batch_id)
        kind = self.schema[self.ts].dataType
        mark = F.lit(self._watermark(ids)).cast(kind)
        rows = batch.select(*self.schema.names)
        over = F.coalesce(F.window(self.ts, self.width)["end"] <= mark, F.lit(False))      # a window drops rows without a time
        marked = rows.where(F.col(self.ts).isNotNull()).withColumn("__late", over) \
            .unionByName(rows.where(F.col(self.ts).isNull()).withColumn("__late", F.lit(True))).persist()
        try:
            self._merge(marked, mark, kind, ids, batch_id)
        finally:
            marked.unpersist()

    def _merge(self, marked: DataFrame, mark, kind: T.DataType, ids: list[int], batch_id: int) -> None:
        seen = marked.agg(F.max(F.when(~F.col("__late"), F.col(self.ts))).alias("top"), F.count("*").alias("n_rows"),
                          F.count_if("__late").alias("n_late")).first()      # one row per batch
        step = F.lit(seen["top"]).cast(kind) - F.expr(f"INTERVAL {self.delay}")
        now = self.spark.range(1).select(F.greatest(mark, step).cast(kind).alias("watermark"), F.lit(seen["n_rows"]).alias("n_rows"),
                                         F.lit(seen["n_late"]).alias("n_late"))
        after = F.lit(now.first()["watermark"]).cast(kind)

        def own(what: str) -> str:
            return f"{self.path}/{what}/batch_id={batch_id}"
        marked.where("__late").drop("__late").write.mode("overwrite").parquet(own("late"))
        fresh = B.bar_partials(marked.where(~F.col("__late")).drop("__late"), width=self.width, **self.columns)
        whole = B.merge_partials(self._read("open", self._partial, ids[-1:]).unionByName(fresh), self.key)
        whole.write.mode("overwrite").parquet(own("state"))
        whole = self.spark.read.schema(self._partial).parquet(own("state"))
        closed = F.coalesce(F.col("window.end") <= after, F.lit(False))
        whole.where(closed).write.mode("overwrite").parquet(own("bars"))
        whole.where(~closed).write.mode("overwrite").parquet(own("open"))
        now.coalesce(1).write.mode("overwrite").parquet(own("ledger"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.merge(batch, batch_id)

    def late(self) -> DataFrame:
        """Rows that came behind the watermark, or without an event time."""
        return self._read("late", self.schema, self._ids())

    def partials(self, open_too: bool = False, corrected: bool = False) -> DataFrame:
        ids = self._ids()
        out = self._read("bars", self._partial, ids)
        if open_too:
            out = out.unionByName(self._read("open", self._partial, ids[-1:]))
        if corrected:
            behind = self.late().where(F.col(self.ts).isNotNull())
            out = B.merge_partials(out.unionByName(B.bar_partials(behind, width=self.width, **self.columns)), self.key)
        return out

    def bars(self, open_too: bool = False, corrected: bool = False) -> DataFrame:
        """Bars of the windows that are over (``open_too``: of all); ``corrected`` with their late rows."""
        return B.bar_metrics(B.finish_partials(self.partials(open_too, corrected), self.key), key=self.key)
