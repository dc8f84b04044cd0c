"""First arrivals kept without a state that grows in the stream.

``FirstArrivals`` passes on the first row of each key and drops all later ones, as
``dropDuplicates`` on a stream without a watermark does, but keeps the seen keys in a
table: hash buckets of key columns, to which a batch appends its new keys only.

A batch reads the buckets it touches.  Stored keys are first cut to those the batch
holds too (a semi join, for which Spark builds a Bloom filter of the batch's keys where
the store is large), and only these hits are compared with the batch's rows.  A bucket
that has come in ``fold`` pieces is written as one by the next batch that reads it
anyway, so the pieces of a bucket are bounded and untouched buckets keep their files.

As in ``keyed``, a batch writes under its own id and is recorded last: one that fails
or runs twice changes nothing.  Keys that are NULL are equal to each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.operators import cdc
from bourse.streaming.keyed import BUCKET, _files, bucket_of


class FirstArrivals:
    """``order`` decides between rows of one key in one micro-batch (else their content does)."""

    RECORD = "bucket string, n_keys long, whole boolean, batch_id long"

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = (), buckets: int = 64, fold: int = 16):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.order, self.buckets, self.fold = list(order), buckets, fold

    def records(self, before: int | None = None) -> DataFrame:
        """The recorded pieces of all batches (before one): bucket, n_keys, whole (holds its bucket's earlier keys too)."""
        fs, p = _files(self.spark, f"{self.path}/records")
        if not fs.exists(p):
            return self.spark.createDataFrame([], self.RECORD)
        r = self.spark.read.schema(self.RECORD).parquet(f"{self.path}/records")
        return r if before is None else r.where(F.col("batch_id") < before)

    def pieces(self, before: int | None = None) -> DataFrame:
        """The pieces that make up each bucket now."""
        w = Window.partitionBy(BUCKET)
        last = F.max(F.when(F.col("whole"), F.col("batch_id"))).over(w)
        return self.records(before).withColumn("base", F.coalesce(last, F.lit(-1))).where("batch_id >= base").drop("base")

    def merge(self, batch: DataFrame, batch_id: int) -> int:
        """Writes the rows of the batch whose keys are new to ``rows/batch_id=``; returns the number of stored keys read."""
        first = cdc.dedup_first(batch, self.keys, self.order).withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        touched = first.select(F.col(BUCKET).cast("string").alias(BUCKET)).distinct()
        found = self.pieces(batch_id).join(touched, BUCKET, "left_semi").collect()      # names of pieces
        kind = T.StructType([batch.schema[k] for k in self.keys])
        read = sum(r["n_keys"] for r in found)
        paths = [f"{self.path}/keys/batch_id={r['batch_id']}/{BUCKET}={r[BUCKET]}" for r in found if r["n_keys"]]
        seen = self.spark.read.schema(kind).parquet(*paths) if paths else self.spark.createDataFrame([], kind)

        def same(a: str, b: str):
            on = F.lit(True)
            for k in self.keys:
                on = on & F.col(f"{a}.`{k}`").eqNullSafe(F.col(f"{b}.`{k}`"))
            return on
        hits = seen.alias("s").join(first.select(*self.keys).alias("b"), same("s", "b"), "left_semi")
        new = first.alias("b").join(hits.alias("s"), same("b", "s"), "left_anti")
        rows = f"{self.path}/rows/batch_id={batch_id}"
        new.drop(BUCKET).write.mode("overwrite").parquet(rows)
        count: dict[str, int] = {}
        for r in found:
            count[r[BUCKET]] = count.get(r[BUCKET], 0) + 1
        full = [b for b, n in count.items() if n + 1 >= self.fold]
        added = self.spark.read.schema(kind).parquet(rows).withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        if full:
            old = seen.withColumn(BUCKET, bucket_of(self.keys, self.buckets)).where(F.col(BUCKET).cast("string").isin(full))
            added = added.unionByName(old)
        own = f"{self.path}/keys/batch_id={batch_id}"
        added.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(own)
        fs, p = _files(self.spark, own)
        stored = T.StructType([*kind, T.StructField(BUCKET, T.StringType())])
        if any(s.isDirectory() for s in fs.listStatus(p)):
            counted = self.spark.read.schema(stored).parquet(own).groupBy(BUCKET).agg(F.count("*").alias("n_keys"))
        else:
            counted = self.spark.createDataFrame([], f"{BUCKET} string, n_keys long")
        whole = F.col(BUCKET).isin(full) if full else F.lit(False)
        counted.withColumn("whole", whole).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/records/batch_id={batch_id}")
        return read

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.merge(batch, batch_id)

    def read(self, schema: T.StructType) -> DataFrame:
        """First rows of all recorded batches; ``schema`` is that of the batches."""
        fs, p = _files(self.spark, f"{self.path}/records")
        done = [s.getPath().getName() for s in fs.listStatus(p) if fs.exists(_files(self.spark, f"{s.getPath()}/_SUCCESS")[1])] if fs.exists(p) else []
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/rows/{name}" for name in done])
