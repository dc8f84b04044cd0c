"""Incremental file sources and table reads.

Each file is read once: the streaming file source records processed files in
the query checkpoint.  Schemas are fixed before the stream starts (inferred
from the files present when none is given, like a loader's schema location).
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.sources.rescue import rescued_column


def with_lineage(df: DataFrame, ingest_col: str = "ingest_timestamp") -> DataFrame:
    """file_name, file_size, file_path from the hidden ``_metadata`` column, and
    the load time (A5).  Works on batch and streaming file sources."""
    return df.withColumns({
        "file_name": F.col("_metadata.file_name"),
        "file_size": F.col("_metadata.file_size"),
        "file_path": F.col("_metadata.file_path"),
        ingest_col: F.current_timestamp(),
    })


def infer_schema(spark: SparkSession, path: str, fmt: str,
                 options: Mapping[str, str] | None = None) -> T.StructType:
    """Schema of the files present now.  CSV: header names, all strings."""
    opts = dict(options or {})
    if fmt == "csv":
        opts.setdefault("header", "true")
        head = spark.read.options(**opts).csv(path).schema
        return T.StructType([T.StructField(f.name, T.StringType()) for f in head.fields])
    return spark.read.options(**opts).format(fmt).load(path).schema


def _as_landed(kind: T.DataType, numbers: bool) -> T.DataType:
    """An inferred type loosened so that later files fit: scalars as text, or, with ``numbers``, whole numbers as doubles."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_landed(f.dataType, numbers)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_landed(kind.elementType, numbers))
    if numbers:
        return T.DoubleType() if isinstance(kind, T.LongType) else kind
    return T.StringType()


def stored_schema(spark: SparkSession, landing: str, store: str, numbers: bool = False,
                  fallback: T.StructType | None = None) -> T.StructType:
    """The schema of a JSON source (A1): inferred from the files of the first load, loosened, and kept in ``store``.

    Later loads take the kept one, so a file that would be inferred otherwise changes no table's columns: what the schema
    does not name or cannot hold is rescued.  Nothing landed yet: ``fallback``, which is not kept."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    kept = fs_path(store)
    if kept.getFileSystem(conf).exists(kept):
        return T.StructType.fromJson(json.loads(spark.read.text(store).first()["value"]))
    folder = fs_path(landing)
    fs = folder.getFileSystem(conf)
    if not (fs.exists(folder) and any(True for _ in fs.listStatus(folder))):
        if fallback is None:
            raise ValueError(f"nothing has landed in {landing} yet and no schema is given")
        return fallback
    found = infer_schema(spark, landing, "json")
    found = _as_landed(T.StructType([f for f in found.fields if f.name != "_corrupt_record"]), numbers)
    spark.createDataFrame([(json.dumps(found.jsonValue()),)], "value string").coalesce(1).write.mode("overwrite").text(store)
    return found


def read_files_stream(spark: SparkSession, path: str, fmt: str,
                      schema: T.StructType | None = None,
                      options: Mapping[str, str] | None = None,
                      rescue: bool = False, lineage: bool = True,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of new files under ``path`` (A1-A3).

    rescue=True.  JSON: lines are parsed with ``schema``; what the schema does
    not name or cannot hold, and malformed lines, are kept in ``_rescued_data``
    (A4), so nothing unexpected fails the load or gets lost.  CSV: lines with
    too many or too few fields are kept whole in ``_rescued_data``.

    CSV columns are bound by position, so a file whose header differs from the
    schema in names or order fails the load instead of swapping values.
    """
    opts = dict(options or {})
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    if schema is None:
        schema = infer_schema(spark, path, fmt, options)
    if fmt == "json" and rescue:
        raw = spark.readStream.options(**opts).text(path)
        df = raw.select("value", F.from_json(F.col("value"), schema).alias("__r"), F.col("_metadata"))
        df = df.select("__r.*", rescued_column(F.col("value"), schema, F.col("__r")).alias("_rescued_data"), "_metadata")
    else:
        if fmt == "csv":
            opts.setdefault("header", "true")
            opts.setdefault("enforceSchema", "false")
            if rescue:
                opts["columnNameOfCorruptRecord"] = "_rescued_data"
                schema = T.StructType([*schema.fields, T.StructField("_rescued_data", T.StringType())])
        df = spark.readStream.schema(schema).options(**opts).format(fmt).load(path)
    if lineage:
        df = with_lineage(df)
    if "_metadata" in df.columns:
        df = df.drop("_metadata")
    return df


def read_files(spark: SparkSession, path: str, fmt: str, schema: T.StructType | None = None,
               options: Mapping[str, str] | None = None, lineage: bool = True) -> DataFrame:
    """Batch counterpart of ``read_files_stream`` (same columns)."""
    opts = dict(options or {})
    if fmt == "csv":
        opts.setdefault("header", "true")
        opts.setdefault("enforceSchema", "false")
        if schema is None:
            schema = infer_schema(spark, path, fmt, options)
    r = spark.read.options(**opts)
    if schema is not None:
        r = r.schema(schema)
    df = r.format(fmt).load(path)
    return with_lineage(df) if lineage else df


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """Batch read of an upstream table by catalog name or path."""
    if "/" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.read.table(name_or_path)


def stream_table(spark: SparkSession, name_or_path: str, schema: T.StructType | None = None,
                 fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of an upstream append-only table (A10)."""
    if "/" not in name_or_path:
        return spark.readStream.table(name_or_path)
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if schema is None:
        schema = spark.read.format(fmt).load(name_or_path).schema
    return r.schema(schema).format(fmt).load(name_or_path)
