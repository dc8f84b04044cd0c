"""JSON sources without a schema, kept as VARIANT (A1).

Bronze holds each record as it came, so no file can be of a shape that the table
cannot take or that makes it unreadable.  A schema is found afterwards from the
records (one aggregate over them), widened by what earlier loads found, and kept
beside the checkpoint; types only ever move up the lattice

    void < bigint < double < variant,   void < any other scalar < variant,
    structs by field, arrays by element, a scalar against a nested type: variant

so columns never disappear or narrow between loads.  ``typed`` reads the records
through it: a field whose files disagree stays VARIANT with every value whole.

Defined cases: a line that is no JSON is kept in ``_rescued_data`` with a NULL
record; an empty table, or records that are not objects, give a schema without
fields; a field that is NULL everywhere is read as a string.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.sources.files import with_lineage

RECORD = "record"


def read_variant_stream(spark: SparkSession, path: str, lineage: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """New files of JSON lines -> record (VARIANT), _rescued_data, lineage columns."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = r.text(path).where(F.length(F.trim("value")) > 0)
    record = F.try_parse_json("value")
    out = raw.select(record.alias(RECORD), F.when(record.isNull(), F.col("value")).alias("_rescued_data"), "_metadata")
    return (with_lineage(out) if lineage else out).drop("_metadata")


def schema_of_records(df: DataFrame, col: str = RECORD) -> T.StructType:
    """The schema of the objects in a VARIANT column: one aggregate, one row to the driver."""
    text = df.agg(F.schema_of_variant_agg(F.col(col)).alias("s")).first()["s"]
    if text is None or not text.startswith("OBJECT<"):
        return T.StructType([])
    ddl = re.sub(r"`(?:[^`]|``)*`|\bOBJECT<", lambda m: m.group() if m.group().startswith("`") else "STRUCT<", text)
    return T._parse_datatype_string(ddl)


def widen(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type of the lattice that holds both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        theirs = {f.name: f.dataType for f in b.fields}
        own = [T.StructField(f.name, widen(f.dataType, theirs.pop(f.name)) if f.name in theirs else f.dataType) for f in a.fields]
        return T.StructType(own + [T.StructField(n, t) for n, t in theirs.items()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widen(a.elementType, b.elementType))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return T.VariantType()


def _loosened(t: T.DataType) -> T.DataType:
    """As found, with decimals as doubles: JSON does not tell them apart."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _loosened(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_loosened(t.elementType))
    return T.DoubleType() if isinstance(t, T.DecimalType) else t


def evolve(spark: SparkSession, found: T.StructType, store: str) -> T.StructType:
    """The schema kept in ``store``, widened by ``found`` and kept again under the next number.

    Each state is a folder of its own and the newest whole one counts, so a failure while one is written loses nothing."""
    p = spark._jvm.org.apache.hadoop.fs.Path(store)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    done = sorted(int(s.getPath().getName()) for s in (fs.listStatus(p) if fs.exists(p) else [])
                  if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))
    found = _loosened(found)
    kept = T.StructType.fromJson(json.loads(spark.read.text(f"{store}/{done[-1]}").first()["value"])) if done else T.StructType([])
    now = widen(kept, found)
    if not done or now != kept:
        at = done[-1] + 1 if done else 0
        spark.createDataFrame([(json.dumps(now.jsonValue()),)], "value string").coalesce(1).write.mode("overwrite").text(f"{store}/{at}")
    return now


def _readable(t: T.DataType) -> T.DataType:
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _readable(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_readable(t.elementType))
    return T.StringType() if isinstance(t, T.NullType) else t


def _member(record: Column, name: str, kind: str) -> Column:
    """One field of a record.  A path can quote a name by either mark; a name that no path can hold is looked up in a map."""
    for mark in "'\"":
        if name and mark not in name:
            return F.try_variant_get(record, f"$[{mark}{name}{mark}]", kind)
    fields = F.try_variant_get(record, "$", "map<string,variant>")
    return F.try_variant_get(F.try_element_at(fields, F.lit(name)), "$", kind)


def typed(df: DataFrame, schema: T.StructType, col: str = RECORD) -> DataFrame:
    """The fields of ``schema`` as columns in place of the VARIANT; a value that its type cannot hold is NULL."""
    fields = [_member(F.col(col), f.name, _readable(f.dataType).simpleString()).alias(f.name) for f in schema.fields]
    names = set(schema.names)
    return df.select(*fields, *[c for c in df.columns if c != col and c not in names])


def unpivot_variant(df: DataFrame, ids: list[str], col: str, fields: dict[str, str], name_col: str = "metric_type") -> DataFrame:
    """VARIANT object of arrays of objects -> (ids, name of the array, ``fields`` of each item).

    The arrays are found row by row, so one that no earlier record had needs no new plan.  Arrays that are NULL or
    empty, and members that are no arrays, give no rows; a field that is missing or of another type is NULL."""
    tvf = df.sparkSession.tvf
    rows = df.select(*ids, F.col(col).alias("__object"))
    named = rows.lateralJoin(tvf.variant_explode(F.col("__object").outer())).where(F.col("key").isNotNull()) \
        .select(*ids, F.col("key").alias(name_col), F.col("value").alias("__array"))
    items = named.lateralJoin(tvf.variant_explode(F.col("__array").outer())).where(F.col("key").isNull())
    return items.select(*ids, name_col, *[F.try_variant_get(F.col("value"), f"$.{f}", kind).alias(f) for f, kind in fields.items()])
