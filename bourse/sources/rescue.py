"""Schema rescue (A4): parse JSON text with a schema and keep in ``_rescued_data``,
as JSON text, whatever the parsed columns do not hold, instead of failing or
losing it: fields the schema does not name (at any depth), values it cannot
convert, and lines that are no JSON objects (as ``_corrupt_record``).

Values are kept as their JSON text (numbers unquoted in the source become
strings in the rescued object).  NULL when nothing was rescued.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())


def _lost(text: Column, parsed: Column, schema: T.StructType, case_sensitive: bool) -> Column:
    """map<field, JSON text> of what ``parsed`` does not hold of the object ``text``."""
    m = F.from_json(text, _TEXT_MAP)
    fold = (lambda c: c) if case_sensitive else F.lower
    known = F.array(*[F.lit(f.name if case_sensitive else f.name.lower()) for f in schema.fields]).cast("array<string>")
    # named by the schema and present, yet NULL after parsing: not convertible
    unread = F.array_compact(F.array(*[F.when(parsed[f.name].isNull(), F.lit(f.name)) for f in schema.fields])).cast("array<string>")
    extra = F.map_filter(m, lambda k, v: ~F.array_contains(known, fold(k)) | (v.isNotNull() & F.array_contains(unread, k)))
    inner = []
    for f in schema.fields:
        raw, value = F.try_element_at(m, F.lit(f.name)), parsed[f.name]
        if isinstance(f.dataType, T.StructType):
            below = _lost(raw, value, f.dataType, case_sensitive)
            inner.append(F.when(value.isNotNull() & (F.size(below) > 0), F.struct(F.lit(f.name).alias("key"), F.to_json(below).alias("value"))))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            kind = f.dataType.elementType
            below = F.transform(F.arrays_zip(F.from_json(raw, T.ArrayType(T.StringType())).alias("t"), value.alias("p")),
                                lambda z: _lost(z["t"], z["p"], kind, case_sensitive))
            hit = F.exists(below, lambda x: F.size(x) > 0)
            inner.append(F.when(value.isNotNull() & hit, F.struct(F.lit(f.name).alias("key"), F.to_json(below).alias("value"))))
    if not inner:
        return extra
    return F.map_concat(extra, F.map_from_entries(F.array_compact(F.array(*inner))))


def rescued_column(text: Column, schema: T.StructType, parsed: Column | None = None,
                   case_sensitive: bool = True) -> Column:
    """JSON text of what ``from_json`` (``parsed``) does not bind.  ``from_json``
    matches field names case-sensitively, so a key differing only in case is
    rescued, never lost."""
    parsed = F.from_json(text, schema) if parsed is None else parsed
    extra = _lost(text, parsed, schema, case_sensitive)
    broken = F.from_json(text, _TEXT_MAP).isNull() & (F.trim(text) != "")
    return F.when(broken, F.to_json(F.struct(text.alias("_corrupt_record")))).when(F.size(extra) > 0, F.to_json(extra))


def with_rescued(df: DataFrame, text_col: str, schema: T.StructType, out: str = "parsed",
                 rescued: str = "_rescued_data") -> DataFrame:
    """Add ``out`` = from_json(text, schema) and ``rescued`` = what it does not hold."""
    return df.withColumn(out, F.from_json(F.col(text_col), schema)) \
        .withColumn(rescued, rescued_column(F.col(text_col), schema, F.col(out)))
