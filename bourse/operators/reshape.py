"""Unnest, unpivot and pivot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.functions.aggs import priority_first


def q(name: str) -> str:
    """Back-quote a column name (names may start with a digit or hold / & .)."""
    return "`" + name.replace("`", "``") + "`"


def explode_items(df: DataFrame, array_col: str, alias: str, keep: Sequence[str]) -> DataFrame:
    """One row per array element; NULL and empty arrays give no row."""
    return df.select(*[F.col(q(c)) for c in keep], F.explode(F.col(q(array_col))).alias(alias))


STATEMENTS = ("bs", "ic", "cf")


def flatten_statements(df: DataFrame, keep: Sequence[str], data_col: str = "data",
                       report_field: str = "report",
                       filing_fields: Sequence[str] = ("accessNumber", "year", "quarter",
                                                       "startDate", "endDate", "filedDate"),
                       statements: Sequence[str] = STATEMENTS) -> DataFrame:
    """Filings -> one row per (filing, statement item).

    One pass: each filing's statement arrays are tagged with their statement
    name and concatenated (a NULL array counts as empty) before a single
    explode, instead of three explodes of the same input and a union.  The
    ``statement`` column keeps the origin (and the tie-break bs < ic < cf).
    ``value`` is cast tolerantly: non-numeric text becomes NULL.
    """
    filings = df.select(*[F.col(q(c)) for c in keep],
                        F.explode(F.col(q(data_col))).alias("__f"))
    def tag(name: str):
        # one-argument lambda: a second parameter would receive the index
        return lambda x: F.struct(F.lit(name).alias("statement"), x.alias("item"))
    tagged = []
    for s in statements:
        arr = F.col(f"__f.{report_field}.{s}")
        tagged.append(F.coalesce(F.transform(arr, tag(s)), F.array()))
    items = filings.select(*[F.col(q(c)) for c in keep],
                           *[F.col(f"__f.{c}").alias(c) for c in filing_fields],
                           F.explode(F.concat(*tagged)).alias("__i"))
    return items.select(*[F.col(q(c)) for c in keep], *[F.col(q(c)) for c in filing_fields],
                        F.col("__i.statement").alias("statement"),
                        F.col("__i.item.concept").alias("concept"),
                        F.col("__i.item.unit").alias("unit"),
                        F.col("__i.item.label").alias("label"),
                        F.col("__i.item.value").try_cast("double").alias("value"))


def unpivot_columns(df: DataFrame, ids: Sequence[str], name_col: str, value_col: str,
                    columns: Sequence[str] | None = None) -> DataFrame:
    """Wide -> long; the column list is found at plan time (E3).  NULL values are
    kept (like ``stack``).  All unpivoted columns must share one type."""
    ids = list(ids)
    cols = list(columns) if columns is not None else [c for c in df.columns if c not in ids]
    types = {df.schema[c].dataType.simpleString() for c in cols}
    if len(types) != 1:
        raise TypeError(f"unpivot needs one value type, got {sorted(types)}")
    return df.unpivot([F.col(q(c)) for c in ids], [F.col(q(c)) for c in cols], name_col, value_col)


def unpivot_series(df: DataFrame, ids: Sequence[str], struct_col: str,
                   name_col: str = "metric_type") -> DataFrame:
    """Struct of ``array<struct<period, v>>`` series -> (ids, metric_type, period, v)
    (E4): unpivot the struct fields, then explode each series.  NULL or empty
    series give no rows."""
    st = df.schema[struct_col].dataType
    if not isinstance(st, T.StructType):
        raise TypeError(f"{struct_col} is not a struct")
    fields = [f.name for f in st.fields]
    wide = df.select(*[F.col(q(c)) for c in ids],
                     *[F.col(f"{q(struct_col)}.{q(f)}").alias(f) for f in fields])
    long = unpivot_columns(wide, ids, name_col, "__series", fields)
    return long.select(*[F.col(q(c)) for c in ids], F.col(name_col),
                       F.inline(F.col("__series")))


def priority_pivot(df: DataFrame, keys: Sequence[str], name_col: str, value_col: str,
                   spec: Mapping[str, Sequence[str]], default=0) -> DataFrame:
    """Long -> wide (E5, AG1, AG2): for each output column, the first non-null
    value among its ordered names, else ``default``.  One hash aggregate with a
    partial stage.  Every group is kept, also one with no listed name (all
    outputs ``default``)."""
    aggs: list[Column] = [priority_first(name_col, value_col, names, default).alias(out)
                          for out, names in spec.items()]
    return df.groupBy(*[F.col(q(k)) for k in keys]).agg(*aggs)
