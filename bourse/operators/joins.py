"""Enrichment joins (F1, F2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.operators.sizing import broadcast_if_bounded
from bourse.operators.windows import latest_per_key


def latest_reference(ref: DataFrame, ref_key: str, order: Sequence[str],
                     cols: Sequence[str], key_alias: str = "ref_key") -> DataFrame:
    """One row per reference key: the latest by ``order`` (with tie-break)."""
    latest = latest_per_key(ref, [ref_key], list(order))
    return latest.select(F.col(ref_key).alias(key_alias), *[F.col(c) for c in cols])


def enrich_latest(facts: DataFrame, ref: DataFrame, fact_key: str, ref_key: str,
                  order: Sequence[str], cols: Sequence[str],
                  broadcast_limit: int | None = None) -> DataFrame:
    """Left join every fact row to the latest reference row of its key (F1).

    Works for a batch or a streaming ``facts`` side.  In a stream-static join a
    reference read from files keeps the file list it had when the stream
    started; where reference rows arrive meanwhile, join in
    ``streaming.runners.run_each``, which reads the reference for each batch.
    The latest-reference side has one row per key; it is broadcast only when the
    optimizer's size estimate is under the limit, else AQE picks the strategy
    at run time (streaming plans keep the shuffle join).

    When the reference table is large, materialise ``latest_reference`` (one row per
    key) as its own refreshed table and pass that as ``ref`` with
    ``order`` on the same columns: each micro-batch then reads one row per
    key instead of rescanning the whole reference history.
    """
    latest = latest_reference(ref, ref_key, order, cols, "__ref_key")
    latest = broadcast_if_bounded(latest, broadcast_limit)
    j = facts.alias("oc").join(latest.alias("lh"), F.col(f"oc.{fact_key}") == F.col("lh.__ref_key"), "left")
    return j.select(F.col("oc.*"), *[F.col(f"lh.{c}") for c in cols])


def left_join_all(base: DataFrame, others: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Chain of left equi-joins onto a dimension (F2)."""
    out = base
    for df, on in others:
        out = out.join(df, on=list(on), how="left")
    return out
