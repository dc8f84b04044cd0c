"""Physical-plan properties the design relies on."""

import os

import pytest
from pyspark.sql import functions as F

from bourse.operators import cdc, quality, windows
from bourse.operators.joins import enrich_latest

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver data not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
def test_latest_per_key_limits_before_shuffle(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    p = plan(cdc.scd1(o, ["o_custkey"], "o_orderdate", ["o_orderkey"]))
    assert "WindowGroupLimit" in p and "Partial" in p


@needs_data
def test_snapshot_latest_broadcasts_the_period_table(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    p = plan(windows.snapshot_latest(o, "o_orderdate", "month"))
    assert "BroadcastExchange" in p
    assert "Window" not in p  # no whole-period window


@needs_data
def test_valid_branch_filter_reaches_the_scan(spark, tmp):
    c = spark.read.parquet(f"{SF}/lineitem.parquet").select(
        F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("date"),
        F.col("l_extendedprice").alias("open"), F.col("l_extendedprice").alias("close"))
    c.write.parquet(f"{tmp}/c")
    df = spark.read.parquet(f"{tmp}/c")
    valid = quality.split(quality.apply_rules(df, quality.load_rules("stock_candles"))).valid
    p = plan(valid)
    assert "PushedFilters: [IsNotNull(symbol), IsNotNull(date)" in p or "GreaterThan(close,0.0)" in p


@needs_data
def test_enrich_latest_broadcasts_small_reference(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    o = spark.read.parquet(f"{SF}/orders.parquet").withColumnRenamed("o_totalprice", "pc")
    p = plan(enrich_latest(ev, o, "user_id", "o_custkey", ["o_orderdate", "o_orderkey"], ["pc"]))
    assert "BroadcastHashJoin" in p


@needs_data
def test_column_pruning_reaches_the_scan(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    p = plan(windows.latest_per_key(li.select("l_orderkey", "l_linenumber", "l_quantity"),
                                    ["l_orderkey"], ["l_linenumber"]))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in p


@needs_data
def test_scd2_plans_one_exchange(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select(
        F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("seq"),
        F.col("o_orderstatus").alias("v"), F.col("o_totalprice").alias("x"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(cdc.scd2(o, ["k"], "seq", except_cols=["x"]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in p and "HashAggregate" not in p


def test_rank_within_counts_values_first(spark):
    from bourse.operators.ranking import rank_within
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("p"), (F.col("id") * 7 % 101).alias("v"))
    p = plan(rank_within(df, ["p"], "v", "rk"))
    # rows are counted map-side before any window; no Python, no range sampling
    assert "partial_count(1)" in p and "rangepartitioning" not in p
    assert "MapInPandas" not in p and "Python" not in p
