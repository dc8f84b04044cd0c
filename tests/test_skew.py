"""A hot key holding a third of the rows: same results, spread over tasks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from bourse.operators import cdc, segmented as S, windows
from bourse.operators.ranking import rank_within


def _feed(spark, n=3000):
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        k = "HOT" if i % 3 == 0 else f"k{rnd.randint(0, 199)}"
        rows.append((k, i, rnd.choice(["P", "Q", "R"]), rnd.randint(0, 9)))
    return spark.createDataFrame(rows, "k string, seq int, v string, x int")


def test_segmented_scd2_spreads_the_hot_key(spark):
    df = _feed(spark)
    seg = lambda s: F.floor(s / F.lit(250))
    a = cdc.scd2(df, ["k"], "seq", except_cols=["x"])
    b = cdc.scd2(df, ["k"], "seq", except_cols=["x"], segment=seg)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    # the hot key's 12 segments hash into several of the 16 partitions, not one task
    parts = (S.with_segment(df, seg(F.col("seq"))).repartition(16, "k", S.SEG)
             .filter(F.col("k") == "HOT").select(F.spark_partition_id().alias("p"))
             .distinct().count())
    assert parts >= 4


def test_segmented_lag_equals_plain_with_hot_key(spark):
    df = _feed(spark)
    a = windows.lag_default(df, "v", ["k"], ["seq"], "none", out="prev")
    b = windows.lag_default(df, "v", ["k"], ["seq"], "none", out="prev",
                            segment=lambda s: F.floor(s / F.lit(100)))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def _same_as_window(df, part, value, desc):
    from pyspark.sql import Window
    o = F.col(value).desc_nulls_last() if desc else F.col(value).asc_nulls_last()
    w = Window.partitionBy(*part).orderBy(o)
    want = df.withColumns({"rk": F.rank().over(w).cast("long"), "pr": F.percent_rank().over(w)})
    got = rank_within(df, part, value, "rk", desc=desc, pct_out="pr")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_rank_equals_window_with_hot_partition_and_value(spark):
    df = _feed(spark).withColumn("score", (F.col("seq") * 7919 % 1000).cast("double"))
    df = df.withColumn("score", F.when(F.col("seq") % 10 > 0, 0.0).when(F.col("seq") % 70 == 0, None)
                       .when(F.col("seq") % 110 == 0, float("nan")).when(F.col("seq") % 130 == 0, float("-inf"))
                       .otherwise(F.col("score") - 300))
    for part in (["k"], []):
        for desc in (True, False):
            _same_as_window(df, part, "score", desc)


def test_rank_keeps_bigints_and_other_types_exact(spark):
    rows = [(None, 9007199254740993, "b", None), ("a", 9007199254740992, "a", 1.5), ("a", None, None, float("nan")),
            ("a", 9007199254740993, "b", -1.5), (None, -5, "ab", float("nan")), ("a", 9007199254740993, "c", 0.0)]
    df = spark.createDataFrame(rows, "k string, n bigint, s string, x double") \
        .withColumns({"d": F.date_add(F.lit("1969-12-30").cast("date"), (F.col("n") % 5).cast("int")),
                      "t": F.timestamp_seconds(F.col("n") % 100000), "m": F.col("n").cast("decimal(38,2)")})
    for value in ("n", "s", "x", "d", "t", "m"):
        _same_as_window(df, ["k"], value, True)
        _same_as_window(df, [], value, False)


def test_rank_excludes_nulls_and_plans_lazily(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 7), (4, 5)], "id int, v int")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    r = rank_within(df, [], "v", "rk", desc=False, pct_out="pr", nulls="exclude")
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup()) == list(before)
    assert sorted(map(tuple, r.collect())) == [(1, None, None, None), (2, 5, 1, 0.0), (3, 7, 3, 1.0), (4, 5, 1, 0.0)]


@pytest.mark.parametrize("what, value", [
    ("narrow doubles", lambda i: 100.0 + i / 20_000.0),
    ("timestamps of a year", lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i * 1500)),
    ("strings with one beginning", lambda i: f"Customer#{i * 37:09d}"),
    ("doubles with one outlier", lambda i: 1e300 if i == 0 else 5.0 + i / 1e6),
    ("short and long strings", lambda i: "x" * (i % 5) + str(i))])
def test_ranks_spread_over_tasks_whatever_the_values(spark, what, value):
    from bourse.operators.ranking import FULL, value_buckets
    n = 20_000
    rng = random.Random(3)
    order = list(range(n))
    rng.shuffle(order)
    df = spark.createDataFrame([(i % 2, value(i)) for i in order] + [(0, None), (1, value(5))], ["p", "v"])
    sizes = [r["count"] for r in value_buckets(df, [], "v").groupBy("__rk_b").count().collect()]
    assert len(sizes) >= 32 and max(sizes) <= FULL
    _same_as_window(df, ["p"], "v", desc=False)
