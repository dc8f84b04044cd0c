"""SCD1 / SCD2 / dedup semantics."""

import itertools
import random

from pyspark.sql import functions as F
from hypothesis import given, settings, strategies as st

from bourse.operators import cdc

SCHEMA = "k string, seq int, v string, x int"


def hist(spark, rows, segment=None, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    out = cdc.scd2(df, ["k"], "seq", except_cols=["x"], segment=segment, **kw)
    return sorted(((r.k, r.v, r.x, r["__START_AT"], r["__END_AT"]) for r in out.collect()),
                  key=lambda t: (t[0], t[3]))


def test_scd1_late_row_does_not_overwrite(spark):
    df = spark.createDataFrame([("a", 2, "new", 0), ("a", 1, "old", 0), ("b", 1, "b", 0)], SCHEMA)
    got = sorted((r.k, r.v) for r in cdc.scd1(df, ["k"], "seq").collect())
    assert got == [("a", "new"), ("b", "b")]


def test_scd2_a_b_a_and_unchanged_reload(spark):
    rows = [("a", 1, "A", 0), ("a", 2, "A", 1), ("a", 3, "B", 0), ("a", 4, "A", 0)]
    assert hist(spark, rows) == [("a", "A", 1, 1, 3), ("a", "B", 0, 3, 4), ("a", "A", 0, 4, None)]


def test_scd2_change_only_in_excluded_opens_nothing(spark):
    rows = [("a", 1, "A", 0), ("a", 2, "A", 7)]
    assert hist(spark, rows) == [("a", "A", 7, 1, None)]


def test_scd2_late_row_splits_a_version(spark):
    rows = [("a", 1, "A", 0), ("a", 3, "A", 0), ("a", 2, "B", 0)]
    assert hist(spark, rows) == [("a", "A", 0, 1, 2), ("a", "B", 0, 2, 3), ("a", "A", 0, 3, None)]


def test_scd2_null_key_or_seq_not_placed(spark):
    rows = [("a", 1, "A", 0), (None, 2, "B", 0), ("a", None, "C", 0)]
    assert hist(spark, rows) == [("a", "A", 0, 1, None)]


def test_scd2_same_sequence_keeps_one(spark):
    rows = [("a", 1, "A", 0), ("a", 1, "B", 5)]
    h = hist(spark, rows, tie_break=["x"])
    assert h == [("a", "B", 5, 1, None)]


def _random_feed(seed, n=60):
    rnd = random.Random(seed)
    return [(rnd.choice("ab"), i, rnd.choice(["P", "Q", None]), rnd.randint(0, 3)) for i in range(n)]


def test_scd2_segmented_equals_plain(spark):
    rows = _random_feed(7)
    plain = hist(spark, rows)
    seg = hist(spark, rows, segment=lambda s: F.floor(s / F.lit(7)))
    assert plain == seg


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 10_000))
def test_scd2_independent_of_arrival_order(spark, seed):
    rows = _random_feed(seed, 30)
    shuffled = rows[:]
    random.Random(seed + 1).shuffle(shuffled)
    h = hist(spark, shuffled)
    assert h == hist(spark, rows)
    # intervals per key are contiguous, disjoint, exactly one open
    for k, grp in itertools.groupby(sorted(h, key=lambda r: (r[0], r[3])), key=lambda r: r[0]):
        g = list(grp)
        assert sum(1 for r in g if r[4] is None) == 1
        for a, b in zip(g, g[1:]):
            assert a[4] == b[3]


def test_dedup_first_batch(spark):
    df = spark.createDataFrame([("a", 3, "z", 0), ("a", 1, "y", 0), ("b", 2, "x", 0)], SCHEMA)
    got = sorted((r.k, r.seq) for r in cdc.dedup_first(df, ["k"], ["seq"]).collect())
    assert got == [("a", 1), ("b", 2)]


def test_current_versions(spark):
    rows = [("a", 1, "A", 0), ("a", 2, "B", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    h = cdc.scd2(df, ["k"], "seq")
    assert [r.v for r in cdc.current_versions(h).collect()] == ["B"]


def test_unplaced_rows_are_exposed(spark):
    rows = [("a", 1, "A", 0), (None, 2, "B", 0), ("a", None, "C", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r.v for r in cdc.unplaced(df, ["k"], "seq").collect()) == ["B", "C"]
