"""Reshape (E), windows (H), ranking, bars (K2/K3, AG), scalar helpers (J)."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F
from hypothesis import given, settings, strategies as st

from bourse.functions import scalars as J
from bourse.operators import bars, reshape, windows
from bourse.operators.ranking import rank_within

ITEM = "struct<concept:string,label:string,unit:string,value:string>"
FIN_SCHEMA = (f"cik string, symbol string, data array<struct<accessNumber:string, year:bigint, "
              f"quarter:bigint, startDate:string, endDate:string, filedDate:string, "
              f"report:struct<bs:array<{ITEM}>, cf:array<{ITEM}>, ic:array<{ITEM}>>>>")


def _it(c, v):
    return (c, c, "USD", v)


def test_flatten_statements_null_arrays_and_bad_values(spark):
    data = [("1", "S", [("A1", 2024, 0, "s", "e", "f",
                         ([_it("Assets", "10")], None, [_it("Revenue", "n/a")]))]),
            ("2", "T", []), ("3", "U", None)]
    df = spark.createDataFrame(data, FIN_SCHEMA)
    out = reshape.flatten_statements(df, ["symbol"])
    got = sorted((r.symbol, r.statement, r.concept, r.value) for r in out.collect())
    assert got == [("S", "bs", "Assets", 10.0), ("S", "ic", "Revenue", None)]


def test_flatten_statements_single_scan(spark):
    df = spark.createDataFrame([], FIN_SCHEMA)
    plan = reshape.flatten_statements(df, ["symbol"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


SERIES = ("symbol string, ingest_timestamp timestamp, s struct<eps:array<struct<period:string,v:double>>,"
          "`pe/x`:array<struct<period:string,v:double>>>")


def test_unpivot_series_and_odd_names(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("A", t, ([("2023", 1.0), ("2022", float("inf"))], None)),
                                ("B", t, ([], [("2023", float("nan"))]))], SERIES)
    out = reshape.unpivot_series(df, ["symbol", "ingest_timestamp"], "s")
    got = sorted((r.symbol, r.metric_type, r.period) for r in out.collect())
    assert got == [("A", "eps", "2022"), ("A", "eps", "2023"), ("B", "pe/x", "2023")]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.floats(-1e6, 1e6))),
                min_size=1, max_size=20, unique_by=lambda t: t[0]))
def test_unpivot_then_pivot_is_identity(spark, rows):
    df = spark.createDataFrame([(k, v, None if v is None else v * 2) for k, v in rows],
                               "k int, a double, b double")
    long = reshape.unpivot_columns(df, ["k"], "name", "value")
    wide = reshape.priority_pivot(long, ["k"], "name", "value", {"a": ["a"], "b": ["b"]}, default=None)
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, df.collect()))


def test_priority_pivot_fallback_and_default(spark):
    df = spark.createDataFrame([("f1", "second", 2.0), ("f1", "first", None), ("f2", "other", 1.0)],
                               "f string, concept string, value double")
    out = reshape.priority_pivot(df, ["f"], "concept", "value", {"x": ["first", "second"]})
    assert sorted(map(tuple, out.collect())) == [("f1", 2.0), ("f2", 0.0)]


def test_lag_default_first_row_zero_and_segmented(spark):
    rows = [("a", dt.date(2024, 1, d), float(d)) for d in range(1, 29)]
    rows += [("b", dt.date(2024, 1, 1), None), ("b", dt.date(2024, 1, 2), 3.0)]
    df = spark.createDataFrame(rows, "symbol string, date date, close double")
    plain = windows.lag_default(df, "close", ["symbol"], ["date"], 0, out="pc")
    seg = windows.lag_default(df, "close", ["symbol"], ["date"], 0, out="pc",
                              segment=lambda c: F.weekofyear(c))
    a = sorted(map(tuple, plain.collect()), key=repr)
    assert a == sorted(map(tuple, seg.collect()), key=repr)
    got = {(r.symbol, r.date.day): r.pc for r in plain.collect()}
    assert got[("a", 1)] == 0 and got[("a", 2)] == 1.0 and got[("b", 2)] == 0


def test_snapshot_latest_over_all_symbols(spark):
    t = dt.datetime
    df = spark.createDataFrame([("A", t(2024, 1, 1, 9)), ("B", t(2024, 1, 1, 16)),
                                ("A", t(2024, 1, 1, 16)), ("A", t(2024, 1, 2, 9))],
                               "symbol string, ingest_timestamp timestamp")
    got = sorted((r.symbol, r.ingest_timestamp.hour) for r in
                 windows.snapshot_latest(df, "ingest_timestamp").collect())
    assert got == [("A", 9), ("A", 16), ("B", 16)]
    per = sorted((r.symbol, r.ingest_timestamp.day, r.ingest_timestamp.hour) for r in
                 windows.snapshot_latest(df, "ingest_timestamp", per=("symbol",)).collect())
    assert per == [("A", 1, 16), ("A", 2, 9), ("B", 1, 16)]


def test_growth_requires_exact_prior_period(spark):
    df = spark.createDataFrame([("S", 2020, 100.0), ("S", 2021, 110.0), ("S", 2023, 50.0),
                                ("S", 2024, 0.0), ("S", 2025, 5.0)], "symbol string, year int, r double")
    got = {r.year: r.g for r in windows.growth(df, ["symbol"], "year", "r", "g").collect()}
    assert got == {2020: None, 2021: 10.0, 2023: None, 2024: -100.0, 2025: None}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y", None]),
                          st.one_of(st.none(), st.integers(0, 6))), min_size=1, max_size=40))
def test_rank_within_matches_sql_rank(spark, rows):
    df = spark.createDataFrame([(i, p, None if v is None else float(v)) for i, (p, v) in enumerate(rows)],
                               "id int, p string, v double")
    got = {r.id: (r.rk, r.pr) for r in rank_within(df, ["p"], "v", "rk", pct_out="pr").collect()}
    pdf = pd.DataFrame(rows, columns=["p", "v"]).fillna({"p": "<null>"})
    pdf["v"] = pdf["v"].fillna(float("-inf"))  # NULLs last in a descending order
    pdf["rk"] = pdf.groupby("p")["v"].rank(method="min", ascending=False).astype(int)
    n = pdf.groupby("p")["v"].transform("size")
    for i, r in pdf.iterrows():
        assert got[i][0] == r.rk
        exp = 0.0 if n[i] <= 1 else (r.rk - 1) / (n[i] - 1)
        assert abs(got[i][1] - exp) < 1e-12


TRADES = "symbol string, price double, volume bigint, conditions array<string>, timestamp timestamp, previous_close_price double"


def test_bars_conditions_and_boundaries(spark):
    t = dt.datetime
    rows = [("A", 10.0, 1, ["1"], t(2024, 1, 1, 9, 30, 0), None),
            ("A", 99.0, 2, ["4"], t(2024, 1, 1, 9, 30, 10), 10.0),    # excluded code: no high
            ("A", 11.0, 3, None, t(2024, 1, 1, 9, 30, 20), 10.0),     # NULL conditions: no high/low
            ("A", 10.5, 4, [], t(2024, 1, 1, 9, 30, 59), 10.0),
            ("A", 12.0, 5, ["1"], t(2024, 1, 1, 9, 31, 0), 10.0)]     # next window
    df = spark.createDataFrame(rows, TRADES)
    out = {r.window_start.minute: r for r in bars.bars(df).collect()}
    a = out[30]
    assert (a.open_price, a.close_price, a.high_price, a.low_price) == (10.0, 10.5, 10.5, 10.0)
    assert a.volume == 10 and a.snapshot_count == 4 and a.previous_close_price == 10.0
    assert a.price_drift_pct == 5.0 and a.price_anomaly_flag is True
    assert a.window_end == t(2024, 1, 1, 9, 31) and a.session_date == dt.date(2024, 1, 1)
    assert out[31].open_price == 12.0


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("1704067200", 0.0, 4.0, "abc")], "t string, z double, q double, bad string")
    r = df.select(J.epoch_to_local("t").alias("ny"), J.safe_div(F.lit(1.0), "z").alias("d0"),
                  J.pct_change(F.lit(110.0), F.lit(100.0)).alias("pc"),
                  J.to_number("bad").alias("n"), J.to_date_safe(F.col("bad")).alias("dd"),
                  J.period_label(F.lit(2024), F.lit(0)).alias("fy"),
                  J.period_label(F.lit(2024), F.col("q").cast("int")).alias("qq")).collect()[0]
    assert r.ny == dt.datetime(2023, 12, 31, 19, 0)
    assert r.d0 is None and abs(r.pc - 10.0) < 1e-9 and r.n is None and r.dd is None
    assert (r.fy, r.qq) == ("FY2024", "Q4-2024")


def test_bucketize_first_match_and_null_else(spark):
    df = spark.createDataFrame([(200000.0,), (199999.99,), (300.0,), (None,)], "m double")
    cls = J.bucketize([(F.col("m") >= 200000, "Mega"), (F.col("m") >= 300, "Small")], "Micro")
    assert [r.c for r in df.select(cls.alias("c")).collect()] == ["Mega", "Small", "Small", "Micro"]
