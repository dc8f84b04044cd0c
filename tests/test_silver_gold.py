"""Published tables on hand-written rows in the pipelines' input shapes (FIXTURES §2)."""

import datetime as dt

from pyspark.sql import functions as F

from bourse.plans import gold as G
from bourse.plans import silver as S

T0 = dt.datetime(2024, 1, 1)


def test_quote_typing_dst_and_quarantine(spark):
    rows = [("A", "10", "2024-03-10T06:59:59Z"), ("A", "10", "2024-03-10T07:00:00Z"),
            ("A", "0", "2024-11-03T05:30:00Z"), (None, "5", "2024-11-03T06:30:00Z"),
            ("B", None, "2024-01-01T00:00:00Z"), ("C", "abc", "2024-01-01T00:00:00Z")]
    epoch = [(s, c, str(int(dt.datetime.fromisoformat(t.replace("Z", "+00:00")).timestamp())))
             for s, c, t in rows]
    df = spark.createDataFrame([(s, c, None, None, None, None, None, None, t, T0) for s, c, t in epoch],
                               "symbol string, c string, d string, dp string, h string, l string, "
                               "o string, pc string, t string, ingest_timestamp timestamp")
    sp = S.quote_tables(df)
    valid = sorted((r.symbol, r.event_timestamp) for r in sp.valid.collect())
    # 06:59:59Z is 01:59:59 EST; 07:00:00Z is 03:00:00 EDT (the clock skips 02:00)
    assert valid == [("A", dt.datetime(2024, 3, 10, 1, 59, 59)), ("A", dt.datetime(2024, 3, 10, 3, 0))]
    q = {(r.symbol, r.quarantine_reason) for r in sp.quarantine.collect()}
    assert ("A", "close_price_positive has failed") in q
    assert (None, "symbol_not_null has failed") in q
    assert ("B", "close_price_positive has failed") in q       # NULL close quarantined (fail policy)
    assert ("C", "close_price_positive has failed") in q       # unparsable close
    assert sp.undecided.count() == 0


def test_candles_first_previous_close_zero_and_gap_flags(spark):
    rows = [("A", dt.date(2024, 1, d), o, c) for d, o, c in
            [(1, 100.0, 100.0), (2, 101.0, 100.0), (3, 101.0, 99.0), (4, 98.0, 99.0)]]
    c = spark.createDataFrame([(s, d, o, o, o, cl, 1, T0) for s, d, o, cl in rows],
                              "symbol string, date date, open double, high double, low double, "
                              "close double, volume bigint, ingest_timestamp timestamp")
    gc = G.stock_candles(c)
    q = spark.createDataFrame([], "symbol string, close_price double, high_price double, "
                                  "low_price double, open_price double, previous_close_price double, "
                                  "event_timestamp timestamp, percent_change double, "
                                  "ingest_timestamp timestamp")
    out = {r.session_date.day: r for r in G.fact_daily_quote(q, gc).collect()}
    assert out[1].previous_close_price == 0 and out[1].percent_change is None
    assert out[1].gap_flag == "gap_up"            # positive open over a 0 previous close
    assert out[2].gap_flag == "no_gap"            # exactly +1 %: not above
    assert out[4].gap_flag == "gap_down" and out[4].candle_direction == "bullish"


def test_dim_company_size_class_edges(spark):
    caps = [199999.99, 200000.0, 10000.0, 2000.0, 300.0, 299.99, None]
    rows = [(f"S{i}", f"N{i}", "X", "Tech", m, 1.0, False, None) for i, m in enumerate(caps)]
    df = spark.createDataFrame(rows, "symbol string, name string, exchange string, "
                                     "finnhubIndustry string, marketCapitalization double, "
                                     "shareOutstanding double, is_critical boolean, __END_AT timestamp")
    got = [r.market_cap_category for r in G.dim_company(df).orderBy("symbol").collect()]
    assert got == ["Large cap", "Mega cap", "Large cap", "Mid cap", "Small cap", "Micro cap", "Micro cap"]


def test_profile_history_reload_and_change(spark):
    base = dict(country="US", currency="USD", exchange="X", finnhubIndustry="Tech", ipo="2000-01-01",
                marketCapitalization="100", phone=None, shareOutstanding="5", ticker="A",
                weburl=None, name="A Inc", estimateCurrency="USD")
    rows = [dict(base, symbol_name="A", ingest_timestamp=T0 + dt.timedelta(days=i),
                 marketCapitalization=m) for i, m in enumerate(["100", "100", "200", "100"])]
    cols = list(rows[0])
    schema = ", ".join(f"{c} timestamp" if c == "ingest_timestamp" else f"{c} string" for c in cols)
    df = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schema)
    h = S.silver_profile(S.flagged_profile(df)).orderBy("__START_AT").collect()
    assert [(r.marketCapitalization, r["__START_AT"].day, r["__END_AT"] and r["__END_AT"].day)
            for r in h] == [(100.0, 1, 3), (200.0, 3, 4), (100.0, 4, None)]
    assert h[0].ingest_timestamp.day == 2     # the unchanged reload updates the open version only


def test_analyst_signal_edges_and_empty_data(spark):
    schema = ("symbol string, data array<struct<period:string, buy:string, hold:string, sell:string, "
              "strongBuy:string, strongSell:string, symbol:string>>, ingest_timestamp timestamp")
    rows = [("A", [("2024-01", "0", "0", "0", "3", "1", "A")], T0),      # 3 + (6 - 2)/4 = 4.0
            ("B", [("2024-01", "1", "0", "0", "1", "0", "B")], T0),      # 3 + 3/2 = 4.5
            ("C", [("2024-01", "0", "0", "0", "0", "0", "C")], T0),      # no analysts
            ("D", [], T0), ("E", None, T0),
            ("F", [("2024-01", "-1", "0", "0", "0", "0", "F")], T0)]     # negative count: critical
    df = spark.createDataFrame(rows, schema)
    hist = S.silver_recommendation(S.flagged_recommendation(df))
    out = {r.symbol: r for r in G.fact_analyst_signal(hist).collect()}
    assert set(out) == {"A", "B", "C"}
    assert out["A"].bullish_score == 4.0 and out["A"].consensus_label == "Buy"
    assert out["B"].bullish_score == 4.5 and out["B"].consensus_label == "Strong buy"
    assert out["C"].bullish_score is None and out["C"].consensus_label == "Strong sell"


def test_fact_stock_metrics_risk_edges(spark):
    betas = [None, -5.0, 0.49, 0.5, 1.0, 1.5, 15.0]
    rows = [(f"S{i}", b, dt.date(2024, 1, 1), False) for i, b in enumerate(betas)]
    df = spark.createDataFrame(rows, "symbol string, beta double, metric_date date, is_critical boolean")
    for c in ["peTTM", "pb", "roeTTM", "roaTTM", "netProfitMarginTTM", "grossMarginTTM", "psTTM",
              "evEbitdaTTM", "52WeekHigh", "52WeekLow", "52WeekPriceReturnDaily",
              "13WeekPriceReturnDaily", "26WeekPriceReturnDaily", "currentDividendYieldTTM",
              "operatingMarginTTM", "marketCapitalization"]:
        df = df.withColumn(c, F.lit(None).cast("double"))
    got = [r.risk_category for r in G.fact_stock_metrics(df).orderBy("symbol").collect()]
    assert got == ["Low Volatility", "Low Volatility", "Low Volatility", "Above Market",
                   "Above Market", "High volatility", "High volatility"]


def test_financials_restated_value_wins_and_priority(spark):
    item = "struct<concept:string,label:string,unit:string,value:string>"
    schema = (f"cik string, symbol string, data array<struct<accessNumber:string, year:bigint, "
              f"quarter:bigint, startDate:string, endDate:string, filedDate:string, "
              f"report:struct<bs:array<{item}>, cf:array<{item}>, ic:array<{item}>>>>, "
              f"ingest_timestamp timestamp")

    def filing(v_rev, t):
        rep = ([("us-gaap_Revenues", "r", "USD", "1")], [("us-gaap_Revenues", "r", "USD", "9")],
               [("us-gaap_Revenues", "r", "USD", v_rev)])
        return ("C1", "S", [("A1", 2024, 2, "s", "e", "f", rep)], t)
    df = spark.createDataFrame([filing("5", T0), filing("7", T0 + dt.timedelta(days=1))], schema)
    silver = S.silver_financials(S.financial_tables(df).valid)
    rows = silver.collect()
    assert len(rows) == 1 and rows[0].statement == "bs" and rows[0].value == 1.0
    ratio = G.financial_ratio(silver).collect()[0]
    assert ratio.revenue == 1.0 and ratio.net_income == 0 and ratio.period_label == "Q2-2024"


def test_pivot_holds_one_value_an_output_and_filings_are_dealt_out_first(spark):
    rows = [("1", "AAA", "cik", 2024, 1, c, v) for c, v in (("us-gaap_Revenues", None), ("SalesRevenueGoodsNet", 7.0), ("ProfitLoss", 2.0), ("other", 1.0))]
    rows += [("2", "AAA", "cik", 2024, 1, "other", 5.0), ("3", None, None, None, None, "us-gaap_Revenues", 3.0)]
    df = spark.createDataFrame(rows, "accessNumber string, symbol string, cik string, year long, quarter long, concept string, value double") \
        .withColumns({c: F.lit("2024-01-01") for c in ("startDate", "endDate", "filedDate")})
    out = G.financial_ratio(df)
    got = {r["accessNumber"]: (r["revenue"], r["net_income"], r["assets"]) for r in out.collect()}
    assert got == {"1": (7.0, 2.0, 0.0), "2": (0.0, 0.0, 0.0), "3": (3.0, 0.0, 0.0)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    aggregate = next(x for x in plan.split("\n") if "Aggregate" in x)
    assert aggregate.count("min_by(") == len(G.FINANCIAL_CONCEPTS) and "first(" not in aggregate and "RepartitionByExpression" in plan
