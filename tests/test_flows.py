"""End-to-end flows over landing files in a temp folder."""

import json
import os

from pyspark.sql import functions as F

from bourse.plans import flows


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_candle_and_quote_flows_to_daily_fact(spark, tmp):
    lay = flows.Layout(f"{tmp}/lake")
    _write(f"{tmp}/land/candles", "c1.csv",
           "Date,Open,High,Low,Close,Volume,Symbol\n"
           "2024-01-02,10,11,9,10.5,100,AAA\n2024-01-03,10.6,12,10,11,200,AAA\n"
           "2024-01-03,0,1,0,1,5,BBB\nbad,1,1,1,1,1,CCC\n")
    out = flows.candle_flow(spark, f"{tmp}/land/candles", lay)
    g = {r.date.day: r.previous_close_price for r in out["gold_stock_candles"].collect()}
    assert g == {2: 0.0, 3: 10.5}
    q = {r.symbol: r.quarantine_reason for r in out["quarantine_candles"].collect()}
    assert q == {"BBB": "open_positive has failed", "CCC": "date_not_null has failed"}

    _write(f"{tmp}/land/quotes", "q1.json", "\n".join(json.dumps(r) for r in [
        {"symbol": "AAA", "c": "12", "d": "1", "dp": "9", "h": "13", "l": "11", "o": "11.5",
         "pc": "11", "t": "1704380400", "extra": "x"},
        {"symbol": "AAA", "c": "-1", "t": "1704380400"}]))
    qo = flows.quote_flow(spark, f"{tmp}/land/quotes", lay)
    assert qo["silver_quote"].count() == 1 and qo["quarantine_quote"].count() == 1
    counts = {r.rule: (r.passed, r.failed, r.unknown) for r in flows.expectations(spark, lay, "quote_branches").collect()}
    assert counts["close_price_positive"] == (1, 1, 0) and counts["open_price_positive"] == (1, 0, 1)   # a warn rule
    daily = flows.daily_quote_flow(spark, lay, qo["silver_quote"], out["gold_stock_candles"])
    assert {r.session_date.day for r in daily.collect()} == {2, 3, 4}

    # re-running reads no file twice and keeps the tables the same
    again = flows.candle_flow(spark, f"{tmp}/land/candles", lay)
    assert again["silver_candles"].count() == 2


def test_profile_flow_history_and_dim(spark, tmp):
    lay = flows.Layout(f"{tmp}/lake")
    rows = [{"symbol": "AAA", "ticker": "AAA", "name": "A", "marketCapitalization": "250000",
             "shareOutstanding": "10", "country": "US", "exchange": "X", "ipo": "2000-01-01"},
            {"symbol": "BBB", "ticker": "BBB", "name": "B", "marketCapitalization": "-1",
             "shareOutstanding": "10", "country": "US", "exchange": "X", "ipo": "2000-01-01"}]
    _write(f"{tmp}/land/profile", "p1.json", "\n".join(json.dumps(r) for r in rows))
    out = flows.profile_flow(spark, f"{tmp}/land/profile", lay)
    dim = {r.symbol: r.market_cap_category for r in out["gold_dim_company"].collect()}
    assert dim == {"AAA": "Mega cap"}          # BBB is critical (negative market cap)
    assert out["silver_profile"].count() == 2
    # the bronze table holds what landed; the histories are published, rows that none can place too
    assert spark.read.parquet(lay.table("bronze", "profile")).count() == 2
    assert spark.read.parquet(lay.table("silver", "profile_unplaced")).count() == 0
    counts = {r.rule: r.passed for r in flows.expectations(spark, lay, "profile_branches").collect()}
    assert counts["ipo_date_sane"] == 2 and counts["market_cap_positive"] == 1


def test_recommendation_and_financials_flows(spark, tmp):
    lay = flows.Layout(f"{tmp}/lake")
    recs = [{"symbol": "AAA", "data": [{"period": "2024-01-01", "buy": 2, "hold": 1, "sell": 0,
                                        "strongBuy": 1, "strongSell": 0, "symbol": "AAA"}]},
            {"symbol": "BBB", "data": []}]
    _write(f"{tmp}/land/rec", "r1.json", "\n".join(json.dumps(r) for r in recs))
    out = flows.recommendation_flow(spark, f"{tmp}/land/rec", lay)
    sig = out["gold_fact_analyst_signal"].collect()
    assert [(r.symbol, r.bullish_score, r.consensus_label) for r in sig] == [("AAA", 4.0, "Buy")]

    def filing(year, q, rev):
        return {"accessNumber": f"A{year}{q}", "cik": "1", "endDate": "e", "filedDate": "f",
                "form": "10-K", "quarter": q, "startDate": "s", "symbol": "AAA", "year": year,
                "report": {"ic": [{"concept": "us-gaap_Revenues", "label": "r", "unit": "USD",
                                   "value": str(rev)}], "bs": None, "cf": []}}
    fin = [{"cik": "1", "symbol": "AAA", "data": [filing(2022, 0, 100), filing(2023, 0, 150)]}]
    _write(f"{tmp}/land/fin", "f1.json", "\n".join(json.dumps(r) for r in fin))
    fo = flows.financials_flow(spark, f"{tmp}/land/fin", lay)
    yoy = {r.year: r.yoy_growth for r in fo["gold_financial_annual_yoy"].collect()}
    assert yoy == {2022: None, 2023: 50.0}


def test_trades_flow_bars(spark, tmp):
    import datetime as dt
    from pyspark.sql import types as T
    from bourse.sources.kafka import KAFKA_ROW
    lay = flows.Layout(f"{tmp}/lake")
    quote = spark.createDataFrame([("AAA", 10.0, dt.datetime(2024, 1, 1))],
                                  "symbol string, previous_close_price double, event_timestamp timestamp")
    base = 1704103200000  # 2024-01-01T10:00:00Z in ms
    vals = [(base + i * 20000, p) for i, p in enumerate([10.0, 10.2, 10.4, 11.0, 11.5, 12.0])]
    rows = [{"key": None, "value": json.dumps({"symbol": "AAA", "price": p, "volume": 1,
                                               "conditions": ["1"], "timestamp": t}),
             "topic": "t", "partition": 0, "offset": i, "timestamp": "2024-01-01T10:00:00",
             "timestampType": 0} for i, (t, p) in enumerate(vals)]
    _write(f"{tmp}/land/kafka", "k.json", "\n".join(json.dumps(r) for r in rows))
    kschema = T.StructType([T.StructField(f.name, T.StringType() if f.name in ("key", "value")
                                          else f.dataType) for f in KAFKA_ROW.fields])
    k = spark.readStream.schema(kschema).json(f"{tmp}/land/kafka") \
        .withColumn("key", F.col("key").cast("binary")).withColumn("value", F.col("value").cast("binary"))
    out = flows.trades_flow(spark, k, lay, quote)
    bars = {r.window_start.minute: (r.open_price, r.close_price, r.snapshot_count)
            for r in out["gold_fact_realtime_agg"].collect()}
    assert bars[0] == (10.0, 10.4, 3)   # 10:00 window closed by the 10:01:40 trade minus 30 s
    assert out["silver_quote_eh"].filter("previous_close_price = 10.0").count() == 6


def test_metric_flow_snapshot_and_series(spark, tmp):
    lay = flows.Layout(f"{tmp}/lake")

    def rec(ts, beta, eps):
        return {"symbol": "AAA", "metricType": "all", "timestamp": ts,
                "metric": {"beta": beta, "marketCapitalization": 10.0, "enterpriseValue": 5.0,
                           "52WeekHigh": 2.0, "52WeekLow": 1.0, "longTermDebt/equityAnnual": 0.5,
                           "peTTM": 20.0, "roeTTM": 0.1},
                "series": {"annual": {"eps": [{"period": "2023-12-31", "v": eps}],
                                      "pe": [{"period": "2023-12-31", "v": 15.0}]},
                           "quarterly": {"eps": [{"period": "2023-12-31", "v": eps / 4}]}}}
    lines = [rec("2024-01-02T15:00:00Z", 1.6, 4.0), rec("2024-01-02T18:00:00Z", 0.2, 5.0),
             rec("2024-01-03T15:00:00Z", 0.7, 6.0)]
    _write(f"{tmp}/land/metric", "m1.json", "\n".join(json.dumps(r) for r in lines))
    out = flows.metric_flow(spark, f"{tmp}/land/metric", lay)
    facts = {r.metric_date.day: r.risk_category for r in out["gold_fact_stock_metrics"].collect()}
    assert facts == {2: "High volatility", 3: "Above Market"}   # first load of each day kept
    ann = {(r.metric_type, r.period): r.v for r in out["silver_metric_annual"].collect()}
    assert ann[("pe", "2023-12-31")] == 15.0 and ("eps", "2023-12-31") in ann
    assert out["silver_metric_quarterly"].count() == 1


def _twice(spark, tmp, name, flow, first, second):
    """Runs a flow over a first file, then over a second one with a mistyped value, a new field and a broken line."""
    lay = flows.Layout(f"{tmp}/lake")
    _write(f"{tmp}/land/{name}", "a.json", json.dumps(first))
    flow(spark, f"{tmp}/land/{name}", lay)
    kept = spark.read.parquet(lay.table("bronze", name)).schema
    _write(f"{tmp}/land/{name}", "b.json", json.dumps(second) + "\n{broken")
    out = flow(spark, f"{tmp}/land/{name}", lay)
    bronze = spark.read.parquet(lay.table("bronze", name))
    assert bronze.schema == kept and bronze.count() == 3
    rescued = [json.loads(r[0]) for r in bronze.where("_rescued_data is not null").select("_rescued_data").collect()]
    assert {"_corrupt_record": "{broken"} in rescued
    return out, rescued


def test_profile_flow_with_a_file_of_another_shape(spark, tmp):
    row = {"symbol": "AAA", "ticker": "AAA", "name": "A", "marketCapitalization": 5, "shareOutstanding": 1.5, "country": "US",
           "exchange": "X", "ipo": "2000-01-01"}
    out, rescued = _twice(spark, tmp, "profile", flows.profile_flow, row, row | {"symbol": "BBB", "marketCapitalization": "n/a", "new": [1]})
    assert {"new": "[1]"} in rescued
    assert {(r.symbol, r.marketCapitalization, r.is_critical) for r in out["silver_profile"].collect() if r.symbol} == {("AAA", 5.0, False), ("BBB", None, True)}


def test_recommendation_flow_with_a_file_of_another_shape(spark, tmp):
    item = {"period": "2024-01-01", "buy": 2, "hold": 1, "sell": 0, "strongBuy": 1, "strongSell": 0}
    out, rescued = _twice(spark, tmp, "recommendation", flows.recommendation_flow, {"symbol": "AAA", "data": [item]},
                          {"symbol": "BBB", "data": [item | {"buy": "many", "new": 1}], "extra": True})
    assert any("extra" in r and "new" in r.get("data", "") for r in rescued)
    assert {(r.symbol, r.buy, r.is_critical) for r in out["silver_recommendation"].collect()} == {("AAA", 2, False), ("BBB", None, True)}


def test_metric_flow_with_a_file_of_another_shape(spark, tmp):
    row = {"symbol": "AAA", "timestamp": "2024-01-02T15:00:00Z", "metric": {"beta": 1, "marketCapitalization": 10.0},
           "series": {"annual": {"eps": [{"period": "2023-12-31", "v": 4}]}, "quarterly": {"eps": [{"period": "2023-12-31", "v": 1.5}]}}}
    out, rescued = _twice(spark, tmp, "metric", flows.metric_flow, row,
                          row | {"symbol": "BBB", "metric": {"beta": "high", "marketCapitalization": 2.5}, "new": 1})
    assert any("new" in r and "high" in r.get("metric", "") for r in rescued)
    assert {(r.symbol, r.beta) for r in out["silver_metric_snapshot"].collect() if r.symbol} == {("AAA", 1.0), ("BBB", None)}
    lay = flows.Layout(f"{tmp}/lake")
    counts = flows.expectations(spark, lay, "metric_snapshot_branches").collect()
    assert counts and all(r.passed + r.failed + r.unknown == 3 for r in counts)


def test_flows_before_anything_has_landed(spark, tmp):
    lay = flows.Layout(f"{tmp}/lake")
    for name, flow in (("quote", flows.quote_flow), ("profile", flows.profile_flow), ("recommendation", flows.recommendation_flow),
                       ("financials", flows.financials_flow), ("metric", flows.metric_flow)):
        out = flow(spark, f"{tmp}/land/{name}", lay)
        assert all(df.count() == 0 for df in out.values()), name
    _write(f"{tmp}/land/quote", "q.json", json.dumps({"symbol": "AAA", "c": "12", "d": "1", "dp": "9", "h": "13", "l": "11", "o": "11.5",
                                                      "pc": "11", "t": "1704380400"}))
    assert flows.quote_flow(spark, f"{tmp}/land/quote", lay)["silver_quote"].count() == 1
