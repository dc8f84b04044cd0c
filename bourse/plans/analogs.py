"""Market-shaped inputs derived from the driver's TPC-H-style tables.

Each builder returns a DataFrame whose columns have the names and types of
one of the pipeline inputs (candles, quotes, keyed change feeds, analyst
ratings, filing line items, company profiles, metric snapshots, trades), so
the published tables run unchanged over data whose size grows with the
scale factor.  ``bourse.plans.oracle`` holds the same derivations in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _month(c: Column) -> Column:
    return F.trunc(F.to_date(c), "month")


def candles(spark: SparkSession, d: str) -> DataFrame:
    """One candle per supplier (symbol) and ship month; open / close are NULL
    for some rows, which exercises the NULL rule verdict."""
    li = read(spark, d, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("symbol"),
                      _month(F.col("l_shipdate")).alias("date")).agg(
        F.min(F.when(F.col("l_linenumber") <= 2, F.col("l_extendedprice"))).alias("open"),
        F.max("l_extendedprice").alias("high"),
        F.min("l_extendedprice").alias("low"),
        F.max(F.when(F.col("l_linenumber") >= 6, F.col("l_extendedprice"))).alias("close"),
        F.sum("l_quantity").cast("bigint").alias("volume"),
        F.max("l_shipdate").alias("ingest_timestamp"))


def quotes(spark: SparkSession, d: str) -> DataFrame:
    """Typed quotes (the silver-quote input shape), one per order."""
    o = read(spark, d, "orders")
    k = F.col("o_orderkey")
    p = F.col("o_totalprice")
    return o.select(
        F.when(k % 97 == 0, F.lit(None)).otherwise(F.col("o_custkey") % 100).alias("symbol"),
        k.alias("seq"),
        F.when(k % 50 == 0, F.lit(None)).otherwise(p).alias("close_price"),
        (p - (p - ((k % 5) - 2) * F.lit(2000.0))).alias("change"),
        ((k % 21) - 10).cast("double").alias("percent_change"),
        (p * 2).alias("high_price"),
        (p * 0.5).alias("low_price"),
        (p - ((k % 7) - 3) * F.lit(1000.0)).alias("open_price"),
        (p - ((k % 5) - 2) * F.lit(2000.0)).alias("previous_close_price"),
        F.col("o_orderdate").alias("event_timestamp"),
        F.col("o_orderdate").alias("ingest_timestamp"))


def changes(spark: SparkSession, d: str) -> DataFrame:
    """Keyed change feed: one change per order, keyed by customer; seq unique."""
    o = read(spark, d, "orders")
    return o.select(F.col("o_custkey").alias("symbol"), F.col("o_orderkey").alias("seq"),
                    F.col("o_orderstatus").alias("status"),
                    F.col("o_orderpriority").alias("priority"),
                    F.col("o_totalprice").alias("amount"))


def ratings(spark: SparkSession, d: str) -> DataFrame:
    """Analyst counts per (symbol, month): order priorities as the five classes."""
    o = read(spark, d, "orders")
    pr = F.col("o_orderpriority")

    def cnt(v):
        return F.sum(F.when(pr == v, 1).otherwise(0)).cast("int")
    return o.groupBy((F.col("o_custkey") % 100).alias("symbol"),
                     _month(F.col("o_orderdate")).cast("string").alias("period")).agg(
        cnt("1-URGENT").alias("strongBuy"), cnt("2-HIGH").alias("buy"),
        cnt("3-MEDIUM").alias("hold"), cnt("4-NOT SPECIFIED").alias("sell"),
        cnt("5-LOW").alias("strongSell"),
        F.max("o_orderdate").alias("ingest_timestamp"))


def items(spark: SparkSession, d: str) -> DataFrame:
    """Filing line items: one value per (symbol, year, quarter, concept);
    quarter 0 rows are the annual filings."""
    li = read(spark, d, "lineitem")
    concept = F.concat(F.col("l_returnflag"), F.lit("_"), F.col("l_linestatus"))
    base = li.select((F.col("l_orderkey") % 500).alias("symbol"),
                     F.year("l_shipdate").cast("bigint").alias("year"),
                     F.quarter("l_shipdate").cast("bigint").alias("quarter"),
                     concept.alias("concept"), F.col("l_extendedprice"))
    q = base.groupBy("symbol", "year", "quarter", "concept").agg(
        F.max("l_extendedprice").alias("value"))
    a = base.groupBy("symbol", "year", "concept").agg(
        F.max("l_extendedprice").alias("value")).select(
        "symbol", "year", F.lit(0).cast("bigint").alias("quarter"), "concept", "value")
    return q.unionByName(a)


def profile_changes(spark: SparkSession, d: str) -> DataFrame:
    """Company profile loads: one per order, company fields from the customer.
    A profile changes when the order status moves between F and not-F."""
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = read(spark, d, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    return j.select(
        F.lit("US").alias("country"), F.lit("USD").alias("currency"),
        F.concat(F.lit("X"), (F.col("c_nationkey") % 3).cast("string")).alias("exchange"),
        F.col("c_mktsegment").alias("finnhubIndustry"),
        F.lit("2000-01-01").alias("ipo"),
        (F.col("c_acctbal") * 10 + F.when(F.col("o_orderstatus") == "F", F.lit(0.0))
         .otherwise(F.lit(500.0))).alias("marketCapitalization"),
        F.col("c_nationkey").cast("double").alias("shareOutstanding"),
        F.col("c_name").alias("ticker"),
        F.col("c_name").alias("name"),
        F.col("o_custkey").alias("symbol"),
        F.col("o_orderdate").alias("ingest_timestamp"),
        F.col("o_orderkey").alias("load_id"))


def snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Metric snapshots (the flattened metric record) from parts: two loads for
    some (symbol, day), NULL ratios for some rows."""
    p = read(spark, d, "part")
    k, sz, pr = F.col("p_partkey"), F.col("p_size"), F.col("p_retailprice")
    day = F.floor(k / F.lit(500.0)).cast("int") % 3
    return p.select(
        (k % 500).alias("symbol"),
        F.date_add(F.lit("2024-01-01").cast("date"), day).alias("metric_date"),
        k.alias("load_id"),
        ((pr - 950) * 100).alias("marketCapitalization"),
        (pr * 2).alias("enterpriseValue"),
        (sz / F.lit(25.0)).alias("beta"),
        F.when(sz % 10 == 0, F.lit(None)).otherwise(pr / F.lit(10.0)).alias("peTTM"),
        (sz * F.lit(0.5)).alias("pb"),
        ((sz - 25) / F.lit(10.0)).alias("roeTTM"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(sz / F.lit(100.0)).alias("roaTTM"),
        (sz / F.lit(200.0)).alias("netProfitMarginTTM"),
        (sz / F.lit(64.0)).alias("grossMarginTTM"),
        (pr / F.lit(400.0)).alias("psTTM"),
        (pr / F.lit(100.0)).alias("evEbitdaTTM"),
        (pr * 1.5).alias("52WeekHigh"),
        (pr * 0.5).alias("52WeekLow"),
        (sz - F.lit(20.0)).alias("52WeekPriceReturnDaily"),
        (sz / F.lit(4.0)).alias("13WeekPriceReturnDaily"),
        (sz / F.lit(2.0)).alias("26WeekPriceReturnDaily"),
        F.when(sz > 40, F.lit(None)).otherwise(sz / F.lit(50.0)).alias("currentDividendYieldTTM"),
        (sz / F.lit(80.0)).alias("operatingMarginTTM"))


def trades(spark: SparkSession, d: str) -> DataFrame:
    """Trades (the parsed live-trade shape) from events: user = symbol,
    value = price, props.k = volume, a condition code per trade (NULL for
    error events)."""
    return trades_from(read(spark, d, "events"))


def trades_from(e: DataFrame) -> DataFrame:
    """The trade projection of an events DataFrame (batch or stream)."""
    cond = F.when(F.col("event_type") == "error", F.lit(None)).otherwise(
        F.array((F.col("event_id") % 60).cast("string")))
    return e.select(
        F.col("user_id").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
        cond.alias("conditions"),
        F.col("ts").alias("timestamp"),
        F.col("event_id"))


def _concept_names() -> list[str]:
    from bourse.plans.gold import FINANCIAL_CONCEPTS
    return [c for names in FINANCIAL_CONCEPTS.values() for c in names]


def filings(spark: SparkSession, d: str) -> DataFrame:
    """Reported-financials bronze rows (nested): one filing per order whose
    statements hold its line items -- bs for return flag A, ic for N, cf for
    R (an empty statement is NULL).  The concept is one of the published
    concept names picked by line number and flag; line 7 of flag R carries a
    non-numeric value.  Lines per order are bounded, so the per-order
    ``collect_list`` is a bounded group."""
    li = read(spark, d, "lineitem")
    names = F.array(*[F.lit(n) for n in _concept_names()])
    rf = F.col("l_returnflag")
    rf_idx = F.when(rf == "A", 0).when(rf == "N", 1).otherwise(2)
    concept = F.element_at(names, ((F.col("l_linenumber") * 3 + rf_idx) % len(_concept_names())) + 1)
    value = F.when((F.col("l_linenumber") == 7) & (rf == "R"), F.lit("n/a")) \
             .otherwise(F.col("l_extendedprice").cast("string"))
    item = F.struct(concept.alias("concept"), F.concat(F.lit("label "), concept).alias("label"),
                    F.lit("USD").alias("unit"), value.alias("value"))
    # one collect per order, split into statements with array filters
    g = li.groupBy("l_orderkey").agg(
        F.collect_list(F.struct(rf.alias("rf"), item.alias("it"))).alias("__items"))

    def stmt(flag):
        kept = F.filter("__items", lambda x: x["rf"] == F.lit(flag))
        arr = F.transform(kept, lambda x: x["it"])
        return F.when(F.size(arr) > 0, arr)
    nz = {"bs": stmt("A"), "ic": stmt("N"), "cf": stmt("R")}
    k = F.col("l_orderkey")
    filing = F.struct(
        F.lit("2024-04-15").alias("acceptedDate"), k.cast("string").alias("accessNumber"),
        F.concat(F.lit("CIK"), (k % 500).cast("string")).alias("cik"),
        F.lit("2024-03-31").alias("endDate"), F.lit("2024-04-15").alias("filedDate"),
        F.lit("10-Q").alias("form"), (k % 5).cast("bigint").alias("quarter"),
        F.struct(nz["bs"].alias("bs"), nz["cf"].alias("cf"), nz["ic"].alias("ic")).alias("report"),
        F.lit("2024-01-01").alias("startDate"), (k % 500).cast("string").alias("symbol"),
        (F.lit(1995) + k % 30).cast("bigint").alias("year"))
    return g.select(F.concat(F.lit("CIK"), (k % 500).cast("string")).alias("cik"),
                    (k % 500).cast("string").alias("symbol"),
                    F.array(filing).alias("data"),
                    F.lit("2024-05-01 00:00:00").cast("timestamp_ntz").alias("ingest_timestamp"))


def metric_bronze(spark: SparkSession, d: str) -> DataFrame:
    """Metric bronze rows with annual series (nested): one per order; series
    ``eps`` (extended price), ``pe`` (quantity) and ``roe`` (discount, NULL
    when the order has only flag R lines), period = line number."""
    li = read(spark, d, "lineitem")
    period = F.concat(F.lit("P"), F.col("l_linenumber").cast("string"))

    def pt(v):
        return F.struct(period.alias("period"), F.col(v).cast("double").alias("v"))
    g = li.groupBy("l_orderkey").agg(
        F.collect_list(pt("l_extendedprice")).alias("eps"),
        F.collect_list(pt("l_quantity")).alias("pe"),
        F.collect_list(F.when(F.col("l_returnflag") != "R", pt("l_discount"))).alias("roe"),
        F.collect_list(pt("l_tax")).alias("qeps"))
    roe = F.when(F.size("roe") > 0, F.col("roe"))
    return g.select(F.col("l_orderkey").cast("string").alias("symbol"),
                    F.struct(F.struct("eps", "pe", roe.alias("roe")).alias("annual"),
                             F.struct(F.col("qeps").alias("eps")).alias("quarterly")).alias("series"),
                    F.lit("2024-05-01 00:00:00").cast("timestamp_ntz").alias("ingest_timestamp"))


def bronze_quotes(spark: SparkSession, d: str) -> DataFrame:
    """Raw quote records as the quote API sends them: every field text, epoch
    seconds in ``t`` (spread over the day, so daylight-saving edges occur),
    some symbols missing, some prices NULL or unparsable."""
    return bronze_quotes_from(read(spark, d, "orders"))


def bronze_quotes_from(o: DataFrame) -> DataFrame:
    """The bronze-quote projection of an orders DataFrame (batch or stream)."""
    k, p = F.col("o_orderkey"), F.col("o_totalprice")

    def s(c):
        return c.cast("string")
    c = F.when(k % 50 == 0, F.lit(None)).when(k % 89 == 0, F.lit("bad")).otherwise(s(p))
    t = F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + (k * 7919) % 86400
    return o.select(
        F.when(k % 97 == 0, F.lit(None)).otherwise(s(F.col("o_custkey") % 100)).alias("symbol"),
        c.alias("c"), s((k % 5) - 2).alias("d"), s((k % 21) - 10).alias("dp"),
        s(p * 2).alias("h"), s(p * 0.5).alias("l"), s(p - ((k % 7) - 3) * F.lit(1000.0)).alias("o"),
        s(p - ((k % 5) - 2) * F.lit(2000.0)).alias("pc"), s(t).alias("t"),
        F.col("o_orderdate").alias("ingest_timestamp"))


def bronze_candles(spark: SparkSession, d: str) -> DataFrame:
    """Raw candle CSV rows (all text) from the candle analog; a few bad dates."""
    c = candles(spark, d)
    bad = (F.col("symbol") % 37 == 0) & (F.month("date") == 1)
    return c.select(F.col("symbol").cast("string").alias("symbol"),
                    F.when(bad, F.lit("bad-date")).otherwise(F.col("date").cast("string")).alias("date"),
                    *[F.col(x).cast("string").alias(x) for x in ("open", "high", "low", "close", "volume")],
                    "ingest_timestamp")


def bronze_metric_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Metric bronze rows with the ``metric`` struct (snapshot fields), UTC
    load time at noon of the metric day, one load per part."""
    s = snapshots(spark, d)
    fields = [c for c in s.columns if c not in ("symbol", "metric_date", "load_id")]
    ts = F.timestamp_seconds(F.unix_date("metric_date").cast("bigint") * 86400 + 43200)
    ing = F.timestamp_seconds(F.lit(1706745600) + F.col("load_id"))
    return s.select(F.struct(*[F.col(f"`{c}`") for c in fields]).alias("metric"),
                    F.lit("all").alias("metricType"),
                    F.col("symbol").cast("string").alias("symbol"), ts.alias("timestamp"),
                    ing.cast("timestamp_ntz").alias("ingest_timestamp"))


def bronze_recommendations(spark: SparkSession, d: str) -> DataFrame:
    """Raw recommendation records: one per (symbol, month) with the counts as
    text inside ``data``; every tenth symbol also sends an empty ``data``."""
    r = ratings(spark, d)
    item = F.struct(F.col("period"), *[F.col(c).cast("string").alias(c) for c in
                                       ("buy", "hold", "sell", "strongBuy", "strongSell")],
                    F.col("symbol").cast("string").alias("symbol"))
    data = F.when((F.col("symbol") % 10 == 0) & (F.month(F.col("period").cast("date")) == 2),
                  F.array().cast("array<struct<period:string,buy:string,hold:string,sell:string,"
                                 "strongBuy:string,strongSell:string,symbol:string>>")) \
        .otherwise(F.array(item))
    return r.select(F.col("symbol").cast("string").alias("symbol"), data.alias("data"),
                    "ingest_timestamp")
