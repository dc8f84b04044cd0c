"""Published gold tables (G1-G10) as DataFrame -> DataFrame functions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.functions.scalars import bucketize, pct_change, period_label, ratio_round, safe_div
from bourse.operators import bars as B
from bourse.operators.joins import left_join_all
from bourse.operators.ranking import rank_within
from bourse.operators.reshape import priority_pivot
from bourse.operators.windows import (earliest_per_key, flag_latest, growth, lag_default,
                                      latest_per_key, snapshot_latest)

# FIXED VALUES (published thresholds and labels).
# Company size classes by market capitalisation in millions, first match wins.
SIZE_CLASSES = ((200000, "Mega cap"), (10000, "Large cap"), (2000, "Mid cap"),
                (300, "Small cap"))
SIZE_ELSE = "Micro cap"
# Analyst consensus labels by bullish score, first match wins.
CONSENSUS = ((4.5, "Strong buy"), (3.5, "Buy"), (2.5, "Hold"), (1.5, "Sell"))
CONSENSUS_ELSE = "Strong sell"
# Risk classes by beta (the 1.0 branch of the published rule has the same
# label as the 0.5 branch, so one branch covers both).
RISK_CLASSES = ((1.5, "High volatility"), (0.5, "Above Market"))
RISK_ELSE = "Low Volatility"
# Profitability weights: ROE, ROA, net margin, gross margin (TTM).
PROFITABILITY_WEIGHTS = (("roeTTM", 0.30), ("roaTTM", 0.20),
                         ("netProfitMarginTTM", 0.25), ("grossMarginTTM", 0.25))
# Reported-financials pivot: output column -> concepts in priority order.
FINANCIAL_CONCEPTS = {
    "revenue": ["us-gaap_Revenues",
                "us-gaap_RevenueFromContractWithCustomerExcludingAssessedTax",
                "SalesRevenueGoodsNet"],
    "net_income": ["us-gaap_NetIncomeLoss", "NetIncomeLoss", "us-gaap_ProfitLoss", "ProfitLoss"],
    "operating_income": ["us-gaap_OperatingIncomeLoss", "OperatingIncomeLoss"],
    "eps_basic": ["us-gaap_EarningsPerShareBasic", "EarningsPerShareBasic"],
    "eps_diluted": ["us-gaap_EarningsPerShareDiluted", "EarningsPerShareDiluted"],
    "assets": ["us-gaap_Assets", "Assets"],
    "total_debt": ["us-gaap_LongTermDebt", "us-gaap_LongTermDebtNoncurrent",
                   "us-gaap_DebtCurrent", "LongTermDebtCurrent"],
    "cash_and_equivalents": ["us-gaap_CashAndCashEquivalentsAtCarryingValue",
                             "CashAndCashEquivalentsAtCarryingValue",
                             "us-gaap_CashCashEquivalentsAndShortTermInvestments"],
    "shareholders_equity": ["us-gaap_StockholdersEquity", "StockholdersEquity"],
    "current_assets": ["us-gaap_AssetsCurrent", "AssetsCurrent"],
    "current_liabilities": ["us-gaap_LiabilitiesCurrent", "LiabilitiesCurrent"],
    "operating_cash_flow": ["us-gaap_NetCashProvidedByUsedInOperatingActivities",
                            "NetCashProvidedByUsedInOperatingActivities"],
    "capex": ["us-gaap_PaymentsToAcquirePropertyPlantAndEquipment",
              "PaymentsToAcquirePropertyPlantAndEquipment"],
    "dividends_paid": ["us-gaap_PaymentsOfDividendsCommonStock", "PaymentsOfDividendsCommonStock"],
    "buybacks": ["us-gaap_PaymentsForRepurchaseOfCommonStock", "PaymentsForRepurchaseOfCommonStock"],
}
FILING_KEYS = ("symbol", "year", "quarter", "startDate", "endDate", "filedDate", "cik",
               "accessNumber")


def _passing(df: DataFrame, flag: str, null_is_pass: bool = False) -> DataFrame:
    f = F.col(flag)
    return df.filter(f.isNull() | (f == F.lit(False))) if null_is_pass else df.filter(f == F.lit(False))


def dim_company(silver_profile: DataFrame, classes=SIZE_CLASSES, else_=SIZE_ELSE,
                flag: str = "is_critical", end_col: str = "__END_AT") -> DataFrame:
    """G1: current, non-critical profiles with a size class."""
    cur = _passing(silver_profile.filter(F.col(end_col).isNull()), flag)
    mc = F.col("marketCapitalization")
    return cur.select(
        "symbol", "name", "exchange", F.col("finnhubIndustry").alias("industry"),
        mc.alias("market_cap_mm"),
        bucketize([(mc >= F.lit(t), lab) for t, lab in classes], else_).alias("market_cap_category"),
        F.col("shareOutstanding").alias("shares_outstanding"))


def stock_candles(silver_candles: DataFrame,
                  segment: Callable[[Column], Column] | None = None) -> DataFrame:
    """Candles with the previous close per symbol (0 for the first)."""
    return lag_default(silver_candles, "close", ["symbol"], ["date"], 0,
                       out="previous_close_price", segment=segment)


def fact_daily_quote(silver_quote: DataFrame, gold_candles: DataFrame,
                     session: Callable[[Column], Column] = F.to_date,
                     snapshot_grain: str = "day", quote_tie: str | None = None) -> DataFrame:
    """Latest-load quotes of each day and candles, one row per
    (symbol, session) -- the earliest loaded; ties: quote before candle, then
    ``quote_tie``."""
    snap = snapshot_latest(silver_quote, "ingest_timestamp", snapshot_grain)
    tie = F.col(quote_tie).cast("bigint") if quote_tie else F.lit(0).cast("bigint")
    q = snap.select("symbol", "close_price", "high_price", "low_price", "open_price",
                    "previous_close_price", session(F.col("event_timestamp")).alias("session_date"),
                    "percent_change", "ingest_timestamp",
                    F.lit(0).alias("__src"), tie.alias("__tie"))
    c = gold_candles.select("symbol", F.col("close").alias("close_price"),
                            F.col("high").alias("high_price"), F.col("low").alias("low_price"),
                            F.col("open").alias("open_price"), "previous_close_price",
                            F.col("date").alias("session_date"),
                            pct_change("close", "previous_close_price").alias("percent_change"),
                            "ingest_timestamp", F.lit(1).alias("__src"),
                            F.lit(0).cast("bigint").alias("__tie"))
    u = q.union(c)  # by position, as UNION ALL
    first = earliest_per_key(u, ["symbol", "session_date"], ["ingest_timestamp", "__src", "__tie"])
    hi, lo, op = F.col("high_price"), F.col("low_price"), F.col("open_price")
    pc, cl = F.col("previous_close_price"), F.col("close_price")
    return first.drop("__src", "__tie").withColumns({
        "intraday_range": hi - lo,
        "intraday_pct": safe_div(hi - lo, op) * F.lit(100),
        "gap_flag": bucketize([(op > pc * F.lit(1.01), "gap_up"),
                               (op < pc * F.lit(0.99), "gap_down")], "no_gap"),
        "candle_direction": F.when(cl >= op, F.lit("bullish")).otherwise(F.lit("bearish")),
    })


def financial_ratio(silver_financials: DataFrame, spec: Mapping[str, Sequence[str]] = FINANCIAL_CONCEPTS,
                    keys: Sequence[str] = FILING_KEYS) -> DataFrame:
    """Priority pivot of line items per filing, then ratios.

    The silver table holds one row per filing and concept, so its rows are dealt out by filing as they are: a wide
    partial result for nearly every row would take several times their memory."""
    p = priority_pivot(silver_financials.repartition(*keys), keys, "concept", "value", spec, default=0)
    fcf = F.col("operating_cash_flow") - F.abs(F.col("capex"))
    p = p.withColumn("free_cash_flow", fcf)
    return p.withColumns({
        "debt_to_equity": ratio_round("total_debt", "shareholders_equity"),
        "current_ratio": ratio_round("current_assets", "current_liabilities"),
        "net_margin": ratio_round("net_income", "revenue", pct=True),
        "operating_margin": ratio_round("operating_income", "revenue", pct=True),
        "fcf_margin": ratio_round("free_cash_flow", "revenue", pct=True),
        "period_label": period_label("year", "quarter"),
    })


def fact_stock_metrics(silver_snapshot: DataFrame, flag: str = "is_critical") -> DataFrame:
    """Non-critical snapshots, risk class and profitability score."""
    s = _passing(silver_snapshot, flag)

    def z(c):
        return F.coalesce(F.col(f"`{c}`"), F.lit(0.0))
    prof = None
    for c, w in PROFITABILITY_WEIGHTS:
        t = z(c) * F.lit(w)
        prof = t if prof is None else prof + t
    beta = F.col("beta")
    return s.select(
        "symbol", z("peTTM").alias("pe_ttm"), z("pb").alias("pb"), z("beta").alias("beta"),
        bucketize([(beta >= F.lit(t), lab) for t, lab in RISK_CLASSES], RISK_ELSE).alias("risk_category"),
        prof.alias("profitability_score"),
        z("psTTM").alias("ps_ttm"), z("evEbitdaTTM").alias("ev_ebitda_ttm"),
        z("roeTTM").alias("roe_ttm"), z("roaTTM").alias("roa_ttm"),
        z("52WeekHigh").alias("week52_high"), z("52WeekLow").alias("week52_low"),
        z("52WeekPriceReturnDaily").alias("return_52w"),
        z("13WeekPriceReturnDaily").alias("return_13w"),
        z("26WeekPriceReturnDaily").alias("return_26w"),
        z("currentDividendYieldTTM").alias("dividend_yield"),
        z("grossMarginTTM").alias("gross_margin_ttm"),
        z("operatingMarginTTM").alias("operating_margin_ttm"),
        z("netProfitMarginTTM").alias("net_profit_margin_ttm"),
        z("marketCapitalization").alias("market_capitalization"),
        "metric_date")


def fact_analyst_signal(silver_rec: DataFrame, flag: str = "is_critical",
                        current_only: bool = True, end_col: str = "__END_AT") -> DataFrame:
    """Consensus score per (symbol, period)."""
    r = _passing(silver_rec, flag)
    if current_only and end_col in r.columns:
        r = r.filter(F.col(end_col).isNull())
    sb, b, h, s, ss = (F.col(c) for c in ("strongBuy", "buy", "hold", "sell", "strongSell"))
    r = r.select("symbol", "period",
                 (sb + b + h + s + ss).alias("total_analysts"), "strongBuy",
                 (sb * 2 + b * 1 - s * 1 - ss * 2).alias("raw_score"))
    tot = F.col("total_analysts").cast("double")
    r = r.select("symbol", "period", "total_analysts", "raw_score",
                 F.round(F.lit(3.0) + safe_div(F.col("raw_score").cast("double"), tot), 2).alias("bullish_score"),
                 F.round(safe_div(F.col("strongBuy").cast("double"), tot) * F.lit(100), 2).alias("pct_strong_buy"))
    bs = F.col("bullish_score")
    return r.withColumn("consensus_label",
                        bucketize([(bs >= F.lit(t), lab) for t, lab in CONSENSUS], CONSENSUS_ELSE))


def realtime_agg(silver_trades: DataFrame, width: str = "1 minute", tie_break: str | None = None,
                 watermark: str = "30 seconds") -> DataFrame:
    """OHLCV bars per symbol and window (batch or streaming input)."""
    return B.bars(silver_trades, width=width, tie_break=tie_break, watermark=watermark)


def _one_filing(ratio: DataFrame, keys: Sequence[str], filing_order: Sequence[str]) -> DataFrame:
    if not filing_order:
        return ratio
    return latest_per_key(ratio, keys, list(filing_order))


def financial_annual_yoy(ratio: DataFrame, metric: str = "revenue",
                         filing_order: Sequence[str] = ("filedDate", "accessNumber")) -> DataFrame:
    """Growth of ``metric`` against exactly the prior fiscal year."""
    a = _one_filing(ratio.filter(F.col("quarter") == 0), ["symbol", "year"],
                    [c for c in filing_order if c in ratio.columns])
    g = growth(a, ["symbol"], "year", metric, "yoy_growth")
    return g.select("symbol", "year", "quarter", "period_label", "yoy_growth")


def financial_quarterly_qoq(ratio: DataFrame, metric: str = "revenue",
                            filing_order: Sequence[str] = ("filedDate", "accessNumber")) -> DataFrame:
    """Growth of ``metric`` against exactly the preceding fiscal quarter."""
    qd = _one_filing(ratio.filter(F.col("quarter").between(1, 4)), ["symbol", "year", "quarter"],
                     [c for c in filing_order if c in ratio.columns])
    g = growth(qd, ["symbol"], F.col("year") * 4 + F.col("quarter"), metric, "qoq_growth")
    return g.select("symbol", "year", "quarter", "period_label", "qoq_growth")


def _mean(cols: Sequence[Column]) -> Column:
    """Mean of the non-null columns; NULL when all are NULL."""
    s = None
    n = None
    for c in cols:
        v = F.coalesce(c, F.lit(0.0))
        k = F.when(c.isNull(), F.lit(0)).otherwise(F.lit(1))
        s = v if s is None else s + v
        n = k if n is None else n + k
    return F.when(n > 0, s / n)


# Scorecard tiers (ours; the published docs name the columns only).
TIERS = ((70.0, "A"), (40.0, "B"))
TIER_ELSE = "C"


def stock_scorecard(dim: DataFrame, daily_quote: DataFrame, analyst: DataFrame,
                    metrics: DataFrame, industry: str = "industry") -> DataFrame:
    """One row per (symbol, metric_date) with sub-scores, composite,
    ranks within the snapshot date (overall and per industry) and the newest
    snapshot flag."""
    dq = latest_per_key(daily_quote, ["symbol"], ["session_date", "ingest_timestamp"]) \
        .select("symbol", "close_price", "percent_change", "candle_direction")
    an = latest_per_key(analyst, ["symbol"], ["period"]) \
        .select("symbol", "total_analysts", "bullish_score", "consensus_label")
    me = metrics.select("symbol", "pe_ttm", "pb", "ev_ebitda_ttm", "roe_ttm", "beta", "return_52w",
                        "profitability_score", "market_capitalization", "metric_date")
    base = dim.select("symbol", F.col("name").alias("company_name"), "exchange", industry,
                      "market_cap_category")
    t = left_join_all(base, [(dq, ["symbol"]), (an, ["symbol"]), (me, ["symbol"])])
    part = ["metric_date"]
    pos = {"pe_ttm": "v_pe", "pb": "v_pb", "ev_ebitda_ttm": "v_ev"}
    t = t.withColumns({v: F.when(F.col(c) > 0, F.col(c)) for c, v in pos.items()})
    # the ranks below read their input more than once: materialise the joined
    # base once in the shared checkpoint folder
    t = t.checkpoint(eager=True)
    measures = ["return_52w", "percent_change", "profitability_score", "roe_ttm", *pos.values()]
    # all percent ranks in one distributed rank pass: long form, rank per
    # (snapshot date, measure), back to wide
    long = t.select("symbol", *part, F.expr(
        f"stack({len(measures)}, "
        + ", ".join(f"'{m}', cast(`{m}` as double)" for m in measures)
        + ") as (__m, __v)"))
    ranked = rank_within(long, [*part, "__m"], "__v", out="__r", desc=False, pct_out="__pr",
                         nulls="exclude")
    wide = ranked.groupBy("symbol", *part).agg(
        *[F.max(F.when(F.col("__m") == m, F.col("__pr"))).alias(f"__pr_{m}") for m in measures])
    w = wide.withColumnRenamed("metric_date", "__md").withColumnRenamed("symbol", "__sym")
    t = t.join(w, (t["symbol"] == w["__sym"]) & t["metric_date"].eqNullSafe(w["__md"]), "left") \
        .drop("__sym", "__md")
    pr = {m: F.col(f"__pr_{m}") for m in measures}
    t = t.withColumns({
        "momentum_score": _mean([pr["return_52w"], pr["percent_change"]]) * F.lit(100.0),
        "quality_score": _mean([pr["profitability_score"], pr["roe_ttm"]]) * F.lit(100.0),
        "valuation_score": _mean([F.lit(1.0) - pr[v] for v in pos.values()]) * F.lit(100.0),
        "analyst_score": (F.col("bullish_score") - F.lit(1.0)) / F.lit(4.0) * F.lit(100.0),
    })
    subs = ["momentum_score", "quality_score", "valuation_score", "analyst_score"]
    comp = sum((F.coalesce(F.col(s), F.lit(50.0)) for s in subs[1:]),
               F.coalesce(F.col(subs[0]), F.lit(50.0))) / F.lit(4.0)
    t = t.withColumn("composite_score", comp)
    t = t.drop(*[c for c in t.columns if c.startswith("__")])
    # both final ranks in one distributed pass: each row twice, once scoped to
    # its industry and once to the whole snapshot date
    scopes = F.explode(F.array(
        F.struct(F.lit("sector").alias("scope"), F.col(industry).cast("string").alias("grp")),
        F.struct(F.lit("overall").alias("scope"), F.lit(None).cast("string").alias("grp"))))
    two = t.select("symbol", *part, "composite_score", scopes.alias("__s")) \
        .select("symbol", *part, "composite_score", F.col("__s.scope").alias("__scope"),
                F.col("__s.grp").alias("__grp"))
    rk = rank_within(two, [*part, "__scope", "__grp"], "composite_score", out="__rk", desc=True)
    ranks = rk.groupBy(F.col("symbol").alias("__sym"), F.col("metric_date").alias("__md")).agg(
        F.max(F.when(F.col("__scope") == "sector", F.col("__rk"))).alias("sector_rank"),
        F.max(F.when(F.col("__scope") == "overall", F.col("__rk"))).alias("overall_rank"))
    t = t.join(ranks, (t["symbol"] == ranks["__sym"]) & t["metric_date"].eqNullSafe(ranks["__md"]),
               "left").drop("__sym", "__md")
    t = t.withColumn("investment_tier",
                     bucketize([(F.col("composite_score") >= F.lit(x), lab) for x, lab in TIERS],
                               TIER_ELSE))
    t = flag_latest(t, ["symbol"], ["metric_date"], out="is_latest")
    drop = [c for c in t.columns if c.startswith("__") or c in pos.values()]
    return t.drop(*drop)
