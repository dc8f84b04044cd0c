"""DuckDB SQL equal in result to each registered query (the correctness gate).

The analog inputs are written again here as SQL CTEs over the driver tables,
independently of the DataFrame code in ``analogs``.  Rule predicates come from
the same catalog, so a rule edit reaches both sides.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from bourse.operators.quality import RuleSet
from bourse.plans import registry as R

D = "cast({} as double)".format

CANDLES = """candles AS (
  select l_suppkey as symbol, cast(date_trunc('month', l_shipdate) as date) as date,
         min(case when l_linenumber <= 2 then l_extendedprice end) as open,
         max(l_extendedprice) as high, min(l_extendedprice) as low,
         max(case when l_linenumber >= 6 then l_extendedprice end) as close,
         cast(sum(l_quantity) as bigint) as volume, max(l_shipdate) as ingest_timestamp
  from lineitem group by 1, 2)"""

QUOTES = """quotes AS (
  select case when o_orderkey % 97 = 0 then NULL else o_custkey % 100 end as symbol,
         o_orderkey as seq,
         case when o_orderkey % 50 = 0 then NULL else o_totalprice end as close_price,
         o_totalprice - (o_totalprice - ((o_orderkey % 5) - 2) * 2000.0) as change,
         cast((o_orderkey % 21) - 10 as double) as percent_change,
         o_totalprice * 2 as high_price,
         o_totalprice * 0.5 as low_price,
         o_totalprice - ((o_orderkey % 7) - 3) * 1000.0 as open_price,
         o_totalprice - ((o_orderkey % 5) - 2) * 2000.0 as previous_close_price,
         o_orderdate as event_timestamp, o_orderdate as ingest_timestamp
  from orders)"""

CHANGES = """changes AS (
  select o_custkey as symbol, o_orderkey as seq, o_orderstatus as status,
         o_orderpriority as priority, o_totalprice as amount from orders)"""

RATINGS = """ratings AS (
  select o_custkey % 100 as symbol,
         cast(cast(date_trunc('month', o_orderdate) as date) as varchar) as period,
         cast(sum(case when o_orderpriority = '1-URGENT' then 1 else 0 end) as integer) as "strongBuy",
         cast(sum(case when o_orderpriority = '2-HIGH' then 1 else 0 end) as integer) as buy,
         cast(sum(case when o_orderpriority = '3-MEDIUM' then 1 else 0 end) as integer) as hold,
         cast(sum(case when o_orderpriority = '4-NOT SPECIFIED' then 1 else 0 end) as integer) as sell,
         cast(sum(case when o_orderpriority = '5-LOW' then 1 else 0 end) as integer) as "strongSell",
         max(o_orderdate) as ingest_timestamp
  from orders group by 1, 2)"""

ITEMS = """items AS (
  select l_orderkey % 500 as symbol, cast(year(l_shipdate) as bigint) as year,
         cast(quarter(l_shipdate) as bigint) as quarter,
         concat(l_returnflag, '_', l_linestatus) as concept, max(l_extendedprice) as value
  from lineitem group by 1, 2, 3, 4
  union all
  select l_orderkey % 500 as symbol, cast(year(l_shipdate) as bigint) as year,
         cast(0 as bigint) as quarter,
         concat(l_returnflag, '_', l_linestatus) as concept, max(l_extendedprice) as value
  from lineitem group by 1, 2, 4)"""

PROFILES = """profile_changes AS (
  select 'US' as country, 'USD' as currency,
         concat('X', cast(c_nationkey % 3 as varchar)) as exchange,
         c_mktsegment as "finnhubIndustry", '2000-01-01' as ipo,
         c_acctbal * 10 + case when o_orderstatus = 'F' then 0.0 else 500.0 end as "marketCapitalization",
         cast(c_nationkey as double) as "shareOutstanding", c_name as ticker, c_name as name,
         o_custkey as symbol, o_orderdate as ingest_timestamp, o_orderkey as load_id
  from orders join customer on o_custkey = c_custkey)"""

SNAPSHOTS = f"""snapshots AS (
  select p_partkey % 500 as symbol,
         cast(date '2024-01-01' + (cast(floor(p_partkey / {D(500.0)}) as integer) % 3) as date) as metric_date,
         p_partkey as load_id,
         (p_retailprice - 950) * 100 as "marketCapitalization",
         p_retailprice * 2 as "enterpriseValue",
         p_size / {D(25.0)} as beta,
         case when p_size % 10 = 0 then NULL else p_retailprice / {D(10.0)} end as "peTTM",
         p_size * {D(0.5)} as pb,
         (p_size - 25) / {D(10.0)} as "roeTTM",
         case when p_partkey % 3 = 0 then NULL else p_size / {D(100.0)} end as "roaTTM",
         p_size / {D(200.0)} as "netProfitMarginTTM",
         p_size / {D(64.0)} as "grossMarginTTM",
         p_retailprice / {D(400.0)} as "psTTM",
         p_retailprice / {D(100.0)} as "evEbitdaTTM",
         p_retailprice * {D(1.5)} as "52WeekHigh",
         p_retailprice * {D(0.5)} as "52WeekLow",
         p_size - {D(20.0)} as "52WeekPriceReturnDaily",
         p_size / {D(4.0)} as "13WeekPriceReturnDaily",
         p_size / {D(2.0)} as "26WeekPriceReturnDaily",
         case when p_size > 40 then NULL else p_size / {D(50.0)} end as "currentDividendYieldTTM",
         p_size / {D(80.0)} as "operatingMarginTTM"
  from part)"""

TRADES = """trades AS (
  select user_id as symbol, value as price,
         cast(json_extract_string(props, '$.k') as bigint) as volume,
         case when event_type = 'error' then NULL else [cast(event_id % 60 as varchar)] end as conditions,
         ts as timestamp, event_id
  from events)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def flag_sql(rules: RuleSet, null_policy: str = "sql") -> str:
    if null_policy == "sql":
        return "(NOT (" + " AND ".join(f"({s})" for _, s in rules.critical) + "))"
    return "(NOT (" + " AND ".join(f"coalesce(({s}), false)" for _, s in rules.critical) + "))"


def reason_sql(rules: RuleSet, null_policy: str = "sql") -> str:
    parts = []
    for n, s in rules.critical:
        cond = f"NOT ({s})" if null_policy == "sql" else f"NOT coalesce(({s}), false)"
        parts.append(f"CASE WHEN {cond} THEN '{n} has failed' END")
    return "concat_ws(', ', " + ", ".join(parts) + ")"


def scd2_sql(src: str, keys: Sequence[str], seq: str, tracked: Sequence[str],
             out_cols: Sequence[str], tie: Sequence[str] = ()) -> str:
    """History per key, written with plain window functions."""
    k = ", ".join(keys)
    order = ", ".join([seq, *tie])
    order_desc = ", ".join(f"{c} desc" for c in [seq, *tie])
    tie_desc = ", ".join(f"{c} desc" for c in tie) or seq
    same = " AND ".join(f"{c} IS NOT DISTINCT FROM lag({c}) OVER w" for c in tracked)
    return f"""
  dd AS (select * from {src} where {seq} is not null
         qualify row_number() over (partition by {k}, {seq} order by {tie_desc}) = 1),
  ch AS (select *, case when row_number() over w = 1 then 1 when {same} then 0 else 1 end as __new
         from dd window w as (partition by {k} order by {order})),
  rn AS (select *, max(case when __new = 1 then {seq} end) over
           (partition by {k} order by {order} rows between unbounded preceding and current row) as __run
         from ch),
  ver AS (select * from rn qualify row_number() over (partition by {k}, __run order by {order_desc}) = 1),
  hist AS (select {", ".join(out_cols)}, __run as "__START_AT",
           lead(__run) over (partition by {k} order by __run) as "__END_AT" from ver)"""


CR, QR, PR, SR, RR = (R.CANDLE_RULES, R.QUOTE_RULES, R.PROFILE_RULES, R.SNAPSHOT_RULES,
                      R.REC_RULES)
CANDLE_COLS = "symbol, date, open, high, low, close, volume, ingest_timestamp"

SQL: dict[str, str] = {}

# ---------------------------------------------------------------- quality
SQL["c1_flag_candles"] = with_(CANDLES) + f"""
select symbol, date, open, close, {flag_sql(CR)} as is_quarantined,
       {reason_sql(CR)} as quarantine_reason from candles"""

SQL["c3_valid_candles"] = with_(CANDLES) + f"""
select {CANDLE_COLS} from candles where {flag_sql(CR)} = false"""

SQL["c4_quarantine_candles"] = with_(CANDLES) + f"""
select *, {flag_sql(CR)} as is_quarantined, {reason_sql(CR)} as quarantine_reason
from candles where {flag_sql(CR)} = true"""

SQL["c5_undecided_candles"] = with_(CANDLES) + f"""
select *, {flag_sql(CR)} as is_quarantined, {reason_sql(CR)} as quarantine_reason
from candles where {flag_sql(CR)} is null"""

SQL["c6_expectation_counts"] = with_(CANDLES) + "\nunion all\n".join(
    f"""select '{sev}' as severity, '{n}' as rule, cast(count_if(({s})) as bigint) as passed,
       cast(count_if(NOT ({s})) as bigint) as failed, cast(count_if(({s}) IS NULL) as bigint) as unknown
from candles""" for sev, n, s in CR.all_rules())

SQL["c7_flag_keep_quotes"] = with_(QUOTES) + f"""
select seq, symbol, close_price, {flag_sql(QR)} as is_critical, {reason_sql(QR)} as critical_reason
from quotes"""

SQL["c1_flag_fail_policy_quotes"] = with_(QUOTES) + f"""
select seq, {flag_sql(QR, 'fail')} as is_quarantined, {reason_sql(QR, 'fail')} as quarantine_reason
from quotes"""

# -------------------------------------------------------------------- CDC
SQL["d1_scd1_latest"] = with_(CHANGES) + """
select * from changes qualify row_number() over (partition by symbol order by seq desc) = 1"""

SQL["d2_scd2_history"] = with_(CHANGES, "c2 AS (select symbol, seq, status from changes)"
                               + "," + scd2_sql("c2", ["symbol"], "seq", ["status"],
                                                ["symbol", "seq", "status"])) + """
select * from hist"""

SQL["d3_scd2_except_segmented"] = with_(
    CHANGES, "c3 AS (select symbol, seq, status, amount from changes)" + ","
    + scd2_sql("c3", ["symbol"], "seq", ["status"], ["symbol", "seq", "status", "amount"])) + """
select * from hist"""

SQL["d4_dedup_first"] = with_(CHANGES) + """
select * from changes qualify row_number() over (partition by symbol, status order by seq) = 1"""

# ---------------------------------------------------------------- reshape
SQL["e1_explode_embeddings"] = """
select vec_id, label, unnest(embedding) as x from embeddings"""

SQL["e3_unpivot_candles"] = with_(CANDLES) + "\nunion all\n".join(
    f"select symbol, date, '{m}' as metric, {m} as value from candles"
    for m in ("open", "high", "low", "close"))


def _pivot_cols(spec) -> str:
    out = []
    for name, concepts in spec.items():
        parts = [f"max(value) filter (where concept = '{c}')" for c in concepts]
        out.append(f"coalesce({', '.join(parts)}, {D(0)}) as {name}")
    return ",\n       ".join(out)


PIVOT = f"""pv AS (select symbol, year, quarter,
       {_pivot_cols(R.ITEM_SPEC)}
  from items group by symbol, year, quarter)"""

SQL["e5_priority_pivot"] = with_(ITEMS, PIVOT) + "select * from pv"

# ------------------------------------------------------------------ joins
SQL["f1_enrich_latest"] = """
with l as (select o_custkey, o_totalprice from orders
           qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1)
select e.*, l.o_totalprice as previous_close_price from events e left join l on e.user_id = l.o_custkey"""

# ---------------------------------------------------------------- windows
SQL["h1_lag_default"] = with_(CANDLES) + """
select symbol, date, close,
       coalesce(lag(close) over (partition by symbol order by date), 0) as previous_close_price
from candles"""

SQL["h2_latest_per_key"] = """
select * from orders
qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1"""

SQL["h3_snapshot_latest"] = """
select * from orders
qualify o_orderdate = max(o_orderdate) over (partition by date_trunc('month', o_orderdate))"""

SQL["h4_earliest_per_key"] = """
select * from orders
qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1"""

SQL["h5_qualify_top2"] = """
select * from orders
qualify row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) <= 2"""

SQL["h8_rank_within"] = """
select c_custkey, c_mktsegment, c_acctbal,
       rank() over (partition by c_mktsegment order by c_acctbal desc) as segment_rank,
       percent_rank() over (partition by c_mktsegment order by c_acctbal desc) as segment_pct_rank
from customer"""

SQL["h8_rank_overall"] = """
select c_custkey, c_acctbal, rank() over (order by c_acctbal desc) as overall_rank
from customer"""

SQL["h9_flag_latest"] = """
select o_orderkey, o_custkey, o_orderdate,
       row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1 as is_latest
from orders"""

# ----------------------------------------------------------------- set ops
SQL["i2_union_by_name"] = with_(CANDLES, QUOTES) + """
select symbol, date as session_date, close as close_price from candles
union all
select symbol, cast(event_timestamp as date) as session_date, close_price from quotes"""

# ----------------------------------------------------------------- sources
SQL["a4_rescued_props"] = """
select event_id, cast(NULL as varchar) as kind,
       '{"k":"' || json_extract_string(props, '$.k') || '"}' as _rescued_data
from events"""

SQL["a7_decode_kafka"] = """
select 'trades' as topic, cast(event_id % 4 as integer) as partition, event_id as "offset",
       ts as timestamp, 0 as "timestampType", cast(user_id as varchar) as key_str,
       props as value_str
from events"""

SQL["a9_kafka_payload"] = with_(TRADES) + """
select cast(event_id as varchar) as key,
       json_object('symbol', symbol, 'price', price, 'volume', volume,
                   'timestamp', epoch_us(timestamp) // 1000)::varchar as value
from trades"""

SQL["j16_parse_trades"] = with_(TRADES) + """
select cast(symbol as varchar) as symbol, price, volume, conditions,
       epoch_ms(epoch_us(timestamp) // 1000) as timestamp,
       cast(epoch_ms(epoch_us(timestamp) // 1000) as date) as session_date
from trades"""

SQL["j4_epoch_to_local"] = """
select event_id, cast(floor(epoch(ts)) as bigint) as epoch_s,
       timezone('America/New_York', to_timestamp(floor(epoch(ts)))) as event_timestamp
from events"""

# -------------------------------------------------------------------- gold
GOLD_CANDLES = f"""gc AS (
  select {CANDLE_COLS},
         coalesce(lag(close) over (partition by symbol order by date), 0) as previous_close_price
  from candles where {flag_sql(CR)} = false)"""

SILVER_QUOTE = f"""sq AS (select symbol, seq, close_price, change, percent_change, high_price,
       low_price, open_price, previous_close_price, event_timestamp, ingest_timestamp
  from quotes where {flag_sql(QR)} = false)"""

DAILY = """snap AS (select * from sq
  qualify ingest_timestamp = max(ingest_timestamp) over (partition by date_trunc('month', ingest_timestamp))),
  u AS (
  select symbol, close_price, high_price, low_price, open_price, previous_close_price,
         cast(date_trunc('month', event_timestamp) as date) as session_date, percent_change,
         ingest_timestamp, 0 as src, seq as tie from snap
  union all
  select symbol, close, high, low, open, previous_close_price, date,
         (close - previous_close_price) / nullif(previous_close_price, 0) * 100,
         ingest_timestamp, 1, 0 from gc),
  daily AS (
  select symbol, close_price, high_price, low_price, open_price, previous_close_price,
         session_date, percent_change, ingest_timestamp,
         high_price - low_price as intraday_range,
         (high_price - low_price) / nullif(open_price, 0) * 100 as intraday_pct,
         case when open_price > previous_close_price * 1.01 then 'gap_up'
              when open_price < previous_close_price * 0.99 then 'gap_down' else 'no_gap' end as gap_flag,
         case when close_price >= open_price then 'bullish' else 'bearish' end as candle_direction
  from u qualify row_number() over (partition by symbol, session_date order by ingest_timestamp, src, tie) = 1)"""

SQL["g2_stock_candles"] = with_(CANDLES, GOLD_CANDLES) + "select * from gc"

SQL["g3_fact_daily_quote"] = with_(CANDLES, QUOTES, GOLD_CANDLES, SILVER_QUOTE, DAILY) + \
    "select * from daily"

PROFILE_TRACKED = ["country", "currency", "exchange", '"finnhubIndustry"', "ipo",
                   '"marketCapitalization"', '"shareOutstanding"', "ticker", "name",
                   "is_critical", "critical_reason"]
PROFILE_FLAGGED = f"""pf AS (select *, {flag_sql(PR)} as is_critical, {reason_sql(PR)} as critical_reason
  from profile_changes)"""
PROFILE_HIST = scd2_sql("pf", ["symbol"], "ingest_timestamp", PROFILE_TRACKED,
                        ["symbol", *PROFILE_TRACKED, "ingest_timestamp", "load_id"], tie=["load_id"])
DIM = f"""dim AS (select symbol, name, exchange, "finnhubIndustry" as industry,
       "marketCapitalization" as market_cap_mm,
       case when "marketCapitalization" >= 200000 then 'Mega cap'
            when "marketCapitalization" >= 10000 then 'Large cap'
            when "marketCapitalization" >= 2000 then 'Mid cap'
            when "marketCapitalization" >= 300 then 'Small cap' else 'Micro cap' end as market_cap_category,
       "shareOutstanding" as shares_outstanding
  from hist where "__END_AT" is null and is_critical = false)"""

SQL["g1_dim_company"] = with_(PROFILES, PROFILE_FLAGGED + "," + PROFILE_HIST, DIM) + \
    "select * from dim"

SQL["s8_silver_profile_history"] = with_(PROFILES, PROFILE_FLAGGED + "," + PROFILE_HIST) + """
select symbol, "marketCapitalization", is_critical, ingest_timestamp, load_id, "__START_AT", "__END_AT"
from hist"""

RATIO = """ratio AS (select *,
       operating_cash_flow - abs(capex) as free_cash_flow,
       round(total_debt / nullif(shareholders_equity, 0), 4) as debt_to_equity,
       round(current_assets / nullif(current_liabilities, 0), 4) as current_ratio,
       round(net_income / nullif(revenue, 0) * 100, 4) as net_margin,
       round(operating_income / nullif(revenue, 0) * 100, 4) as operating_margin,
       round((operating_cash_flow - abs(capex)) / nullif(revenue, 0) * 100, 4) as fcf_margin,
       case when quarter = 0 then concat('FY', cast(year as varchar))
            else concat('Q', cast(quarter as varchar), '-', cast(year as varchar)) end as period_label
  from pv)"""

SQL["g4_financial_ratio"] = with_(ITEMS, PIVOT, RATIO) + "select * from ratio"


def _growth_sql(metric: str, annual: bool, out: str) -> str:
    if annual:
        body = f"""a AS (select * from ratio where quarter = 0)
select a.symbol, a.year, a.quarter, a.period_label,
       round((a.{metric} - p.{metric}) / abs(nullif(p.{metric}, 0)) * 100, 4) as {out}
from a left join a p on p.symbol = a.symbol and p.year = a.year - 1"""
    else:
        body = f"""a AS (select *, year * 4 + quarter as idx from ratio where quarter between 1 and 4)
select a.symbol, a.year, a.quarter, a.period_label,
       round((a.{metric} - p.{metric}) / abs(nullif(p.{metric}, 0)) * 100, 4) as {out}
from a left join a p on p.symbol = a.symbol and p.idx = a.idx - 1"""
    return with_(ITEMS, PIVOT, RATIO, body)


SQL["g8_financial_annual_yoy"] = _growth_sql("revenue", True, "yoy_growth")
SQL["g9_financial_quarterly_qoq"] = _growth_sql("revenue", False, "qoq_growth")
SQL["h6_growth_annual_net_income"] = _growth_sql("net_income", True, "yoy_growth")
SQL["h7_growth_quarterly_net_income"] = _growth_sql("net_income", False, "qoq_growth")


def _z(c: str) -> str:
    return f'coalesce("{c}", 0)'


METRICS = f"""ss AS (select * from snapshots
  qualify row_number() over (partition by symbol, metric_date order by load_id) = 1),
  sf AS (select *, {flag_sql(SR)} as is_critical from ss),
  metrics AS (select symbol, {_z('peTTM')} as pe_ttm, {_z('pb')} as pb, {_z('beta')} as beta,
       case when beta >= 1.5 then 'High volatility' when beta >= 0.5 then 'Above Market'
            else 'Low Volatility' end as risk_category,
       {_z('roeTTM')} * {D(0.30)} + {_z('roaTTM')} * {D(0.20)} + {_z('netProfitMarginTTM')} * {D(0.25)}
         + {_z('grossMarginTTM')} * {D(0.25)} as profitability_score,
       {_z('psTTM')} as ps_ttm, {_z('evEbitdaTTM')} as ev_ebitda_ttm, {_z('roeTTM')} as roe_ttm,
       {_z('roaTTM')} as roa_ttm, {_z('52WeekHigh')} as week52_high, {_z('52WeekLow')} as week52_low,
       {_z('52WeekPriceReturnDaily')} as return_52w, {_z('13WeekPriceReturnDaily')} as return_13w,
       {_z('26WeekPriceReturnDaily')} as return_26w, {_z('currentDividendYieldTTM')} as dividend_yield,
       {_z('grossMarginTTM')} as gross_margin_ttm, {_z('operatingMarginTTM')} as operating_margin_ttm,
       {_z('netProfitMarginTTM')} as net_profit_margin_ttm,
       {_z('marketCapitalization')} as market_capitalization, metric_date
  from sf where is_critical = false)"""

SQL["g5_fact_stock_metrics"] = with_(SNAPSHOTS, METRICS) + "select * from metrics"

ANALYST = f"""rf AS (select *, {flag_sql(RR)} as is_critical from ratings),
  rs AS (select symbol, period, "strongBuy" + buy + hold + sell + "strongSell" as total_analysts,
       "strongBuy", "strongBuy" * 2 + buy * 1 - sell * 1 - "strongSell" * 2 as raw_score
       from rf where is_critical = false),
  rb AS (select symbol, period, total_analysts, raw_score,
       round(3.0 + cast(raw_score as double) / nullif(cast(total_analysts as double), 0), 2) as bullish_score,
       round(cast("strongBuy" as double) / nullif(cast(total_analysts as double), 0) * 100, 2) as pct_strong_buy
       from rs),
  analyst AS (select *, case when bullish_score >= 4.5 then 'Strong buy' when bullish_score >= 3.5 then 'Buy'
       when bullish_score >= 2.5 then 'Hold' when bullish_score >= 1.5 then 'Sell'
       else 'Strong sell' end as consensus_label from rb)"""

SQL["g6_fact_analyst_signal"] = with_(RATINGS, ANALYST) + "select * from analyst"

EXCL = "[" + ", ".join(f"'{c}'" for c in R.G.B.EXCLUDED_CONDITIONS) + "]"


def _bars_sql(width: str) -> str:
    return with_(QUOTES, TRADES, SILVER_QUOTE) + f""",
  lq AS (select symbol as ref_symbol, previous_close_price from sq
         qualify row_number() over (partition by symbol order by event_timestamp desc, seq desc) = 1),
  st AS (select t.*, lq.previous_close_price from trades t left join lq on t.symbol = lq.ref_symbol),
  b AS (select symbol, time_bucket(interval '{width}', timestamp) as window_start,
       first(price order by timestamp, event_id) as open_price,
       last(price order by timestamp, event_id) as close_price,
       cast(sum(volume) as bigint) as volume,
       min(case when not list_has_any(conditions, {EXCL}) then price end) as low_price,
       max(case when not list_has_any(conditions, {EXCL}) then price end) as high_price,
       first(previous_close_price order by timestamp, event_id)
         filter (where previous_close_price is not null) as previous_close_price,
       count(symbol) as snapshot_count
  from st group by symbol, time_bucket(interval '{width}', timestamp))
select symbol, cast(window_start as date) as session_date, window_start,
       window_start + interval '{width}' as window_end,
       open_price, high_price, low_price, close_price, volume, previous_close_price, snapshot_count,
       close_price - previous_close_price as change,
       (close_price - previous_close_price) / nullif(previous_close_price, 0) * 100 as percent_change,
       high_price - low_price as intrawindow_spread,
       round((close_price - previous_close_price) / nullif(previous_close_price, 0) * 100, 4) as price_drift_pct,
       case when abs(round((close_price - previous_close_price) / nullif(previous_close_price, 0) * 100, 4)) > 3.0
            then true else false end as price_anomaly_flag
from b"""


SQL["g7_realtime_agg"] = _bars_sql("1 minute")
SQL["ag3_daily_bars"] = _bars_sql("1 day")


def _mean_sql(cols: Sequence[str]) -> str:
    s = " + ".join(f"coalesce({c}, {D(0.0)})" for c in cols)
    n = " + ".join(f"(case when {c} is null then 0 else 1 end)" for c in cols)
    return f"(case when ({n}) > 0 then ({s}) / ({n}) end)"


_MEASURES = ["return_52w", "percent_change", "profitability_score", "roe_ttm", "v_pe", "v_pb", "v_ev"]
_PR = ",\n       ".join(
    f"case when {m} is null then null else percent_rank() over "
    f"(partition by metric_date, ({m} is null) order by {m}) end as pr_{m}" for m in _MEASURES)

SCORECARD = f"""dq AS (select symbol, close_price, percent_change, candle_direction from daily
         qualify row_number() over (partition by symbol order by session_date desc, ingest_timestamp desc) = 1),
  an AS (select symbol, total_analysts, bullish_score, consensus_label from analyst
         qualify row_number() over (partition by symbol order by period desc) = 1),
  t AS (select d.symbol, d.name as company_name, d.exchange, d.industry, d.market_cap_category,
         dq.close_price, dq.percent_change, dq.candle_direction,
         an.total_analysts, an.bullish_score, an.consensus_label,
         m.pe_ttm, m.pb, m.ev_ebitda_ttm, m.roe_ttm, m.beta, m.return_52w, m.profitability_score,
         m.market_capitalization, m.metric_date,
         case when m.pe_ttm > 0 then m.pe_ttm end as v_pe,
         case when m.pb > 0 then m.pb end as v_pb,
         case when m.ev_ebitda_ttm > 0 then m.ev_ebitda_ttm end as v_ev
       from dim d left join dq on d.symbol = dq.symbol left join an on d.symbol = an.symbol
       left join metrics m on d.symbol = m.symbol),
  tp AS (select *, {_PR} from t),
  ts AS (select * exclude (v_pe, v_pb, v_ev, {", ".join("pr_" + m for m in _MEASURES)}),
       {_mean_sql(["pr_return_52w", "pr_percent_change"])} * {D(100.0)} as momentum_score,
       {_mean_sql(["pr_profitability_score", "pr_roe_ttm"])} * {D(100.0)} as quality_score,
       {_mean_sql([f"({D(1.0)} - pr_{v})" for v in ("v_pe", "v_pb", "v_ev")])} * {D(100.0)}
         as valuation_score,
       (bullish_score - {D(1.0)}) / {D(4.0)} * {D(100.0)} as analyst_score
       from tp),
  tc AS (select *, (coalesce(momentum_score, {D(50.0)}) + coalesce(quality_score, {D(50.0)})
         + coalesce(valuation_score, {D(50.0)}) + coalesce(analyst_score, {D(50.0)})) / {D(4.0)}
         as composite_score from ts)
select *,
       cast(rank() over (partition by metric_date, industry order by composite_score desc) as integer) as sector_rank,
       cast(rank() over (partition by metric_date order by composite_score desc) as integer) as overall_rank,
       case when composite_score >= 70.0 then 'A' when composite_score >= 40.0 then 'B' else 'C' end
         as investment_tier,
       metric_date is not distinct from max(metric_date) over (partition by symbol) as is_latest
from tc"""

SQL["g10_stock_scorecard"] = with_(
    PROFILES, PROFILE_FLAGGED + "," + PROFILE_HIST, DIM, CANDLES, QUOTES, GOLD_CANDLES,
    SILVER_QUOTE, DAILY, RATINGS, ANALYST, SNAPSHOTS, METRICS, SCORECARD)


_NAMES = "[" + ", ".join(f"'{c}'" for c in R.A._concept_names()) + "]"
FLAT = f"""flat AS (
  select cast(l_orderkey % 500 as varchar) as symbol,
         concat('CIK', cast(l_orderkey % 500 as varchar)) as cik,
         timestamp '2024-05-01 00:00:00' as ingest_timestamp,
         cast(l_orderkey as varchar) as "accessNumber",
         cast(1995 + l_orderkey % 30 as bigint) as year, cast(l_orderkey % 5 as bigint) as quarter,
         '2024-01-01' as "startDate", '2024-03-31' as "endDate", '2024-04-15' as "filedDate",
         case l_returnflag when 'A' then 'bs' when 'N' then 'ic' else 'cf' end as statement,
         {_NAMES}[((l_linenumber * 3 + case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end)
                   % {len(R.A._concept_names())}) + 1] as concept,
         'USD' as unit,
         case when l_linenumber = 7 and l_returnflag = 'R' then NULL else l_extendedprice end as value,
         case l_returnflag when 'A' then 3 when 'N' then 2 else 1 end as statement_priority
  from lineitem)"""
FL = f"(select *, concat('label ', concept) as label from flat)"
FIN_RULES = R.quality.load_rules("financials_reported")

SQL["e2_flatten_statements"] = with_(FLAT) + """
select symbol, cik, "accessNumber", year, quarter, statement, concept, value from flat"""

SILVER_FIN = f"""sfin AS (select * from {FL} fl where {flag_sql(FIN_RULES, 'fail')} = false
  qualify row_number() over (partition by symbol, cik, "accessNumber", year, quarter, concept
                             order by ingest_timestamp desc, statement_priority desc, value desc) = 1)"""

SQL["s4_silver_financials"] = with_(FLAT, SILVER_FIN) + "select * from sfin"

SQL["x3_quarantine_financials"] = with_(FLAT) + f"""
select symbol, "accessNumber", statement, concept, value,
       {flag_sql(FIN_RULES, 'fail')} as is_quarantined, {reason_sql(FIN_RULES, 'fail')} as quarantine_reason
from {FL} fl where {flag_sql(FIN_RULES, 'fail')} = true"""


def _pivot_cols_first(spec) -> str:
    out = []
    for name, concepts in spec.items():
        parts = [f"max(value) filter (where concept = '{c}')" for c in concepts]
        out.append(f"coalesce({', '.join(parts)}, {D(0)}) as {name}")
    return ",\n       ".join(out)


SQL["g4_financial_ratio_filings"] = with_(FLAT, SILVER_FIN) + f""",
  pv AS (select symbol, year, quarter, "startDate", "endDate", "filedDate", cik, "accessNumber",
       {_pivot_cols_first(R.G.FINANCIAL_CONCEPTS)}
  from sfin group by symbol, year, quarter, "startDate", "endDate", "filedDate", cik, "accessNumber"),
  {RATIO}
select * from ratio"""

SERIES = """series AS (
  select cast(l_orderkey as varchar) as symbol, 'eps' as metric_type,
         concat('P', cast(l_linenumber as varchar)) as period, l_extendedprice as v,
         timestamp '2024-05-01 00:00:00' as ingest_timestamp from lineitem
  union all
  select cast(l_orderkey as varchar), 'pe', concat('P', cast(l_linenumber as varchar)), l_quantity,
         timestamp '2024-05-01 00:00:00' from lineitem
  union all
  select cast(l_orderkey as varchar), 'roe', concat('P', cast(l_linenumber as varchar)), l_discount,
         timestamp '2024-05-01 00:00:00' from lineitem where l_returnflag != 'R')"""

MA_RULES = R.quality.load_rules("metric_annual")
SQL["e4_unpivot_series"] = with_(SERIES) + "select * from series"
SQL["s5_silver_metric_annual"] = with_(SERIES) + f"""
select *, {flag_sql(MA_RULES, 'fail')} as is_critical, {reason_sql(MA_RULES, 'fail')} as critical_reason
from series
qualify row_number() over (partition by symbol, metric_type, period order by ingest_timestamp desc, v desc) = 1"""


# ------------------------------------------------ silver from bronze shapes
QR_FAIL = f"{flag_sql(QR, 'fail')}"
BRONZE_QUOTES = """bq AS (
  select case when o_orderkey % 97 = 0 then NULL else cast(o_custkey % 100 as varchar) end as symbol,
         case when o_orderkey % 50 = 0 or o_orderkey % 89 = 0 then NULL else o_totalprice end as close_price,
         cast((o_orderkey % 5) - 2 as double) as change,
         cast((o_orderkey % 21) - 10 as double) as percent_change,
         o_totalprice * 2 as high_price, o_totalprice * 0.5 as low_price,
         o_totalprice - ((o_orderkey % 7) - 3) * 1000.0 as open_price,
         o_totalprice - ((o_orderkey % 5) - 2) * 2000.0 as previous_close_price,
         timezone('America/New_York', to_timestamp(epoch(o_orderdate) + (o_orderkey * 7919) % 86400))
           as event_timestamp,
         o_orderdate as ingest_timestamp
  from orders)"""

SQL["s1_silver_quote"] = with_(BRONZE_QUOTES) + f"select * from bq where {QR_FAIL} = false"
SQL["x1_quarantine_quote"] = with_(BRONZE_QUOTES) + f"""
select *, {QR_FAIL} as is_quarantine, {reason_sql(QR, 'fail')} as quarantine_reason
from bq where {QR_FAIL} = true"""

BRONZE_CANDLES = f"""bc AS (
  select cast(symbol as varchar) as symbol,
         case when symbol % 37 = 0 and month(date) = 1 then NULL else date end as date,
         open, high, close, low, volume, ingest_timestamp from candles)"""
SQL["s3_silver_candles"] = with_(CANDLES, BRONZE_CANDLES) + f"""
select * from bc where {flag_sql(CR, 'fail')} = false
qualify row_number() over (partition by symbol, date order by ingest_timestamp desc) = 1"""
SQL["x2_quarantine_candles"] = with_(CANDLES, BRONZE_CANDLES) + f"""
select *, {flag_sql(CR, 'fail')} as is_quarantined, {reason_sql(CR, 'fail')} as quarantine_reason
from bc where {flag_sql(CR, 'fail')} = true"""

SNAP_FIELDS = ['"marketCapitalization"', '"enterpriseValue"', "beta", '"peTTM"', "pb", '"roeTTM"',
               '"roaTTM"', '"netProfitMarginTTM"', '"grossMarginTTM"', '"psTTM"', '"evEbitdaTTM"',
               '"52WeekHigh"', '"52WeekLow"', '"52WeekPriceReturnDaily"', '"13WeekPriceReturnDaily"',
               '"26WeekPriceReturnDaily"', '"currentDividendYieldTTM"', '"operatingMarginTTM"']
SQL["s7_silver_metric_snapshot"] = with_(SNAPSHOTS) + f""",
  b AS (select {", ".join(SNAP_FIELDS)}, cast(symbol as varchar) as symbol,
        cast(timezone('America/New_York', to_timestamp(epoch(metric_date) + 43200)) as date) as metric_date,
        to_timestamp(1706745600 + load_id)::timestamp as ingest_timestamp
        from snapshots
        qualify row_number() over (partition by symbol, metric_date order by load_id) = 1)
select *, {flag_sql(SR, 'fail')} as is_critical, {reason_sql(SR, 'fail')} as critical_reason from b"""

SQL["s9_silver_recommendation"] = with_(RATINGS) + f""",
  b AS (select cast(symbol as varchar) as symbol, period, buy, sell, hold, "strongBuy", "strongSell",
        ingest_timestamp from ratings
        where not (symbol % 10 = 0 and month(cast(period as date)) = 2))
select *, {flag_sql(RR, 'fail')} as is_critical, {reason_sql(RR, 'fail')} as critical_reason,
       ingest_timestamp as "__START_AT", cast(NULL as timestamp) as "__END_AT" from b"""

SQL["k2_stream_bars"] = """
with t AS (select user_id as symbol, value as price,
           cast(json_extract_string(props, '$.k') as bigint) as volume,
           [event_type] as conditions, ts as timestamp, event_id from events),
  b AS (select symbol, time_bucket(interval '1 minute', timestamp) as window_start,
       first(price order by timestamp, event_id) as open_price,
       last(price order by timestamp, event_id) as close_price,
       cast(sum(volume) as bigint) as volume,
       min(case when not list_has_any(conditions, """ + EXCL + """) then price end) as low_price,
       max(case when not list_has_any(conditions, """ + EXCL + """) then price end) as high_price,
       count(symbol) as snapshot_count
  from t group by symbol, time_bucket(interval '1 minute', timestamp))
select symbol, cast(window_start as date) as session_date, window_start,
       window_start + interval '1 minute' as window_end,
       open_price, high_price, low_price, close_price, volume,
       cast(NULL as double) as previous_close_price, snapshot_count,
       cast(NULL as double) as change, cast(NULL as double) as percent_change,
       high_price - low_price as intrawindow_spread, cast(NULL as double) as price_drift_pct,
       false as price_anomaly_flag
from b where window_start + interval '1 minute' <= (select max(ts) from events) - interval '30 seconds'"""

SQL["k9_stream_scd2_change_log"] = SQL["d3_scd2_except_segmented"]
SQL["k9_latest_in_place"] = SQL["d1_scd1_latest"]
SQL["k9_history_in_place"] = SQL["d3_scd2_except_segmented"]
SQL["k8_stream_quote_branches"] = SQL["s1_silver_quote"]

SQL["k6_stream_enriched_bars"] = ("select * from (" + SQL["g7_realtime_agg"] + ") g "
    "where window_end <= (select max(ts) from events) - interval '30 seconds'")

SQL["s6_silver_metric_quarterly"] = f"""
with series AS (select cast(l_orderkey as varchar) as symbol, 'eps' as metric_type,
         concat('P', cast(l_linenumber as varchar)) as period, l_tax as v,
         timestamp '2024-05-01 00:00:00' as ingest_timestamp from lineitem)
select *, {flag_sql(R.quality.load_rules("metric_quarterly"), 'fail')} as is_critical,
       {reason_sql(R.quality.load_rules("metric_quarterly"), 'fail')} as critical_reason
from series
qualify row_number() over (partition by symbol, metric_type, period order by ingest_timestamp desc, v desc) = 1"""

SQL["a1_json_stream_rescue"] = """
select event_id, user_id, event_type, value, ['props', 'ts'] as rescued_keys,
       true as has_file_name, true as has_file_size
from events"""

SQL["a3_csv_stream_candles"] = with_(CANDLES) + """
select cast(symbol as varchar) as symbol, date, open, high, close, low, volume from candles"""

SQL["s2_silver_trades"] = with_(QUOTES, TRADES, SILVER_QUOTE) + """,
  lq AS (select symbol as ref_symbol, previous_close_price from sq
         qualify row_number() over (partition by symbol order by event_timestamp desc, seq desc) = 1)
select t.symbol, t.price, t.volume, t.conditions, t.timestamp, lq.previous_close_price
from trades t left join lq on t.symbol = lq.ref_symbol"""
SQL["a13_refresh_table"] = SQL["g5_fact_stock_metrics"]
SQL["a14_sql_view_analyst_signal"] = SQL["g6_fact_analyst_signal"]

SQL["c6_stream_observed_counts"] = with_(BRONZE_QUOTES) + "\nunion all\n".join(
    f"""select '{sev}' as severity, '{n}' as rule, cast(count_if(({s})) as bigint) as passed,
       cast(count_if(NOT ({s})) as bigint) as failed, cast(count_if(({s}) IS NULL) as bigint) as unknown
from bq""" for sev, n, s in QR.all_rules())


# ---------------------------------- rule counts of the other datasets, warn rules included
def counts_sql(source: str, rules: RuleSet) -> str:
    """Pass / fail / unknown counts of every rule over ``source`` (SQL text)."""
    def quoted(s: str) -> str:  # names that start with a digit
        return re.sub(r"\b(52Week\w+)", r'"\1"', s)
    return f"with src AS ({source})\n" + "\nunion all\n".join(
        f"""select '{sev}' as severity, '{n}' as rule, cast(count_if(({quoted(s)})) as bigint) as passed,
       cast(count_if(NOT ({quoted(s)})) as bigint) as failed, cast(count_if(({quoted(s)}) IS NULL) as bigint) as unknown
from src""" for sev, n, s in rules.all_rules())


_DAY = "timestamp '2024-05-01 00:00:00'"
SQL["c6_counts_profile"] = counts_sql(with_(PROFILES) + "select * from profile_changes", PR)
SQL["c6_counts_metric_snapshot"] = counts_sql(SQL["s7_silver_metric_snapshot"], SR)
SQL["c6_counts_recommendation"] = counts_sql(SQL["s9_silver_recommendation"], RR)
SQL["c6_counts_metric_annual"] = counts_sql(with_(SERIES) + "select * from series", MA_RULES)
SQL["c6_counts_metric_quarterly"] = counts_sql("""
  select cast(l_orderkey as varchar) as symbol, 'eps' as metric_type, concat('P', cast(l_linenumber as varchar)) as period,
         l_tax as v, timestamp '2024-05-01 00:00:00' as ingest_timestamp from lineitem""", R.quality.load_rules("metric_quarterly"))
SQL["c6_counts_financials"] = counts_sql(
    f"""select *, '2024-01-01' as "startDate", '2024-03-31' as "endDate", '2024-04-15' as "filedDate", {_DAY} as ingest_timestamp
        from ({SQL["e2_flatten_statements"]}) e""", R.quality.load_rules("financials_reported"))

_TRADE_ROWS = """
  dt AS (select cast(symbol as varchar) as symbol, price, volume, conditions,
                epoch_ms(epoch_us(timestamp) // 1000) as timestamp,
                cast(epoch_ms(epoch_us(timestamp) // 1000) as date) as session_date from trades),
  lq AS (select symbol as ref_symbol, previous_close_price from bq where """ + QR_FAIL + """ = false
         qualify row_number() over (partition by symbol order by event_timestamp desc, ingest_timestamp desc,
                                    previous_close_price desc) = 1),
  st AS (select dt.*, lq.previous_close_price from dt left join lq on dt.symbol = lq.ref_symbol)"""
ER = R.quality.load_rules("quote_eh")
SQL["s2_silver_trades_decoded"] = with_(TRADES, BRONZE_QUOTES, _TRADE_ROWS) + f"""
select *, {flag_sql(ER)} as is_critical, {reason_sql(ER)} as critical_reason from st"""
SQL["c6_counts_trades"] = counts_sql(with_(TRADES, BRONZE_QUOTES, _TRADE_ROWS) + f"select *, {_DAY} as ingest_timestamp from st", ER)
SQL["s8_silver_profile"] = with_(PROFILES, """
  pd AS (select country, currency, exchange, "finnhubIndustry", ipo, "marketCapitalization", "shareOutstanding",
                ticker, name, symbol, ingest_timestamp from profile_changes
         qualify row_number() over (partition by symbol, ingest_timestamp order by load_id desc) = 1),
  pf AS (select *, """ + flag_sql(PR, "fail") + " as is_critical, " + reason_sql(PR, "fail") + """ as critical_reason from pd),"""
    + scd2_sql("pf", ["symbol"], "ingest_timestamp",
               ["country", "currency", "exchange", '"finnhubIndustry"', "ipo", '"marketCapitalization"', '"shareOutstanding"',
                "ticker", "name", "is_critical", "critical_reason"],
               ["country", "currency", "exchange", '"finnhubIndustry"', "ipo", '"marketCapitalization"', '"shareOutstanding"',
                "ticker", "name", "symbol", "ingest_timestamp", "is_critical", "critical_reason"])) + "select * from hist"

SQL["a8_normalize_trades"] = with_(TRADES, """
  m AS (select cast(symbol as varchar) as symbol, price, volume, conditions,
               epoch_ms(epoch_us(timestamp) // 1000) as timestamp,
               cast(epoch_ms(epoch_us(timestamp) // 1000) as date) as session_date from trades where event_id % 10 <> 0)""") + """
select * from m union all select * from m"""
SQL["a2_nested_json_stream"] = SQL["e2_flatten_statements"]
SQL["a10_stream_table"] = with_(QUOTES) + "select seq, symbol, close_price, event_timestamp from quotes"
SQL["a11_read_table"] = "select o_orderkey, o_custkey, o_totalprice from orders"
SQL["k5_stream_dedup"] = "select distinct user_id, event_type from events"
SQL["c4_quarantine_quotes"] = with_(QUOTES) + f"""
select seq, symbol, close_price, {flag_sql(QR, 'fail')} as is_quarantined, {reason_sql(QR, 'fail')} as quarantine_reason
from quotes where {flag_sql(QR, 'fail')} = true"""
SQL["d1_scd1_tied"] = with_(CHANGES) + """
select *, cast(floor(seq / 1000) as bigint) as day from changes
qualify row_number() over (partition by symbol order by floor(seq / 1000) desc, amount desc, seq desc) = 1"""
SQL["k6_enrich_each_batch"] = SQL["s2_silver_trades"]
SQL["c1_judged_candles"] = SQL["c1_flag_candles"]
SQL["c6_counts_judged_quotes"] = counts_sql(with_(QUOTES) + "select * from quotes", QR)
SQL["a1_inferred"] = """
select event_id, user_id, event_type, case when event_id % 2 = 0 or event_id % 5 <> 0 then value end as value,
       event_id % 2 = 1 and event_id % 5 = 0 as is_text, case when event_id % 2 = 1 then event_id % 7 end as venue
from events"""
SQL["e4_variant_series"] = "select * exclude (ingest_timestamp) from (" + SQL["e4_unpivot_series"] + ") e"
SQL["k4_late_rows_corrected"] = SQL["k2_stream_bars"].replace("[event_type] as conditions", "['1'] as conditions").split("from b where window_start")[0] + "from b"
SQL["k4_late_rows_kept"] = """
with tops as (select event_id % 3 as part, max(ts) as top from events group by 1)
select event_id, user_id as symbol, value as price, ts as timestamp from events e
where time_bucket(interval '1 minute', ts) + interval '1 minute'
      <= (select max(top) from tops where part < e.event_id % 3) - interval '30 seconds'"""
SQL["k5_first_arrivals"] = """
select user_id, event_type, event_id, value from events
qualify row_number() over (partition by user_id, event_type order by event_id % 3, event_id) = 1"""
SQL["g4_incremental_refresh"] = SQL["g4_financial_ratio_filings"]
