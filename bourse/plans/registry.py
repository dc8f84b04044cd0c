"""Registered queries: one per operator / published table of the inventory.

Every query reads the driver tables of ``sf_dir`` (or DataFrames Spark derives
from them) in full.  ``bourse.plans.oracle`` holds the matching DuckDB SQL.
Names are ``<inventory id>_<slug>``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.functions.scalars import epoch_to_local
from bourse.operators import cdc, quality, reshape, windows
from bourse.operators.joins import enrich_latest
from bourse.operators.ranking import rank_within
from bourse.plans import analogs as A
from bourse.plans import gold as G
from bourse.plans import silver as SV
from bourse.sources import kafka, rescue

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


CANDLE_RULES = quality.load_rules("stock_candles")
QUOTE_RULES = quality.load_rules("quote")
PROFILE_RULES = quality.load_rules("profile")
SNAPSHOT_RULES = quality.load_rules("metric_snapshot")
REC_RULES = quality.load_rules("recommendation")

# Pivot spec of the line-item analog: output -> concepts in priority order.
ITEM_SPEC = {
    "revenue": ["R_F", "A_F"],
    "net_income": ["N_F", "N_O"],
    "operating_income": ["A_O", "R_O"],
    "total_debt": ["R_O"],
    "shareholders_equity": ["N_O", "A_F"],
    "current_assets": ["A_F"],
    "current_liabilities": ["R_F", "N_F"],
    "operating_cash_flow": ["N_O"],
    "capex": ["A_O"],
    "missing_concept": ["X_X"],
}
ITEM_KEYS = ["symbol", "year", "quarter"]


def BY_SEQ(s):
    """Segments of a whole-number sequence: a key's rows are spread over its ranges."""
    return F.floor(s / F.lit(50000))


def _flag_candles(spark, d):
    return quality.apply_rules(A.candles(spark, d), CANDLE_RULES)


# ---------------------------------------------------------------- quality (C)
@query("c1_flag_candles")
def c1(spark, d):
    f = _flag_candles(spark, d)
    return f.select("symbol", "date", "open", "close", "is_quarantined", "quarantine_reason")


@query("c3_valid_candles")
def c3(spark, d):
    return quality.split(_flag_candles(spark, d)).valid


@query("c4_quarantine_candles")
def c4(spark, d):
    return quality.split(_flag_candles(spark, d)).quarantine


@query("c5_undecided_candles")
def c5(spark, d):
    return quality.split(_flag_candles(spark, d)).undecided


@query("c6_expectation_counts")
def c6(spark, d):
    return quality.expectation_counts(A.candles(spark, d), CANDLE_RULES)


@query("c7_flag_keep_quotes")
def c7(spark, d):
    f = quality.apply_rules(A.quotes(spark, d), QUOTE_RULES, "is_critical", "critical_reason")
    return f.select("seq", "symbol", "close_price", "is_critical", "critical_reason")


@query("c1_flag_fail_policy_quotes")
def c1_fail(spark, d):
    f = quality.apply_rules(A.quotes(spark, d), QUOTE_RULES, null_policy="fail")
    return f.select("seq", "is_quarantined", "quarantine_reason")


# -------------------------------------------------------------------- CDC (D)
@query("d1_scd1_latest")
def d1(spark, d):
    return cdc.scd1(A.changes(spark, d), ["symbol"], "seq")


@query("d2_scd2_history")
def d2(spark, d):
    ch = A.changes(spark, d).select("symbol", "seq", "status")
    return cdc.scd2(ch, ["symbol"], "seq", segment=BY_SEQ)


@query("d3_scd2_except_segmented")
def d3(spark, d):
    ch = A.changes(spark, d).select("symbol", "seq", "status", "amount")
    return cdc.scd2(ch, ["symbol"], "seq", except_cols=["amount"],
                    segment=BY_SEQ)


@query("d4_dedup_first")
def d4(spark, d):
    return cdc.dedup_first(A.changes(spark, d), ["symbol", "status"], ["seq"])


# -------------------------------------------------------------- reshape (E)
@query("e1_explode_embeddings")
def e1(spark, d):
    e = A.read(spark, d, "embeddings")
    return reshape.explode_items(e, "embedding", "x", ["vec_id", "label"])


@query("e3_unpivot_candles")
def e3(spark, d):
    c = A.candles(spark, d).select("symbol", "date", "open", "high", "low", "close")
    return reshape.unpivot_columns(c, ["symbol", "date"], "metric", "value")


@query("e5_priority_pivot")
def e5(spark, d):
    return reshape.priority_pivot(A.items(spark, d), ITEM_KEYS, "concept", "value", ITEM_SPEC)


# ----------------------------------------------------------------- joins (F)
@query("f1_enrich_latest")
def f1(spark, d):
    ev = A.read(spark, d, "events")
    o = A.read(spark, d, "orders").withColumnRenamed("o_totalprice", "previous_close_price")
    return enrich_latest(ev, o, "user_id", "o_custkey", ["o_orderdate", "o_orderkey"],
                         ["previous_close_price"])


# --------------------------------------------------------------- windows (H)
@query("h1_lag_default")
def h1(spark, d):
    c = A.candles(spark, d).select("symbol", "date", "close")
    return windows.lag_default(c, "close", ["symbol"], ["date"], 0, out="previous_close_price",
                               segment=lambda c: F.trunc(c, "year"))


@query("h2_latest_per_key")
def h2(spark, d):
    o = A.read(spark, d, "orders")
    return windows.latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("h3_snapshot_latest")
def h3(spark, d):
    o = A.read(spark, d, "orders")
    return windows.snapshot_latest(o, "o_orderdate", grain="month")


@query("h4_earliest_per_key")
def h4(spark, d):
    o = A.read(spark, d, "orders")
    return windows.earliest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("h5_qualify_top2")
def h5(spark, d):
    from pyspark.sql import Window
    o = A.read(spark, d, "orders")
    w = Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey"))
    return windows.qualify(o, F.row_number().over(w), lambda c: c <= 2)


@query("h8_rank_within")
def h8(spark, d):
    c = A.read(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return rank_within(c, ["c_mktsegment"], "c_acctbal", out="segment_rank", desc=True,
                       pct_out="segment_pct_rank")


@query("h8_rank_overall")
def h8b(spark, d):
    c = A.read(spark, d, "customer").select("c_custkey", "c_acctbal")
    return rank_within(c, [], "c_acctbal", out="overall_rank", desc=True)


@query("h9_flag_latest")
def h9(spark, d):
    o = A.read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return windows.flag_latest(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


# ---------------------------------------------------------------- set ops (I)
@query("i2_union_by_name")
def i2(spark, d):
    c = A.candles(spark, d).select("symbol", F.col("date").alias("session_date"),
                                   F.col("close").alias("close_price"))
    q = A.quotes(spark, d).select("close_price", F.to_date("event_timestamp").alias("session_date"),
                                  "symbol")
    return c.unionByName(q)


# --------------------------------------------------------------- sources (A)
@query("a4_rescued_props")
def a4(spark, d):
    ev = A.read(spark, d, "events")
    schema = T.StructType([T.StructField("kind", T.StringType())])
    r = rescue.with_rescued(ev, "props", schema)
    return r.select("event_id", F.col("parsed.kind").alias("kind"), "_rescued_data")


def _kafka_rows(spark, d):
    ev = A.read(spark, d, "events")
    return ev.select(F.col("user_id").cast("string").cast("binary").alias("key"),
                     F.col("props").cast("binary").alias("value"),
                     F.lit("trades").alias("topic"),
                     (F.col("event_id") % 4).cast("int").alias("partition"),
                     F.col("event_id").alias("offset"),
                     F.col("ts").alias("timestamp"),
                     F.lit(0).alias("timestampType"))


@query("a7_decode_kafka")
def a7(spark, d):
    return kafka.decode_kafka(_kafka_rows(spark, d)).drop("key", "value")


@query("a9_kafka_payload")
def a9(spark, d):
    t = A.trades(spark, d).withColumn("ms", F.unix_millis(F.col("timestamp").cast("timestamp")))
    p = kafka.to_kafka_payload(t, "event_id", ["symbol", "price", "volume", "ms"],
                               rename={"ms": "timestamp"})
    return p


@query("j16_parse_trades")
def j16(spark, d):
    t = A.trades(spark, d).withColumn("ms", F.unix_millis(F.col("timestamp").cast("timestamp")))
    p = kafka.to_kafka_payload(t, "event_id", ["symbol", "price", "volume", "conditions", "ms"],
                               rename={"ms": "timestamp"})
    rows = p.select(F.col("key").alias("event_id"), F.col("value").alias("value_str"),
                    F.lit(None).cast("timestamp_ntz").alias("timestamp"))
    parsed = kafka.parse_trades(rows.withColumnRenamed("timestamp", "kafka_ts"),
                                ingest_col="kafka_ts")
    return parsed.select("symbol", "price", "volume", "conditions",
                         F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                         "session_date")


@query("j4_epoch_to_local")
def j4(spark, d):
    ev = A.read(spark, d, "events").select("event_id", "ts")
    secs = F.unix_seconds(F.col("ts").cast("timestamp"))
    return ev.select("event_id", secs.alias("epoch_s"),
                     epoch_to_local(secs).cast("timestamp_ntz").alias("event_timestamp"))


# ------------------------------------------------------------------ gold (G)
def silver_candles(spark, d):
    """S3: candles validated, valid branch, SCD1 on (symbol, date)."""
    valid = quality.split(_flag_candles(spark, d)).valid
    return cdc.scd1(valid, ["symbol", "date"], "ingest_timestamp")


def gold_candles(spark, d):
    return G.stock_candles(silver_candles(spark, d), segment=lambda c: F.trunc(c, "year"))


@query("g2_stock_candles")
def g2(spark, d):
    return gold_candles(spark, d)


def silver_quote(spark, d):
    """Quotes validated, valid branch."""
    return quality.split(quality.apply_rules(A.quotes(spark, d), QUOTE_RULES,
                                             "is_quarantine", "quarantine_reason"),
                         "is_quarantine", "quarantine_reason").valid


def gold_daily_quote(spark, d):
    return G.fact_daily_quote(silver_quote(spark, d), gold_candles(spark, d),
                              session=lambda c: F.trunc(F.to_date(c), "month"),
                              snapshot_grain="month", quote_tie="seq")


@query("g3_fact_daily_quote")
def g3(spark, d):
    return gold_daily_quote(spark, d)


def silver_profile(spark, d):
    """Profiles flagged (kept), SCD2 on symbol, load time not tracked."""
    p = quality.apply_rules(A.profile_changes(spark, d), PROFILE_RULES, "is_critical",
                            "critical_reason")
    return cdc.scd2(p, ["symbol"], "ingest_timestamp",
                    except_cols=["ingest_timestamp", "load_id"], tie_break=["load_id"], segment=SV.by_month)


def gold_dim(spark, d):
    return G.dim_company(silver_profile(spark, d))


@query("g1_dim_company")
def g1(spark, d):
    return gold_dim(spark, d)


@query("s8_silver_profile_history")
def s8(spark, d):
    return silver_profile(spark, d).select("symbol", "marketCapitalization", "is_critical",
                                           "ingest_timestamp", "load_id", "__START_AT", "__END_AT")


def ratio(spark, d):
    return G.financial_ratio(A.items(spark, d), ITEM_SPEC, ITEM_KEYS)


@query("g4_financial_ratio")
def g4(spark, d):
    return ratio(spark, d)


@query("g8_financial_annual_yoy")
def g8(spark, d):
    return G.financial_annual_yoy(ratio(spark, d), "revenue")


@query("g9_financial_quarterly_qoq")
def g9(spark, d):
    return G.financial_quarterly_qoq(ratio(spark, d), "revenue")


@query("h6_growth_annual_net_income")
def h6(spark, d):
    return G.financial_annual_yoy(ratio(spark, d), "net_income")


@query("h7_growth_quarterly_net_income")
def h7(spark, d):
    return G.financial_quarterly_qoq(ratio(spark, d), "net_income")


def silver_snapshot(spark, d):
    """First load per (symbol, metric_date), flagged (kept)."""
    s = cdc.dedup_first(A.snapshots(spark, d), ["symbol", "metric_date"], ["load_id"])
    return quality.apply_rules(s, SNAPSHOT_RULES, "is_critical", "critical_reason")


def gold_metrics(spark, d):
    return G.fact_stock_metrics(silver_snapshot(spark, d))


@query("g5_fact_stock_metrics")
def g5(spark, d):
    return gold_metrics(spark, d)


def silver_recommendation(spark, d):
    """Ratings flagged (kept), SCD2 on (symbol, period)."""
    r = quality.apply_rules(A.ratings(spark, d), REC_RULES, "is_critical", "critical_reason")
    return cdc.scd2(r, ["symbol", "period"], "ingest_timestamp", except_cols=["ingest_timestamp"], segment=SV.by_month)


def gold_analyst(spark, d):
    return G.fact_analyst_signal(silver_recommendation(spark, d))


@query("g6_fact_analyst_signal")
def g6(spark, d):
    return gold_analyst(spark, d)


def silver_trades(spark, d):
    """Trades enriched with the latest quote's previous close."""
    q = silver_quote(spark, d)
    return enrich_latest(A.trades(spark, d), q, "symbol", "symbol", ["event_timestamp", "seq"],
                         ["previous_close_price"])


@query("g7_realtime_agg")
def g7(spark, d):
    return G.realtime_agg(silver_trades(spark, d), "1 minute", tie_break="event_id")


@query("ag3_daily_bars")
def ag3(spark, d):
    return G.realtime_agg(silver_trades(spark, d), "1 day", tie_break="event_id")


@query("g10_stock_scorecard")
def g10(spark, d):
    return G.stock_scorecard(gold_dim(spark, d), gold_daily_quote(spark, d),
                             gold_analyst(spark, d), gold_metrics(spark, d))


# ------------------------------------------------ nested inputs

@query("e2_flatten_statements")
def e2(spark, d):
    items = SV.financial_items(A.filings(spark, d))
    return items.select("symbol", "cik", "accessNumber", "year", "quarter", "statement",
                        "concept", "value")


def silver_financials(spark, d):
    return SV.silver_financials(SV.financial_tables(A.filings(spark, d)).valid)


@query("s4_silver_financials")
def s4(spark, d):
    return silver_financials(spark, d)


@query("x3_quarantine_financials")
def x3(spark, d):
    q = SV.financial_tables(A.filings(spark, d)).quarantine
    return q.select("symbol", "accessNumber", "statement", "concept", "value", "is_quarantined",
                    "quarantine_reason")


@query("g4_financial_ratio_filings")
def g4f(spark, d):
    return G.financial_ratio(silver_financials(spark, d))


@query("e4_unpivot_series")
def e4(spark, d):
    return SV.metric_series(A.metric_bronze(spark, d), "annual")


@query("s5_silver_metric_annual")
def s5(spark, d):
    return SV.silver_metric_series(SV.flagged_metric_series(A.metric_bronze(spark, d), "annual"))


# ------------------------------------------ silver from bronze shapes
def _ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@query("s1_silver_quote")
def s1(spark, d):
    return _ntz(SV.quote_tables(A.bronze_quotes(spark, d)).valid, "event_timestamp")


@query("x1_quarantine_quote")
def x1(spark, d):
    return _ntz(SV.quote_tables(A.bronze_quotes(spark, d)).quarantine, "event_timestamp")


@query("s3_silver_candles")
def s3(spark, d):
    return SV.silver_candles(SV.candle_tables(A.bronze_candles(spark, d)).valid)


@query("x2_quarantine_candles")
def x2(spark, d):
    return SV.candle_tables(A.bronze_candles(spark, d)).quarantine


@query("s7_silver_metric_snapshot")
def s7(spark, d):
    return SV.silver_metric_snapshot(A.bronze_metric_snapshots(spark, d))


@query("s9_silver_recommendation")
def s9(spark, d):
    return SV.silver_recommendation(SV.flagged_recommendation(A.bronze_recommendations(spark, d)))


@query("k2_stream_bars")
def k2(spark, d):
    """Streaming 1-minute bars over the trades table read as a file stream:
    30 s watermark, append mode, drained with availableNow.  Returns the
    emitted (closed) windows."""
    from bourse.session import scratch_path
    from bourse.streaming.runners import run_append
    # the table is one file in the data folder: stream the folder, filtered to it
    ev = (spark.readStream.schema(A.read(spark, d, "events").schema)
          .option("pathGlobFilter", "events.parquet").parquet(d))
    t = ev.select(F.col("user_id").alias("symbol"), F.col("value").alias("price"),
                  F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
                  F.array(F.col("event_type")).alias("conditions"),
                  F.col("ts").cast("timestamp").alias("timestamp"), "event_id",
                  F.lit(None).cast("double").alias("previous_close_price"))
    out = G.realtime_agg(t, "1 minute", tie_break="event_id")
    path = scratch_path(spark, "k2_stream_bars")
    run_append(out, f"{path}/out", f"{path}/ck")
    return _ntz(spark.read.parquet(f"{path}/out"), "window_start", "window_end")


def _table_stream(spark, d, name):
    """A driver table read as a file stream (its folder, filtered to its file)."""
    return (spark.readStream.schema(A.read(spark, d, name).schema)
            .option("pathGlobFilter", f"{name}.parquet").parquet(d))


@query("k9_stream_scd2_change_log")
def k9(spark, d):
    """Keyed changes streamed into the change log (one folder per micro-batch),
    history derived from the log: equals the batch SCD2 of d3."""
    from bourse.session import scratch_path
    from bourse.streaming.cdc import scd2_stream
    o = _table_stream(spark, d, "orders")
    ch = o.select(F.col("o_custkey").alias("symbol"), F.col("o_orderkey").alias("seq"),
                  F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"))
    path = scratch_path(spark, "k9_scd2")
    history = scd2_stream(ch, ["symbol"], "seq", f"{path}/log", f"{path}/ck", except_cols=["amount"],
                          segment=BY_SEQ)
    return history()


def _in_two_batches(table, changes):
    """Merges the rows in two batches, so that half of them arrive late; returns the table."""
    for i in range(2):
        table.merge(changes.where(F.pmod(F.xxhash64("seq"), F.lit(2)) == i), i)
    return table.read(changes.schema)


@query("k9_latest_in_place")
def k9_latest(spark, d):
    """Newest row per key, merged batch by batch into hash buckets: equals d1."""
    from bourse.session import scratch_path
    from bourse.streaming.keyed import LatestTable
    return _in_two_batches(LatestTable(spark, scratch_path(spark, "k9_latest"), ["symbol"], "seq", buckets=16), A.changes(spark, d))


@query("k9_history_in_place")
def k9_history(spark, d):
    """History, repaired batch by batch around rows that arrive late: equals d3."""
    from bourse.session import scratch_path
    from bourse.streaming.keyed import HistoryTable
    table = HistoryTable(spark, scratch_path(spark, "k9_history"), ["symbol"], "seq", lambda s: F.floor(s / 100_000), except_cols=["amount"], buckets=4)
    return _in_two_batches(table, A.changes(spark, d).select("symbol", "seq", "status", "amount"))


@query("k8_stream_quote_branches")
def k8(spark, d):
    """Bronze quotes streamed once through the rules; valid and quarantine
    branches written from the same persisted micro-batch; returns silver."""
    from bourse.session import scratch_path
    from bourse.streaming.runners import read_branch, run_branches
    raw = A.bronze_quotes_from(_table_stream(spark, d, "orders"))
    rules = quality.load_rules("quote")
    flagged = quality.apply_rules(SV.typed_quote(raw), rules, "is_quarantine", "quarantine_reason",
                                  "fail")
    path = scratch_path(spark, "k8_quotes")
    run_branches(flagged, {
        "silver": lambda b: quality.split(b, "is_quarantine", "quarantine_reason").valid,
        "quarantine": lambda b: quality.split(b, "is_quarantine", "quarantine_reason").quarantine,
    }, path, f"{path}/_ck")
    return _ntz(read_branch(spark, path, "silver").drop("batch_id"), "event_timestamp")


@query("k6_stream_enriched_bars")
def k6(spark, d):
    """Trades streamed from the events table, each joined stream-static to the
    latest valid quote of its symbol (previous close), then 1-minute bars with
    a 30 s watermark in append mode.  Returns the closed windows."""
    from bourse.session import scratch_path
    from bourse.streaming.runners import run_append
    t = A.trades_from(_table_stream(spark, d, "events"))
    t = t.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    enriched = enrich_latest(t, silver_quote(spark, d), "symbol", "symbol",
                             ["event_timestamp", "seq"], ["previous_close_price"])
    path = scratch_path(spark, "k6_bars")
    run_append(G.realtime_agg(enriched, "1 minute", tie_break="event_id"), f"{path}/out", f"{path}/ck")
    return _ntz(spark.read.parquet(f"{path}/out"), "window_start", "window_end")


@query("s6_silver_metric_quarterly")
def s6(spark, d):
    return SV.silver_metric_series(SV.flagged_metric_series(A.metric_bronze(spark, d), "quarterly"))


@query("a1_json_stream_rescue")
def a1(spark, d):
    """Events written as JSON lines (several files) into the shared scratch
    folder, loaded by the incremental JSON source with a schema that lacks
    ``ts`` and ``props``: those land in ``_rescued_data``; lineage columns are
    added; each file is read once (a second run adds nothing)."""
    from bourse.session import scratch_path
    from bourse.sources.files import read_files_stream
    from bourse.streaming.runners import run_append
    ev = A.read(spark, d, "events").withColumn(
        "props", F.from_json("props", "map<string,bigint>"))
    path = scratch_path(spark, "a1_json")
    ev.repartition(4, "event_id").write.json(f"{path}/landing")
    schema = T.StructType([T.StructField("event_id", T.LongType()),
                           T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType()),
                           T.StructField("value", T.DoubleType())])
    s = read_files_stream(spark, f"{path}/landing", "json", schema=schema, rescue=True,
                          max_files_per_trigger=2)
    for _ in range(2):
        run_append(s, f"{path}/bronze", f"{path}/ck")
    b = spark.read.parquet(f"{path}/bronze")
    keys = F.array_sort(F.map_keys(F.from_json("_rescued_data", "map<string,string>")))
    return b.select("event_id", "user_id", "event_type", "value", keys.alias("rescued_keys"),
                    F.col("file_name").endswith(".json").alias("has_file_name"),
                    (F.col("file_size") > 0).alias("has_file_size"))


@query("a3_csv_stream_candles")
def a3(spark, d):
    """Candles written as CSV with a header, loaded by the incremental CSV
    source as all-text columns, then typed (the silver-candle cast list)."""
    from bourse.session import scratch_path
    from bourse.sources.files import read_files_stream
    from bourse.streaming.runners import run_append
    c = A.candles(spark, d).drop("ingest_timestamp")
    path = scratch_path(spark, "a3_csv")
    c.write.option("header", "true").csv(f"{path}/landing")
    s = read_files_stream(spark, f"{path}/landing", "csv")
    run_append(s, f"{path}/bronze", f"{path}/ck")
    return SV.typed_candles(spark.read.parquet(f"{path}/bronze")).drop("ingest_timestamp")


@query("s2_silver_trades")
def s2(spark, d):
    """Trades with the previous close of their symbol's latest valid quote."""
    return silver_trades(spark, d).drop("event_id")


@query("a13_refresh_table")
def a13(spark, d):
    """The metric fact written as a fully recomputed table (overwrite) in the
    shared folder, read back; a second refresh replaces, never appends."""
    from bourse.session import scratch_path
    from bourse.streaming.runners import run_refresh
    path = scratch_path(spark, "a13_refresh")
    for _ in range(2):
        run_refresh(gold_metrics(spark, d), path)
    return spark.read.parquet(path)


# The analyst-signal view as SQL text over temp views.
ANALYST_SIGNAL_SQL = """
WITH scored AS (
  SELECT symbol, period,
         strongBuy + buy + hold + sell + strongSell AS total_analysts,
         2 * strongBuy + buy - sell - 2 * strongSell AS raw_score,
         strongBuy
  FROM silver_recommendation
  WHERE is_critical = false AND __END_AT IS NULL
)
SELECT symbol, period, total_analysts, raw_score,
       round(3.0D + try_divide(CAST(raw_score AS DOUBLE), CAST(total_analysts AS DOUBLE)), 2)
         AS bullish_score,
       round(try_divide(CAST(strongBuy AS DOUBLE), CAST(total_analysts AS DOUBLE)) * 100, 2)
         AS pct_strong_buy,
       CASE {labels} ELSE '{other}' END AS consensus_label
FROM scored
""".format(labels=" ".join(f"WHEN bullish_score >= {t} THEN '{label}'" for t, label in G.CONSENSUS), other=G.CONSENSUS_ELSE)


@query("a14_sql_view_analyst_signal")
def a14(spark, d):
    from bourse.streaming.runners import run_sql_view, temp_view
    temp_view(silver_recommendation(spark, d), "silver_recommendation")
    return run_sql_view(spark, ANALYST_SIGNAL_SQL)


@query("c6_stream_observed_counts")
def c6s(spark, d):
    """Expectation counts of a stream: the quote rules counted in every
    micro-batch (rows are not filtered) into a table keyed by batch, summed."""
    from bourse.session import scratch_path
    from bourse.streaming.runners import read_expectations, run_expectations
    raw = A.bronze_quotes_from(_table_stream(spark, d, "orders"))
    path = scratch_path(spark, "c6_stream")
    run_expectations(SV.typed_quote(raw), quality.load_rules("quote"), f"{path}/counts", f"{path}/ck")
    return read_expectations(spark, f"{path}/counts")


# ------------------------------ critical and warn rules of the other datasets
@query("c6_counts_profile")
def c6_profile(spark, d):
    return quality.expectation_counts(A.profile_changes(spark, d), PROFILE_RULES)


@query("c6_counts_metric_snapshot")
def c6_snapshot(spark, d):
    return quality.expectation_counts(SV.silver_metric_snapshot(A.bronze_metric_snapshots(spark, d)),
                                      SNAPSHOT_RULES)


@query("c6_counts_recommendation")
def c6_recommendation(spark, d):
    return quality.expectation_counts(SV.flagged_recommendation(A.bronze_recommendations(spark, d)), REC_RULES)


@query("c6_counts_metric_annual")
def c6_annual(spark, d):
    return quality.expectation_counts(SV.metric_series(A.metric_bronze(spark, d), "annual"),
                                      quality.load_rules("metric_annual"))


@query("c6_counts_metric_quarterly")
def c6_quarterly(spark, d):
    return quality.expectation_counts(SV.metric_series(A.metric_bronze(spark, d), "quarterly"),
                                      quality.load_rules("metric_quarterly"))


@query("c6_counts_financials")
def c6_financials(spark, d):
    return quality.expectation_counts(SV.financial_items(A.filings(spark, d)),
                                      quality.load_rules("financials_reported"))


def _kafka_trades(spark, d):
    """Trades as decoded Kafka rows (the shape of the live bronze table)."""
    t = A.trades(spark, d).withColumn("ms", F.unix_millis(F.col("timestamp").cast("timestamp")))
    p = kafka.to_kafka_payload(t.withColumn("volume", F.col("volume").cast("double")), "event_id",
                               ["symbol", "price", "volume", "conditions", "ms"], rename={"ms": "timestamp"})
    return p.select(F.col("value").alias("value_str"), F.lit("2024-05-01").cast("timestamp").alias("timestamp"))


@query("s2_silver_trades_decoded")
def s2d(spark, d):
    """S2 from decoded Kafka rows: parsed (volumes written with a fraction), enriched, flagged."""
    q = SV.quote_tables(A.bronze_quotes(spark, d)).valid
    t = SV.silver_trades(_kafka_trades(spark, d), q, validate=True)
    return _ntz(t, "timestamp").drop("ingest_timestamp")


@query("c6_counts_trades")
def c6_trades(spark, d):
    q = SV.quote_tables(A.bronze_quotes(spark, d)).valid
    return quality.expectation_counts(SV.silver_trades(_kafka_trades(spark, d), q), quality.load_rules("quote_eh"))


@query("s8_silver_profile")
def s8p(spark, d):
    """S8 from bronze: one load per symbol and day, text numbers, flagged, SCD2."""
    p = windows.latest_per_key(A.profile_changes(spark, d), ["symbol", "ingest_timestamp"], ["load_id"])
    bronze = p.drop("load_id").withColumns({c: F.col(c).cast("string") for c in ("marketCapitalization", "shareOutstanding")})
    return SV.silver_profile(SV.flagged_profile(bronze)).drop("phone", "weburl", "estimateCurrency")


@query("a8_normalize_trades")
def a8(spark, d):
    """Trade envelopes (several trades a message, other message types between) -> published events -> parsed trades."""
    t = A.trades(spark, d)
    one = F.struct(F.col("symbol").cast("string").alias("s"), F.col("price").alias("p"), F.col("volume").cast("double").alias("v"),
                   F.col("conditions").alias("c"), F.unix_millis(F.col("timestamp").cast("timestamp")).alias("t"))
    kind = F.when(F.col("event_id") % 10 == 0, "ping").otherwise("trade")
    text = F.to_json(F.struct(kind.alias("type"), F.array(one, one).alias("data")))
    rows = kafka.normalize_trades(t.select(text.alias("value_str")))
    sent = kafka.to_kafka_payload(rows, "symbol", ["symbol", "price", "volume", "conditions", "timestamp"])
    got = kafka.parse_trades(sent.select(F.col("value").alias("value_str"), F.lit(None).cast("timestamp").alias("timestamp")))
    return _ntz(got, "timestamp").drop("ingest_timestamp")


@query("a2_nested_json_stream")
def a2(spark, d):
    """Filings landed as nested JSON, streamed with the explicit schema, flattened."""
    from bourse.plans.flows import FINANCIALS_SCHEMA
    from bourse.session import scratch_path
    from bourse.sources.files import read_files_stream
    from bourse.streaming.runners import run_append
    path = scratch_path(spark, "a2_json")
    A.filings(spark, d).drop("ingest_timestamp").write.json(f"{path}/landing")
    run_append(read_files_stream(spark, f"{path}/landing", "json", schema=FINANCIALS_SCHEMA), f"{path}/bronze", f"{path}/ck")
    items = SV.financial_items(spark.read.parquet(f"{path}/bronze"))
    return items.select("symbol", "cik", "accessNumber", "year", "quarter", "statement", "concept", "value")


@query("a10_stream_table")
def a10(spark, d):
    """An append-only table of quotes read as a stream, by path."""
    from bourse.session import scratch_path
    from bourse.sources.files import stream_table
    from bourse.streaming.runners import run_append
    path = scratch_path(spark, "a10_table")
    A.quotes(spark, d).write.parquet(f"{path}/table")
    run_append(stream_table(spark, f"{path}/table"), f"{path}/out", f"{path}/ck")
    return spark.read.parquet(f"{path}/out").select("seq", "symbol", "close_price", "event_timestamp")


@query("a11_read_table")
def a11(spark, d):
    from bourse.sources.files import read_table
    return read_table(spark, f"{d}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")


@query("k5_stream_dedup")
def k5(spark, d):
    """First row per (user, event type) of a stream; the keys that came through, once each."""
    from bourse.session import scratch_path
    from bourse.streaming.runners import run_append
    path = scratch_path(spark, "k5_dedup")
    run_append(cdc.dedup_first(_table_stream(spark, d, "events"), ["user_id", "event_type"]), f"{path}/out", f"{path}/ck")
    return spark.read.parquet(f"{path}/out").select("user_id", "event_type")


@query("c4_quarantine_quotes")
def c4q(spark, d):
    f = quality.apply_rules(A.quotes(spark, d), QUOTE_RULES, null_policy="fail")
    return quality.split(f).quarantine.select("seq", "symbol", "close_price", "is_quarantined", "quarantine_reason")


@query("d1_scd1_tied")
def d1t(spark, d):
    """Many changes of one key share a sequence (the day): the greatest tie-break is kept."""
    return cdc.scd1(A.changes(spark, d).withColumn("day", F.floor(F.col("seq") / 1000)), ["symbol"], "day", ["amount", "seq"])


@query("k6_enrich_each_batch")
def k6b(spark, d):
    """Trades streamed in, each micro-batch joined to the reference as it is then (reloaded per batch)."""
    from bourse.session import scratch_path
    from bourse.streaming.runners import run_each
    t = A.trades_from(_table_stream(spark, d, "events"))
    path = scratch_path(spark, "k6_each")
    run_each(t, lambda b: enrich_latest(b, silver_quote(spark, d), "symbol", "symbol", ["event_timestamp", "seq"],
                                        ["previous_close_price"]), f"{path}/out", f"{path}/ck")
    return spark.read.parquet(f"{path}/out").drop("batch_id", "event_id")


# ------------------------------------------------- one evaluation per rule
@query("c1_judged_candles")
def c1_judged(spark, d):
    """Flag and reason read from the bits of one evaluation per rule: equals c1."""
    judged = quality.judge(A.candles(spark, d), CANDLE_RULES)
    return quality.apply_verdicts(judged, CANDLE_RULES).select("symbol", "date", "open", "close", "is_quarantined", "quarantine_reason")


@query("c6_counts_judged_quotes")
def c6_judged(spark, d):
    """Counts read from the bits of one evaluation per rule."""
    return quality.verdict_counts(quality.judge(A.quotes(spark, d), QUOTE_RULES), QUOTE_RULES)


# ---------------------------------------------------------------- VARIANT sources
@query("a1_inferred")
def a1_inferred(spark, d):
    """Events landed as JSON without a schema, in two loads: the second writes some values as text and has a new
    field.  Bronze keeps both whole, the kept schema widens, and the table is read through it."""
    from bourse.session import scratch_path
    from bourse.sources import variants
    from bourse.streaming.runners import run_append
    path = scratch_path(spark, "a1_inferred")
    ev = A.read(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    odd = ev.where("event_id % 2 = 1")
    text = odd.where("event_id % 5 = 0").withColumn("value", F.concat(F.lit("about "), F.col("value").cast("string")))
    loads = [[ev.where("event_id % 2 = 0")], [x.withColumn("venue", F.col("event_id") % 7) for x in (odd.where("event_id % 5 <> 0"), text)]]
    for load in loads:
        for part in load:
            part.write.mode("append").json(f"{path}/landing")
        run_append(variants.read_variant_stream(spark, f"{path}/landing"), f"{path}/bronze", f"{path}/ck")
        bronze = spark.read.parquet(f"{path}/bronze")
        schema = variants.evolve(spark, variants.schema_of_records(bronze), f"{path}/schema")
    t = variants.typed(bronze, schema)
    number = F.try_variant_get(F.col("value"), "$", "double") if schema["value"].dataType == T.VariantType() else F.col("value")
    return t.select("event_id", "user_id", "event_type", number.alias("value"), (number.isNull() & F.col("value").isNotNull()).alias("is_text"), "venue")


@query("e4_variant_series")
def e4_variant(spark, d):
    """Every metric series of the records, found in each record itself: equals e4 without a list of metrics."""
    from bourse.sources.variants import unpivot_variant
    m = A.metric_bronze(spark, d).select("symbol", F.parse_json(F.to_json("series.annual")).alias("annual"))
    return unpivot_variant(m, ["symbol"], "annual", {"period": "string", "v": "double"})


# ------------------------------------------------- late rows and first arrivals
def _late_bars(spark, d, name):
    """Trades in three batches, each over the whole time range, so most of the second and third come late."""
    from bourse.session import scratch_path
    from bourse.streaming.late import BarTable
    t = A.trades(spark, d).withColumns({"timestamp": F.col("timestamp").cast("timestamp"), "conditions": F.array(F.lit("1")),
                                        "previous_close_price": F.lit(None).cast("double")})
    table = BarTable(spark, scratch_path(spark, name), t.schema, tie_break="event_id")
    for i in range(3):
        table.merge(t.where(F.pmod("event_id", F.lit(3)) == i), i)
    return table


@query("k4_late_rows_corrected")
def k4_corrected(spark, d):
    """Bars of all windows, late rows put in: equals the bars of one batch."""
    return _ntz(_late_bars(spark, d, "k4_corrected").bars(open_too=True, corrected=True), "window_start", "window_end")


@query("k4_late_rows_kept")
def k4_late(spark, d):
    """The side table: rows whose window was closed when they came."""
    return _ntz(_late_bars(spark, d, "k4_late").late().select("event_id", "symbol", "price", "timestamp"), "timestamp")


@query("k5_first_arrivals")
def k5_first(spark, d):
    """First row per (user, event type) over three batches, seen keys kept in a table and not in a stream's state."""
    from bourse.session import scratch_path
    from bourse.streaming.arrivals import FirstArrivals
    ev = A.read(spark, d, "events").select("user_id", "event_type", "event_id", "value")
    store = FirstArrivals(spark, scratch_path(spark, "k5_first"), ["user_id", "event_type"], ["event_id"], buckets=16)
    for i in range(3):
        store.merge(ev.where(F.pmod("event_id", F.lit(3)) == i), i)
    return store.read(ev.schema)


@query("g4_incremental_refresh")
def g4_incremental(spark, d):
    """Ratios kept in place: filings come in two batches, each refreshes the buckets it touches; equals the full refresh.

    The batches land as files, so that the filings are put together once."""
    from bourse.session import scratch_path
    from bourse.streaming.keyed import DerivedTable, LatestTable
    valid = SV.financial_tables(A.filings(spark, d)).valid
    path = scratch_path(spark, "g4_incremental")
    silver = LatestTable(spark, f"{path}/silver", SV.FIN_KEYS, "ingest_timestamp", SV.FIN_TIES, buckets=16, by=["symbol"])
    ratio = DerivedTable(silver, f"{path}/ratio", G.financial_ratio)
    valid.write.parquet(f"{path}/landed")
    landed = spark.read.schema(valid.schema).parquet(f"{path}/landed")
    for i in range(2):
        silver.merge(landed.where(F.pmod(F.xxhash64("accessNumber"), F.lit(2)) == i), i)
        ratio.refresh(valid.schema, i)
    return ratio.read(valid.schema)
