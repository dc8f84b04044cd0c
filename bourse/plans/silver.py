"""Silver tables (S1-S9) and quarantine tables (X1-X3) from bronze shapes.

Each function takes the bronze DataFrame (batch, or streaming where the step
is stateless) and returns DataFrames; keyed steps (SCD1 / SCD2) take the
batch change log (see ``bourse.streaming.cdc`` for the streaming runner).
Pipelines quarantine rows whose critical rules are unknown (``null_policy =
"fail"``) unless told otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.functions.scalars import epoch_to_local, to_date_safe, to_number, utc_to_zone
from bourse.operators import cdc, quality, reshape
from bourse.operators.joins import enrich_latest
from bourse.sources.kafka import parse_trades

NEW_YORK = "America/New_York"


# ---------------------------------------------------------------- S1, X1
def typed_quote(bronze: DataFrame, zone: str = NEW_YORK) -> DataFrame:
    """Raw quote strings -> typed columns; unparsable numbers become NULL."""
    return bronze.select(
        F.col("symbol"),
        to_number("c").alias("close_price"), to_number("d").alias("change"),
        to_number("dp").alias("percent_change"), to_number("h").alias("high_price"),
        to_number("l").alias("low_price"), to_number("o").alias("open_price"),
        to_number("pc").alias("previous_close_price"),
        epoch_to_local(F.col("t"), zone).alias("event_timestamp"),
        F.col("ingest_timestamp"))


def quote_tables(bronze: DataFrame, null_policy: str = "fail") -> quality.Split:
    """S1 silver quote (valid), X1 quarantine quote, and the undecided rows."""
    rules = quality.load_rules("quote")
    f = quality.apply_rules(typed_quote(bronze), rules, "is_quarantine", "quarantine_reason",
                            null_policy)
    return quality.split(f, "is_quarantine", "quarantine_reason")


# ---------------------------------------------------------------------- S2
def silver_trades(bronze_eh: DataFrame, silver_quote: DataFrame, validate: bool = False) -> DataFrame:
    """Decoded Kafka rows -> typed trades with the latest quote's previous close."""
    t = parse_trades(bronze_eh)
    # quotes of one moment: the later load, then the greater value, so the result is the same on every run
    order = [c for c in ("event_timestamp", "ingest_timestamp", "previous_close_price") if c in silver_quote.columns]
    t = enrich_latest(t, silver_quote, "symbol", "symbol", order, ["previous_close_price"])
    t = t.withColumn("previous_close_price", F.col("previous_close_price").cast("double"))
    if validate:
        t = quality.apply_rules(t, quality.load_rules("quote_eh"), "is_critical", "critical_reason")
    return t


# ---------------------------------------------------------------- S3, X2
def typed_candles(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.col("symbol"), to_date_safe(F.col("date")).alias("date"),
        to_number("open").alias("open"), to_number("high").alias("high"),
        to_number("close").alias("close"), to_number("low").alias("low"),
        to_number("volume", "bigint").alias("volume"), F.col("ingest_timestamp"))


def candle_tables(bronze: DataFrame, null_policy: str = "fail") -> quality.Split:
    f = quality.apply_rules(typed_candles(bronze), quality.load_rules("stock_candles"),
                            null_policy=null_policy)
    return quality.split(f)


CANDLE_KEYS = ("symbol", "date")
PROFILE_KEYS = ("symbol",)
RECOMMENDATION_KEYS = ("symbol", "period")


def silver_candles(valid_log: DataFrame) -> DataFrame:
    """S3: latest candle per (symbol, date) by load time."""
    return cdc.scd1(valid_log, CANDLE_KEYS, "ingest_timestamp")


# ---------------------------------------------------------------- S4, X3
# FIXED VALUES: key columns of the published financials table.
FIN_TIES = ("statement_priority", "value")
# The key that tells most rows apart stands first: sorts then rarely compare a second one.
FIN_KEYS = ("accessNumber", "symbol", "cik", "year", "quarter", "concept")


def financial_items(bronze: DataFrame) -> DataFrame:
    """Filings -> one row per statement item (E2) with the statement priority
    (bs over ic over cf) used to break ties between copies of a concept."""
    items = reshape.flatten_statements(bronze, ["symbol", "cik", "ingest_timestamp"])
    prio = F.when(F.col("statement") == "bs", 3).when(F.col("statement") == "ic", 2).otherwise(1)
    return items.withColumn("statement_priority", prio)


def financial_tables(bronze: DataFrame, null_policy: str = "fail") -> quality.Split:
    f = quality.apply_rules(financial_items(bronze), quality.load_rules("financials_reported"),
                            null_policy=null_policy)
    return quality.split(f)


def silver_financials(valid_log: DataFrame, keys: Sequence[str] = FIN_KEYS) -> DataFrame:
    """One row per (filing, concept): latest load, then statement priority,
    then value.  Replaces a stateful first-arrival dedup, so a restated value
    does reach the table.  No exchange stands before the per-key limit, so a filing
    that is loaded again and again is cut to one row a concept in each map task."""
    return cdc.scd1(valid_log, list(keys), "ingest_timestamp", list(FIN_TIES))


# ---------------------------------------------------------------- S5, S6
def metric_series(bronze_metric: DataFrame, freq: str = "annual") -> DataFrame:
    """Series struct -> (symbol, metric_type, period, v, ingest_timestamp)."""
    s = bronze_metric.select("symbol", F.col(f"series.{freq}").alias("__s"), "ingest_timestamp")
    return reshape.unpivot_series(s, ["symbol", "ingest_timestamp"], "__s", "metric_type") \
        .select("symbol", "metric_type", "period", "v", "ingest_timestamp")


def flagged_metric_series(bronze_metric: DataFrame, freq: str = "annual",
                          null_policy: str = "fail") -> DataFrame:
    rules = quality.load_rules("metric_annual" if freq == "annual" else "metric_quarterly")
    return quality.apply_rules(metric_series(bronze_metric, freq), rules, "is_critical",
                               "critical_reason", null_policy)


def silver_metric_series(flagged_log: DataFrame,
                         keys: Sequence[str] = ("symbol", "metric_type", "period")) -> DataFrame:
    """Latest value per (symbol, metric_type, period)."""
    return cdc.scd1(flagged_log, list(keys), "ingest_timestamp", ["v"], keep_null_keys=True)


# ---------------------------------------------------------------------- S7
# FIXED VALUES: metric record fields read by the snapshot rules and the
# stock-metrics fact (names as the metric source spells them).
SNAPSHOT_FIELDS = ("marketCapitalization", "enterpriseValue", "beta", "peTTM", "pb", "psTTM",
                   "evEbitdaTTM", "roeTTM", "roaTTM", "netProfitMarginTTM", "grossMarginTTM",
                   "operatingMarginTTM", "currentDividendYieldTTM", "52WeekHigh", "52WeekLow",
                   "52WeekPriceReturnDaily", "13WeekPriceReturnDaily", "26WeekPriceReturnDaily")


def silver_metric_snapshot(bronze_metric: DataFrame, zone: str = NEW_YORK,
                           null_policy: str = "fail") -> DataFrame:
    """Flattened metric record, first load per (symbol, metric_date), flagged.
    Fields the rules and the fact read but the record lacks are NULL, as an
    explicit record schema would make them."""
    m = bronze_metric.select("metric.*", "symbol",
                             F.to_date(utc_to_zone(F.col("timestamp"), zone)).alias("metric_date"),
                             "ingest_timestamp", F.col("timestamp").alias("__at"))
    m = m.withColumns({c: F.lit(None).cast("double") for c in SNAPSHOT_FIELDS
                       if c not in m.columns})
    m = cdc.dedup_first(m, ["symbol", "metric_date"], None if m.isStreaming else ["ingest_timestamp", "__at"],
                        keep_null_keys=not m.isStreaming).drop("__at")
    return quality.apply_rules(m, quality.load_rules("metric_snapshot"), "is_critical",
                               "critical_reason", null_policy)


# ---------------------------------------------------------------------- S8
# FIXED VALUES: columns of the published profile table, in its order.
PROFILE_COLS = ("country", "currency", "exchange", "finnhubIndustry", "ipo", "marketCapitalization",
                "phone", "shareOutstanding", "ticker", "weburl", "name", "symbol",
                "estimateCurrency", "ingest_timestamp")


def flagged_profile(bronze: DataFrame, null_policy: str = "fail") -> DataFrame:
    p = bronze.withColumnRenamed("symbol_name", "symbol").withColumns({
        "marketCapitalization": to_number("marketCapitalization"),
        "shareOutstanding": to_number("shareOutstanding")})
    p = p.select(*[F.col(c) if c in p.columns else F.lit(None).cast("string").alias(c)
                   for c in PROFILE_COLS])
    return quality.apply_rules(p, quality.load_rules("profile"), "is_critical", "critical_reason",
                               null_policy)


def by_month(load_time: Column) -> Column:
    """Segments of a key's change log: one task holds a month of a key at most."""
    return F.date_trunc("month", load_time)


def silver_profile(flagged_log: DataFrame, segment=by_month) -> DataFrame:
    """Profile history per symbol; a reload changing only the load time
    opens no version."""
    return cdc.scd2(flagged_log, PROFILE_KEYS, "ingest_timestamp", except_cols=["ingest_timestamp"], segment=segment)


# ---------------------------------------------------------------------- S9
def flagged_recommendation(bronze: DataFrame, null_policy: str = "fail") -> DataFrame:
    r = bronze.select("symbol", F.explode("data").alias("d"), "ingest_timestamp")
    r = r.select("symbol", F.col("d.period").alias("period"),
                 *[to_number(f"d.{c}", "int").alias(c)
                   for c in ("buy", "sell", "hold", "strongBuy", "strongSell")],
                 "ingest_timestamp")
    return quality.apply_rules(r, quality.load_rules("recommendation"), "is_critical",
                               "critical_reason", null_policy)


def silver_recommendation(flagged_log: DataFrame, segment=by_month) -> DataFrame:
    """Recommendation history per (symbol, period)."""
    return cdc.scd2(flagged_log, RECOMMENDATION_KEYS, "ingest_timestamp",
                    except_cols=["ingest_timestamp"], segment=segment)
