"""End-to-end flows: landing files -> bronze -> silver / quarantine -> gold.

Each flow is a few runner calls over the library's functions, with every table
a Parquet path under ``root`` and every stream checkpointed under
``root/_checkpoints``.  Streams run with ``availableNow`` (drain what has
landed, then stop), so a flow can be scheduled like a batch job and re-run
safely: files are read once, micro-batch outputs are keyed by batch id, and
the keyed tables are recomputed from their change logs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bourse.operators import quality
from bourse.plans import gold as G
from bourse.plans import silver as S
from bourse.operators.cdc import unplaced
from bourse.sources.files import read_files_stream, stored_schema, stream_table
from bourse.streaming import runners
from bourse.streaming.cdc import read_change_log
from bourse.streaming.keyed import DerivedTable, HistoryTable, LatestTable, merge_stream
from bourse.streaming.late import BarTable


@dataclass(frozen=True)
class Layout:
    root: str

    def table(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def ckpt(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"


#: Files that one micro-batch takes at most: bounds the first batch of a backlog, which a branching stream persists.
FILES_PER_BATCH = 1000


def _bronze(spark: SparkSession, landing: str, lay: Layout, name: str, fmt: str, **kw) -> DataFrame:
    """Landing files -> the append-only bronze table; returns a stream over that table."""
    runners.make_folder(spark, landing)
    files = read_files_stream(spark, landing, fmt, max_files_per_trigger=FILES_PER_BATCH, **kw)
    runners.run_append(files, lay.table("bronze", name), lay.ckpt(f"bronze_{name}"))
    runners.make_folder(spark, lay.table("bronze", name))
    return stream_table(spark, lay.table("bronze", name), files.schema, max_files_per_trigger=FILES_PER_BATCH)


def _landed(spark: SparkSession, landing: str, lay: Layout, name: str, fallback: T.StructType | None = None, numbers: bool = False) -> DataFrame:
    """``_bronze`` of a JSON source without a schema of its own: the first load's is kept, all else is rescued."""
    schema = stored_schema(spark, landing, f"{lay.root}/_schemas/{name}", numbers, fallback)
    return _bronze(spark, landing, lay, name, "json", schema=schema, rescue=True)


def _counted(dataset: str):
    """A branch that counts every rule of a dataset, critical and warn, per micro-batch."""
    rules = quality.load_rules(dataset)
    return lambda batch: quality.expectation_counts(batch, rules)


def _judged(rules: quality.RuleSet, flag: str, reason: str, null_policy: str, valid: str, bad: str):
    """(valid, bad and counting branches) of a judged stream: all read the bits of the persisted micro-batch, no rule runs again."""
    def flagged(batch: DataFrame) -> quality.Split:
        return quality.split(quality.apply_verdicts(batch, rules, flag, reason, null_policy), flag, reason)
    return {valid: lambda b: flagged(b).valid, bad: lambda b: flagged(b).quarantine,
            "expectations": lambda b: quality.verdict_counts(b, rules)}


def expectations(spark: SparkSession, lay: Layout, base: str) -> DataFrame:
    """Counts per rule over all micro-batches of a branching stream."""
    return runners.read_expectations(spark, f"{lay.table('silver', base)}/expectations")


QUOTE_FIELDS = ("symbol", "c", "d", "dp", "h", "l", "o", "pc", "t")
QUOTE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in QUOTE_FIELDS])


def quote_flow(spark: SparkSession, landing: str, lay: Layout,
               null_policy: str = "fail") -> dict[str, DataFrame]:
    """Quote JSON -> bronze (lineage + rescue) -> silver quote / quarantine."""
    src = _bronze(spark, landing, lay, "quote", "json", schema=QUOTE_SCHEMA, rescue=True)

    # every rule evaluated once on the stream; each persisted micro-batch feeds all tables
    rules = quality.load_rules("quote")
    runners.run_branches(quality.judge(S.typed_quote(src), rules),
                         _judged(rules, "is_quarantine", "quarantine_reason", null_policy, "silver_quote", "quarantine_quote"),
                         lay.table("silver", "quote_branches"), lay.ckpt("silver_quote"))
    base = lay.table("silver", "quote_branches")
    return {"silver_quote": runners.read_branch(spark, base, "silver_quote").drop("batch_id"),
            "quarantine_quote": runners.read_branch(spark, base, "quarantine_quote").drop("batch_id")}


def candle_flow(spark: SparkSession, landing: str, lay: Layout,
                null_policy: str = "fail") -> dict[str, DataFrame]:
    """Candle CSV -> bronze -> valid change log + quarantine -> silver (SCD1)
    -> gold candles with previous close (refreshed)."""
    src = _bronze(spark, landing, lay, "candles", "csv", rescue=True)
    table = LatestTable(spark, lay.table("silver", "candles"), S.CANDLE_KEYS, "ingest_timestamp")
    # CSV headers are capitalised; the typed columns are lower case
    lower = {c: c.lower() for c in src.columns}
    rules = quality.load_rules("stock_candles")
    branches = _judged(rules, "is_quarantined", "quarantine_reason", null_policy, "valid_log", "quarantine_candles")
    runners.run_branches(quality.judge(S.typed_candles(src.withColumnsRenamed(lower)), rules), branches,
                         lay.table("silver", "candle_branches"), lay.ckpt("silver_candles"),
                         merges=[lambda x, i: table.merge(branches["valid_log"](x), i)])
    base = lay.table("silver", "candle_branches")
    silver = table.read(read_change_log(spark, f"{base}/valid_log").schema)
    gold = G.stock_candles(silver)
    runners.run_refresh(gold, lay.table("gold", "stock_candles"))
    return {"silver_candles": silver,
            "quarantine_candles": runners.read_branch(spark, base, "quarantine_candles")
            .drop("batch_id"),
            "gold_stock_candles": spark.read.parquet(lay.table("gold", "stock_candles"))}


def _published(spark: SparkSession, lay: Layout, name: str, table: DataFrame) -> DataFrame:
    """The table of a change log, written out."""
    runners.run_refresh(table, lay.table("silver", name))
    return spark.read.parquet(lay.table("silver", name))


def _history(spark: SparkSession, lay: Layout, name: str, keys) -> HistoryTable:
    """A history by load time, kept in place: a batch rewrites the months and buckets that it touches."""
    return HistoryTable(spark, lay.table("silver", name), keys, "ingest_timestamp", S.by_month, except_cols=["ingest_timestamp"])


def daily_quote_flow(spark: SparkSession, lay: Layout, silver_quote: DataFrame,
                     gold_candles: DataFrame) -> DataFrame:
    """Gold daily quote fact, fully refreshed from its two inputs."""
    runners.run_refresh(G.fact_daily_quote(silver_quote, gold_candles),
                        lay.table("gold", "fact_daily_quote"))
    return spark.read.parquet(lay.table("gold", "fact_daily_quote"))


def _texts(names) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


# Schemas of sources without one, for a start before anything has landed.
PROFILE_SCHEMA = _texts(c for c in S.PROFILE_COLS if c != "ingest_timestamp")
RECOMMENDATION_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("data", T.ArrayType(_texts(("period", "buy", "sell", "hold", "strongBuy", "strongSell"))))])
_SERIES = T.StructType([T.StructField("eps", T.ArrayType(T.StructType([T.StructField("period", T.StringType()), T.StructField("v", T.DoubleType())])))])
METRIC_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("timestamp", T.StringType()),
    T.StructField("metric", T.StructType([T.StructField(c, T.DoubleType()) for c in S.SNAPSHOT_FIELDS])),
    T.StructField("series", T.StructType([T.StructField("annual", _SERIES), T.StructField("quarterly", _SERIES)]))])


def profile_flow(spark: SparkSession, landing: str, lay: Layout) -> dict[str, DataFrame]:
    """Profile JSON -> bronze -> flagged change log -> history (SCD2), rows that no
    history can place -> dim."""
    src = _landed(spark, landing, lay, "profile", PROFILE_SCHEMA)
    base = lay.table("silver", "profile_branches")
    table = _history(spark, lay, "profile", S.PROFILE_KEYS)
    runners.run_branches(S.flagged_profile(src), {"log": lambda b: b, "expectations": _counted("profile")}, base, lay.ckpt("silver_profile"),
                         merges=[table.merge])
    log = read_change_log(spark, f"{base}/log")
    history = table.read(log.schema)
    _published(spark, lay, "profile_unplaced", unplaced(log, ["symbol"], "ingest_timestamp"))
    runners.run_refresh(G.dim_company(history), lay.table("gold", "dim_company"))
    return {"silver_profile": history,
            "gold_dim_company": spark.read.parquet(lay.table("gold", "dim_company"))}


def recommendation_flow(spark: SparkSession, landing: str, lay: Layout) -> dict[str, DataFrame]:
    """Recommendation JSON -> flagged rows (kept) in a change log -> history
    (SCD2 per symbol and period) -> analyst signal (refreshed)."""
    src = _landed(spark, landing, lay, "recommendation", RECOMMENDATION_SCHEMA)
    base = lay.table("silver", "recommendation_branches")
    table = _history(spark, lay, "recommendation", S.RECOMMENDATION_KEYS)
    runners.run_branches(S.flagged_recommendation(src), {"log": lambda b: b, "expectations": _counted("recommendation")}, base,
                         lay.ckpt("silver_recommendation"), merges=[table.merge])
    log = read_change_log(spark, f"{base}/log")
    history = table.read(log.schema)
    _published(spark, lay, "recommendation_unplaced", unplaced(log, ["symbol", "period"], "ingest_timestamp"))
    runners.run_refresh(G.fact_analyst_signal(history), lay.table("gold", "fact_analyst_signal"))
    return {"silver_recommendation": history,
            "gold_fact_analyst_signal": spark.read.parquet(lay.table("gold", "fact_analyst_signal"))}


_ITEM = T.StructType([T.StructField(c, T.StringType()) for c in ("concept", "label", "unit", "value")])
FINANCIALS_SCHEMA = T.StructType([
    T.StructField("cik", T.StringType()), T.StructField("symbol", T.StringType()),
    T.StructField("data", T.ArrayType(T.StructType(
        [T.StructField(c, T.StringType()) for c in ("acceptedDate", "accessNumber", "cik", "endDate",
                                                     "filedDate", "form")]
        + [T.StructField("quarter", T.LongType()),
           T.StructField("report", T.StructType([T.StructField(s, T.ArrayType(_ITEM))
                                                 for s in ("bs", "cf", "ic")])),
           T.StructField("startDate", T.StringType()), T.StructField("symbol", T.StringType()),
           T.StructField("year", T.LongType())]))),
])


def financials_flow(spark: SparkSession, landing: str, lay: Layout) -> dict[str, DataFrame]:
    """Reported-financials JSON (explicit nested schema) -> one-pass flatten ->
    valid change log + quarantine -> silver (SCD1 per filing and concept) ->
    ratios, annual and quarterly growth (all kept in place, refreshed where filings came)."""
    src = _bronze(spark, landing, lay, "financials", "json", schema=FINANCIALS_SCHEMA, rescue=True)
    rules = quality.load_rules("financials_reported")
    base = lay.table("silver", "financial_branches")
    branches = _judged(rules, "is_quarantined", "quarantine_reason", "fail", "valid_log", "quarantine_financials")
    # in buckets of symbols: ratios and growth of a symbol follow from its bucket, so a filing refreshes one bucket of each
    table = LatestTable(spark, lay.table("silver", "financials"), S.FIN_KEYS, "ingest_timestamp", S.FIN_TIES, by=["symbol"])
    gold = {name: DerivedTable(table, lay.table("gold", name), fn) for name, fn in (
        ("financial_ratio", G.financial_ratio),
        ("financial_annual_yoy", lambda r: G.financial_annual_yoy(G.financial_ratio(r))),
        ("financial_quarterly_qoq", lambda r: G.financial_quarterly_qoq(G.financial_ratio(r))))}

    def merge(batch: DataFrame, batch_id: int) -> None:
        valid = branches["valid_log"](batch)
        table.merge(valid, batch_id)
        for t in gold.values():
            t.refresh(valid.schema, batch_id)
    runners.run_branches(quality.judge(S.financial_items(src), rules), branches, base, lay.ckpt("silver_financials"), merges=[merge])
    kind = read_change_log(spark, f"{base}/valid_log").schema
    return {"silver_financials": table.read(kind),
            "quarantine_financials": runners.read_branch(spark, base, "quarantine_financials").drop("batch_id"),
            **{f"gold_{name}": t.read(kind) for name, t in gold.items()}}


def metric_flow(spark: SparkSession, landing: str, lay: Layout,
                schema: T.StructType | None = None) -> dict[str, DataFrame]:
    """Metric JSON -> snapshot (first load per symbol and day, flagged) and
    annual / quarterly series (change logs, SCD1) -> stock metrics fact.
    ``schema`` is the metric record schema; inferred from the landed files
    by the first load when not given."""
    if schema is None:
        src = _landed(spark, landing, lay, "metric", METRIC_SCHEMA, numbers=True)
    else:
        src = _bronze(spark, landing, lay, "metric", "json", schema=schema, rescue=True)
    batch = spark.read.schema(src.schema).parquet(lay.table("bronze", "metric"))
    # first load per (symbol, metric day) is a property of all loads: computed on the table
    snap = S.silver_metric_snapshot(batch)
    runners.run_refresh(snap, lay.table("silver", "metric_snapshot"))
    runners.run_refresh(_counted("metric_snapshot")(spark.read.parquet(lay.table("silver", "metric_snapshot"))),
                        f"{lay.table('silver', 'metric_snapshot_branches')}/expectations")
    out = {"silver_metric_snapshot": spark.read.parquet(lay.table("silver", "metric_snapshot"))}
    for freq in ("annual", "quarterly"):
        base = lay.table("silver", f"metric_{freq}_branches")
        runners.run_branches(S.flagged_metric_series(src, freq), {"log": lambda b: b, "expectations": _counted(f"metric_{freq}")},
                             base, lay.ckpt(f"silver_metric_{freq}"))
        out[f"silver_metric_{freq}"] = _published(spark, lay, f"metric_{freq}", S.silver_metric_series(read_change_log(spark, f"{base}/log")))
    runners.run_refresh(G.fact_stock_metrics(out["silver_metric_snapshot"]),
                        lay.table("gold", "fact_stock_metrics"))
    out["gold_fact_stock_metrics"] = spark.read.parquet(lay.table("gold", "fact_stock_metrics"))
    return out


def trades_flow(spark: SparkSession, kafka_rows: DataFrame, lay: Layout,
                silver_quote, width: str = "1 minute",
                watermark: str = "30 seconds", keep_late: bool = False) -> dict[str, DataFrame]:
    """Kafka rows (a ``kafka_source`` stream, or any stream with the Kafka row
    schema) -> decoded bronze -> silver trades (previous close) -> watermarked
    bars (append).  ``silver_quote`` is a DataFrame or a function that gives one,
    which is then called for each micro-batch, so quotes that arrived since count.
    ``keep_late``: bars are kept in parts, rows behind the watermark go to a table of their own and into corrected bars."""
    from bourse.sources.kafka import decode_kafka
    runners.run_append(decode_kafka(kafka_rows), lay.table("bronze", "quote_eh"),
                       lay.ckpt("bronze_quote_eh"))
    b = lay.table("bronze", "quote_eh")
    src = spark.readStream.schema(spark.read.parquet(b).schema).parquet(b)
    s = lay.table("silver", "quote_eh")
    if callable(silver_quote):
        runners.run_each(src, lambda batch: S.silver_trades(batch, silver_quote()), s, lay.ckpt("silver_quote_eh"))
    else:
        runners.run_append(S.silver_trades(src, silver_quote), s, lay.ckpt("silver_quote_eh"))
    sstream = spark.readStream.schema(spark.read.parquet(s).schema).parquet(s)
    if keep_late:
        table = BarTable(spark, lay.table("gold", "realtime_parts"), sstream.schema, width, watermark)
        merge_stream(sstream, table, lay.ckpt("gold_realtime_parts"))
        return {"silver_quote_eh": spark.read.parquet(s), "gold_fact_realtime_agg": table.bars(),
                "gold_realtime_corrected": table.bars(open_too=True, corrected=True), "late_trades": table.late()}
    runners.run_append(G.realtime_agg(sstream, width, watermark=watermark),
                       lay.table("gold", "fact_realtime_agg"), lay.ckpt("gold_realtime_agg"))
    return {"silver_quote_eh": spark.read.parquet(s),
            "gold_fact_realtime_agg": spark.read.parquet(lay.table("gold", "fact_realtime_agg"))}
