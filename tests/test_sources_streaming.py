"""Sources (A1-A9) and streaming runners (A12, K1-K9) on files in a temp folder."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.operators import bars
from bourse.sources import files, kafka, rescue
from bourse.streaming import cdc as scdc
from bourse.streaming import runners


_MTIME = [1_700_000_000]


def _write_lines(path, name, lines):
    """Write a file with a strictly increasing modification time, so the file
    source (oldest first) reads files in the order they were written."""
    os.makedirs(path, exist_ok=True)
    p = os.path.join(path, name)
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    _MTIME[0] += 10
    os.utime(p, (_MTIME[0], _MTIME[0]))


def test_json_stream_with_rescue_and_lineage(spark, tmp):
    src = f"{tmp}/quote"
    _write_lines(src, "q1.json", [json.dumps({"symbol": "AAPL", "c": "10.5", "t": "1704067200"})])
    _write_lines(src, "q2.json", [json.dumps({"symbol": "MSFT", "c": "7", "t": "1704067200", "extra": 1})])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("symbol", "c", "t")])
    s = files.read_files_stream(spark, src, "json", schema=schema, rescue=True, max_files_per_trigger=1)
    runners.run_append(s, f"{tmp}/bronze", f"{tmp}/ck")
    out = spark.read.parquet(f"{tmp}/bronze")
    got = {r.symbol: (r._rescued_data, r.file_name) for r in out.collect()}
    assert got["AAPL"] == (None, "q1.json")
    assert got["MSFT"] == ('{"extra":"1"}', "q2.json")
    assert {"file_size", "file_path", "ingest_timestamp"} <= set(out.columns)
    # a second run reads no file twice
    runners.run_append(s, f"{tmp}/bronze", f"{tmp}/ck")
    assert spark.read.parquet(f"{tmp}/bronze").count() == 2


def test_csv_stream_all_strings(spark, tmp):
    src = f"{tmp}/candles"
    _write_lines(src, "c.csv", ["Date,Open,High,Low,Close,Volume,Symbol",
                                "2024-01-02,1,2,0.5,1.5,3000000000,AAPL"])
    s = files.read_files_stream(spark, src, "csv")
    runners.run_append(s, f"{tmp}/out", f"{tmp}/ck")
    df = spark.read.parquet(f"{tmp}/out")
    assert all(isinstance(f.dataType, T.StringType) for f in df.schema.fields
               if f.name in ("Date", "Open", "Volume"))
    from bourse.plans import silver
    typed = silver.typed_candles(df.select(*[F.col(c).alias(c.lower()) for c in
                                            ("Date", "Open", "High", "Low", "Close", "Volume", "Symbol")],
                                          "ingest_timestamp"))
    assert typed.collect()[0].volume == 3000000000   # long, not an int overflow


def test_rescued_column_keeps_unbound_fields(spark):
    schema = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("Px", T.StringType())])
    df = spark.createDataFrame([('{"symbol": "A", "x": {"y": 1}, "px": 5}',), ('{"symbol": "B"}',)],
                               "v string")
    r = rescue.with_rescued(df, "v", schema).collect()
    assert r[0].parsed.symbol == "A" and r[0].parsed.Px is None
    # nested values as JSON text; a key differing only in case is rescued, not lost
    assert r[0]._rescued_data == '{"x":"{\\"y\\":1}","px":"5"}'
    assert r[1]._rescued_data is None


def test_kafka_options_and_decode(spark):
    o = kafka.kafka_options(kafka.KafkaConfig("ns:9093", "trades", "$ConnectionString", "pw"))
    assert o["maxOffsetsPerTrigger"] == "50000" and o["startingOffsets"] == "earliest"
    assert o["kafka.security.protocol"] == "SASL_SSL" and o["failOnDataLoss"] == "true"
    assert 'password="pw"' in o["kafka.sasl.jaas.config"]
    rows = [(b"k", b'{"symbol":"A","price":1.5,"volume":2,"conditions":["1"],"timestamp":1704067200123}',
             "t", 0, 5, dt.datetime(2024, 1, 1), 0),
            (None, b"not json", "t", 0, 6, dt.datetime(2024, 1, 1), 0)]
    df = spark.createDataFrame(rows, kafka.KAFKA_ROW)
    dec = kafka.decode_kafka(df)
    assert dec.columns[-2:] == ["key_str", "value_str"]
    parsed = kafka.parse_trades(dec).collect()
    assert parsed[0].symbol == "A" and parsed[0].timestamp == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert parsed[1].symbol is None and parsed[1].price is None


def test_normalize_trades_envelope(spark):
    msgs = [json.dumps({"type": "ping"}), json.dumps({"type": "trade", "data": []}),
            json.dumps({"type": "trade", "data": [{"s": "A", "p": 1.0, "v": 0.5, "c": ["1"], "t": 1},
                                                  {"s": "B", "p": 2.0, "v": 1, "c": None, "t": 2},
                                                  {"s": "C", "p": 3.0, "v": 2, "c": [], "t": 3}]})]
    df = spark.createDataFrame([(m,) for m in msgs], "value_str string")
    got = sorted((r.symbol, r.volume) for r in kafka.normalize_trades(df).collect())
    assert got == [("A", 0.5), ("B", 1.0), ("C", 2.0)]
    payload = kafka.to_kafka_payload(kafka.normalize_trades(df), "symbol", ["symbol", "price"]).collect()
    assert json.loads(payload[0].value)["symbol"] == payload[0].key


TRADES = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("price", T.DoubleType()),
                       T.StructField("volume", T.LongType()),
                       T.StructField("conditions", T.ArrayType(T.StringType())),
                       T.StructField("timestamp", T.TimestampType()),
                       T.StructField("previous_close_price", T.DoubleType())])


def _trade_file(path, name, rows):
    lines = [json.dumps({"symbol": s, "price": p, "volume": 1, "conditions": ["1"],
                         "timestamp": ts, "previous_close_price": 10.0}) for s, p, ts in rows]
    _write_lines(path, name, lines)


def test_streaming_bars_watermark_drops_late_rows(spark, tmp):
    src = f"{tmp}/trades"
    _trade_file(src, "f1.json", [("A", 10.0, "2024-01-01T09:30:05"), ("A", 11.0, "2024-01-01T09:31:10")])
    # watermark is now 09:31:10 - 30s = 09:30:40: window 09:30 still open, the late row is kept
    _trade_file(src, "f2.json", [("A", 12.0, "2024-01-01T09:30:50"), ("A", 13.0, "2024-01-01T09:33:00")])
    # watermark 09:32:30: the next batch emits windows 09:30 and 09:31 and drops their state
    _trade_file(src, "f3.json", [("A", 14.0, "2024-01-01T09:40:00")])
    # window 09:30 is gone: this row is dropped, not emitted as a second 09:30 bar
    _trade_file(src, "f4.json", [("A", 99.0, "2024-01-01T09:30:30")])
    s = spark.readStream.schema(TRADES).option("maxFilesPerTrigger", 1).json(src)
    out = bars.bars(s)
    runners.run_append(out, f"{tmp}/bars", f"{tmp}/ck")
    rows = spark.read.parquet(f"{tmp}/bars").collect()
    got = {r.window_start.minute: (r.open_price, r.close_price, r.snapshot_count) for r in rows}
    assert len(rows) == len(got)             # each window emitted once
    assert got[30] == (10.0, 12.0, 2)        # late row in the open window kept; 99.0 dropped
    assert got[31] == (11.0, 11.0, 1)
    assert 40 not in got                      # still open when the stream drained
    # a restart emits nothing twice
    runners.run_append(out, f"{tmp}/bars", f"{tmp}/ck")
    assert spark.read.parquet(f"{tmp}/bars").count() == len(got)


def test_stream_change_log_equals_batch(spark, tmp):
    from bourse.operators import cdc
    src = f"{tmp}/changes"
    rows = [("a", i, "P" if (i // 3) % 2 else "Q", i % 4) for i in range(12)]
    rows += [("b", i, "Z", 0) for i in range(5)]
    for i, chunk in enumerate([rows[7:], rows[:3], rows[3:7]]):   # out of order across files
        _write_lines(src, f"c{i}.json", [json.dumps({"k": k, "seq": s, "v": v, "x": x})
                                         for k, s, v, x in chunk])
    schema = "k string, seq int, v string, x int"
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(src)
    history = scdc.scd2_stream(s, ["k"], "seq", f"{tmp}/log", f"{tmp}/ck", except_cols=["x"])
    batch = cdc.scd2(spark.createDataFrame(rows, schema), ["k"], "seq", except_cols=["x"])
    assert sorted(map(tuple, history().collect()), key=repr) == \
        sorted(map(tuple, batch.select(*history().columns).collect()), key=repr)
    assert len(os.listdir(f"{tmp}/log")) >= 3  # one log folder per micro-batch


def test_run_branches_writes_each_branch_once_per_batch(spark, tmp):
    src = f"{tmp}/in"
    _write_lines(src, "a.json", [json.dumps({"id": i, "ok": i % 2 == 0}) for i in range(6)])
    s = spark.readStream.schema("id int, ok boolean").json(src)
    runners.run_branches(s, {"valid": lambda b: b.filter("ok"), "quarantine": lambda b: b.filter("not ok")},
                         f"{tmp}/out", f"{tmp}/ck")
    assert runners.read_branch(spark, f"{tmp}/out", "valid").count() == 3
    assert runners.read_branch(spark, f"{tmp}/out", "quarantine").count() == 3


def test_streaming_dedup_first_arrival(spark, tmp):
    from bourse.operators import cdc
    src = f"{tmp}/snap"
    _write_lines(src, "a.json", [json.dumps({"symbol": "A", "d": "2024-01-01", "v": 1})])
    _write_lines(src, "b.json", [json.dumps({"symbol": "A", "d": "2024-01-01", "v": 2}),
                                 json.dumps({"symbol": "A", "d": "2024-01-02", "v": 3})])
    s = spark.readStream.schema("symbol string, d string, v int").option("maxFilesPerTrigger", 1).json(src)
    runners.run_append(cdc.dedup_first(s, ["symbol", "d"]), f"{tmp}/o", f"{tmp}/ck")
    got = sorted((r.d, r.v) for r in spark.read.parquet(f"{tmp}/o").collect())
    assert got == [("2024-01-01", 1), ("2024-01-02", 3)]


def test_dedup_within_watermark_bounded_state(spark, tmp):
    from bourse.operators import cdc
    src = f"{tmp}/dups"
    _write_lines(src, "a.json", [json.dumps({"id": "x", "ts": "2024-01-01T00:00:00", "v": 1}),
                                 json.dumps({"id": "x", "ts": "2024-01-01T00:00:05", "v": 2})])
    _write_lines(src, "b.json", [json.dumps({"id": "x", "ts": "2024-01-01T00:00:10", "v": 3}),
                                 json.dumps({"id": "y", "ts": "2024-01-01T00:10:00", "v": 4})])
    s = spark.readStream.schema("id string, ts timestamp, v int").option("maxFilesPerTrigger", 1).json(src)
    runners.run_append(cdc.dedup_within_watermark(s, ["id"], "ts", "1 minute"), f"{tmp}/o", f"{tmp}/ck")
    got = sorted((r.id, r.v) for r in spark.read.parquet(f"{tmp}/o").collect())
    assert got == [("x", 1), ("y", 4)]


def test_stream_scd1_equals_batch(spark, tmp):
    from bourse.operators import cdc
    src = f"{tmp}/c1"
    rows = [("a", 3, "new"), ("a", 1, "old"), ("b", 2, "b1"), ("b", 5, "b2"), ("a", 2, "mid")]
    for i, chunk in enumerate([rows[:2], rows[2:4], rows[4:]]):
        _write_lines(src, f"f{i}.json", [json.dumps({"k": k, "seq": s, "v": v}) for k, s, v in chunk])
    s = spark.readStream.schema("k string, seq int, v string").option("maxFilesPerTrigger", 1).json(src)
    current = scdc.scd1_stream(s, ["k"], "seq", f"{tmp}/log", f"{tmp}/ck")
    assert sorted((r.k, r.v) for r in current().collect()) == [("a", "new"), ("b", "b2")]
