"""Cases that the oracle's data does not hold: rescue, headers, ties, NULL keys, many micro-batches."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.operators import cdc, quality, windows
from bourse.sources import kafka
from bourse.sources.files import read_files, read_files_stream
from bourse.sources.rescue import with_rescued
from bourse.streaming import runners

SCHEMA = "event_id long, name string, at struct<x:int,y:int>, parts array<struct<a:int>>"


def test_rescue_keeps_mistyped_malformed_and_nested(spark):
    lines = ['{"event_id":1,"name":"a","at":{"x":1,"y":2},"parts":[{"a":1}]}', '{"event_id":"abc","name":"b"}', '{broken', "  ", None,
             '{"event_id":2,"at":{"x":1,"z":9}}', '{"event_id":3,"parts":[{"a":1},{"a":2,"b":"q"}]}', '{"Event_id":4,"extra":{"k":[1]}}',
             '{"event_id":null}', '{"event_id":5,"at":"text"}', "[1]"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, t string")
    schema = T._parse_datatype_string(SCHEMA)
    got = {r["i"]: r["_rescued_data"] for r in with_rescued(df, "t", schema).collect()}
    parsed = {i: None if v is None else json.loads(v) for i, v in got.items()}
    assert [parsed[i] for i in (0, 3, 4, 8)] == [None] * 4
    assert parsed[1] == {"event_id": "abc"}
    assert parsed[2] == {"_corrupt_record": "{broken"}
    assert json.loads(parsed[5]["at"]) == {"z": "9"}
    assert json.loads(parsed[6]["parts"])[1] == {"b": "q"}
    assert parsed[7] == {"Event_id": "4", "extra": '{"k":[1]}'}
    assert parsed[9] == {"at": "text"}
    assert parsed[10] == {"_corrupt_record": "[1]"}


def test_csv_header_in_other_order_fails_instead_of_swapping(spark, tmp):
    import os
    os.makedirs(f"{tmp}/in")
    open(f"{tmp}/in/a.csv", "w").write("Symbol,Open,Close\nA,1,2\n")
    ok = read_files(spark, f"{tmp}/in", "csv", lineage=False).collect()
    assert [tuple(r) for r in ok] == [("A", "1", "2")]
    open(f"{tmp}/in/b.csv", "w").write("Symbol,Close,Open\nB,3,4\n")
    schema = T._parse_datatype_string("Symbol string, Open string, Close string")
    with pytest.raises(Exception):
        read_files(spark, f"{tmp}/in", "csv", schema=schema, lineage=False).collect()


def test_csv_rescue_keeps_odd_lines(spark, tmp):
    import os
    os.makedirs(f"{tmp}/in")
    open(f"{tmp}/in/a.csv", "w").write("Symbol,Open,Close\nA,1,2\nB,3\nC,4,5,6\n")
    schema = T._parse_datatype_string("Symbol string, Open string, Close string")
    s = read_files_stream(spark, f"{tmp}/in", "csv", schema=schema, rescue=True, lineage=False)
    runners.run_append(s, f"{tmp}/out", f"{tmp}/ck")
    got = {r["Symbol"]: r["_rescued_data"] for r in spark.read.parquet(f"{tmp}/out").collect()}
    assert got == {"A": None, "B": "B,3", "C": "C,4,5,6"}


def test_trade_volume_survives_the_round_trip(spark):
    env = json.dumps({"type": "trade", "data": [{"s": "S", "p": 1.5, "v": 100.0, "c": ["1"], "t": 1700000000000}]})
    rows = kafka.normalize_trades(spark.createDataFrame([(env,)], "value_str string"))
    sent = kafka.to_kafka_payload(rows, "symbol", ["symbol", "price", "volume", "conditions", "timestamp"])
    got = kafka.parse_trades(sent.select(F.col("value").alias("value_str"), F.current_timestamp().alias("timestamp"))).first()
    assert (got["volume"], got["price"]) == (100, 1.5)


def test_scd1_ties_do_not_depend_on_arrival_and_null_keys_stay(spark):
    rows = [("k", 1, 1.0, {"m": 1}), ("k", 1, 2.0, {"m": 2}), (None, 1, 3.0, None), (None, 1, 4.0, None)]
    a, b = (spark.createDataFrame(r, "k string, seq int, v double, m map<string,int>") for r in (rows, rows[::-1]))
    first = {(r["k"], r["v"]) for r in cdc.scd1(a, ["k"], "seq").where("k is not null").collect()}
    assert first == {(r["k"], r["v"]) for r in cdc.scd1(b, ["k"], "seq").where("k is not null").collect()}
    assert cdc.scd1(a, ["k"], "seq", keep_null_keys=True).where("k is null").count() == 2
    assert cdc.dedup_first(a, ["k"], ["seq"], keep_null_keys=True).count() == 3


def test_segmented_lag_with_null_key(spark):
    df = spark.createDataFrame([(None, i, float(i * 10)) for i in range(1, 6)] + [("a", 1, 7.0)], "k string, s int, v double")
    plain = windows.lag_default(df, "v", ["k"], ["s"], 0.0, out="p").collect()
    cut = windows.lag_default(df, "v", ["k"], ["s"], 0.0, out="p", segment=lambda c: F.floor(c / F.lit(2))).collect()
    assert sorted(map(repr, (tuple(r[c] for c in ("k", "s", "v", "p")) for r in plain))) == \
        sorted(map(repr, (tuple(r[c] for c in ("k", "s", "v", "p")) for r in cut)))


def test_expectations_of_every_micro_batch(spark, tmp):
    rules = quality.RuleSet("t", (("positive", "x > 0"),), (("small", "x < 100"),))
    df = spark.createDataFrame([(i - 5 if i % 7 else None,) for i in range(130)], "x int")
    df.repartition(13).write.parquet(f"{tmp}/in")
    key = "spark.sql.streaming.numRecentProgressUpdates"
    old = spark.conf.get(key, "100")
    spark.conf.set(key, "2")     # progress reports keep two batches; the counts keep all
    try:
        s = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", "1").parquet(f"{tmp}/in")
        runners.run_expectations(s, rules, f"{tmp}/counts", f"{tmp}/ck")
    finally:
        spark.conf.set(key, old)
    got = {tuple(r) for r in runners.read_expectations(spark, f"{tmp}/counts").collect()}
    assert got == {tuple(r) for r in quality.expectation_counts(df, rules).collect()}


def test_reference_rows_that_arrive_between_batches_are_seen(spark, tmp):
    from bourse.operators.joins import enrich_latest
    facts = spark.createDataFrame([("a", 1)], "s string, n int")
    facts.write.parquet(f"{tmp}/in")
    spark.createDataFrame([("a", 1, 1.0)], "s string, o int, p double").write.parquet(f"{tmp}/ref")

    def join(batch):
        return enrich_latest(batch, spark.read.parquet(f"{tmp}/ref"), "s", "s", ["o"], ["p"])

    def drain():
        stream = spark.readStream.schema(facts.schema).parquet(f"{tmp}/in")
        runners.run_each(stream, join, f"{tmp}/out", f"{tmp}/ck")

    drain()
    spark.createDataFrame([("a", 2, 2.0)], "s string, o int, p double").write.mode("append").parquet(f"{tmp}/ref")
    spark.createDataFrame([("a", 2)], "s string, n int").write.mode("append").parquet(f"{tmp}/in")
    drain()
    assert {(r["n"], r["p"]) for r in spark.read.parquet(f"{tmp}/out").collect()} == {(1, 1.0), (2, 2.0)}


def test_no_silent_local_folder_on_a_cluster():
    from bourse import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Spark:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        session.checkpoint_dir(Spark())
    assert int(session.scale_conf(100 * 10 ** 12)["spark.sql.shuffle.partitions"]) > 370_000
