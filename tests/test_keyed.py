"""Keyed tables kept in place against the same tables derived from the whole log."""
import os
import random

import pytest
from pyspark.sql import functions as F

from bourse.operators import cdc
from bourse.streaming import keyed as K

SCHEMA = "k long, seq long, status string, amount double"


def changes(rng, n, keys=12, top=400):
    return [(rng.choice([None, *range(keys)]) if rng.random() < 0.02 else rng.randrange(keys),
             None if rng.random() < 0.02 else rng.randrange(top), rng.choice(["a", "b", None]), float(rng.randrange(4))) for _ in range(n)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_latest_equals_scd1_and_leaves_other_buckets_alone(spark, tmp):
    rng = random.Random(1)
    table = K.LatestTable(spark, f"{tmp}/t", ["k"], "seq", buckets=16)
    log, seen = [], {}
    schema = spark.createDataFrame([], SCHEMA).schema
    for i in range(50):
        key = rng.randrange(200)
        batch = [(key, rng.randrange(1000), rng.choice("ab"), float(rng.randrange(3))) for _ in range(rng.randrange(1, 4))]
        log += batch
        table.merge(spark.createDataFrame(batch, SCHEMA).coalesce(1), i)
        now = {r["bucket"]: r["batch_id"] for r in table.table.newest().collect()}
        assert [b for b in now if now[b] != seen.get(b)] == [b for b in now if now[b] == i] and list(now.values()).count(i) == 1
        seen = now
    assert rows(table.read(schema)) == rows(cdc.scd1(spark.createDataFrame(log, SCHEMA), ["k"], "seq"))
    before = files(f"{tmp}/t/data")
    assert table.table.vacuum(keep=1) > 0
    assert rows(table.read(schema)) == rows(cdc.scd1(spark.createDataFrame(log, SCHEMA), ["k"], "seq"))
    assert files(f"{tmp}/t/data") < before


def test_a_first_batch_is_computed_once(spark, tmp):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    batch = changes(random.Random(3), 200)
    table = K.LatestTable(spark, f"{tmp}/t", ["k"], "seq", buckets=4)
    assert table.merge(spark.createDataFrame(batch, SCHEMA).mapInArrow(counted, SCHEMA), 0) == 0
    assert seen.value == 200
    assert rows(table.read(spark.createDataFrame([], SCHEMA).schema)) == rows(cdc.scd1(spark.createDataFrame(batch, SCHEMA), ["k"], "seq"))


def test_a_replayed_or_failed_batch_changes_nothing(spark, tmp):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = K.LatestTable(spark, f"{tmp}/t", ["k"], "seq", buckets=4)
    a, b = [(1, 5, "a", 1.0), (2, 5, "a", 1.0)], [(1, 7, "b", 2.0), (3, 1, "c", 0.0)]
    table.merge(spark.createDataFrame(a, SCHEMA), 0)
    # files without a record: as after a crash between the two
    spark.createDataFrame([(1, 99, "x", 9.0)], SCHEMA).withColumn("bucket", K.bucket_of(["k"], 4)) \
        .write.partitionBy("bucket").parquet(f"{tmp}/t/data/batch_id=1")
    assert rows(table.read(schema)) == sorted(a)
    for _ in range(2):
        table.merge(spark.createDataFrame(b, SCHEMA), 1)
        assert rows(table.read(schema)) == sorted([(1, 7, "b", 2.0), (2, 5, "a", 1.0), (3, 1, "c", 0.0)])


SEG = staticmethod(lambda s: F.floor(s / 50)).__func__


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_history_equals_scd2_in_any_order(spark, tmp, seed):
    rng = random.Random(seed)
    log = changes(rng, 160)
    log += [(3, s, "a", float(s)) for s in range(100, 140)] + [(3, 120, "b", 0.5)]      # a long run, split by a late row
    order = list(log)
    rng.shuffle(order)
    table = K.HistoryTable(spark, f"{tmp}/h", ["k"], "seq", SEG, except_cols=["amount"], buckets=4)
    schema = spark.createDataFrame([], SCHEMA).schema
    cuts = sorted(rng.sample(range(1, len(order)), 3))
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(order)])):
        table.merge(spark.createDataFrame(order[a:b], SCHEMA), i)
    want = rows(cdc.scd2(spark.createDataFrame(log, SCHEMA), ["k"], "seq", except_cols=["amount"]))
    assert rows(table.read(schema)) == want
    # one late row reads its own cell and the runs of its bucket, not the log
    late = (3, 133, "c", 1.5)
    read = table.merge(spark.createDataFrame([late], SCHEMA), 10)
    stored = {(r["bucket"], r["seg"]): r["n_rows"] for r in table.rows.newest(before=10).collect()}
    assert read["rows"] in stored.values() and read["rows"] < sum(stored.values()) / 4
    want = rows(cdc.scd2(spark.createDataFrame([*log, late], SCHEMA), ["k"], "seq", except_cols=["amount"]))
    assert rows(table.read(schema)) == want
    assert table.vacuum(keep=1) > 0 and rows(table.read(schema)) == want


def test_compaction_is_lossless_and_bounded(spark, tmp):
    rng = random.Random(9)
    first = [(k, s, "a" if s < 90 else "b", float(s % 7)) for k in range(4) for s in range(0, 180)]
    table = K.HistoryTable(spark, f"{tmp}/h", ["k"], "seq", SEG, except_cols=["amount"], buckets=2)
    schema = spark.createDataFrame([], SCHEMA).schema
    table.merge(spark.createDataFrame(first, SCHEMA), 0)
    want = rows(cdc.scd2(spark.createDataFrame(first, SCHEMA), ["k"], "seq", except_cols=["amount"]))
    left = table.compact(schema, below=160, batch_id=1)
    assert rows(table.read(schema)) == want
    # 4 keys x (segments 0, 50, 150: one run each below 160; segment 50: two runs) x two ends, and 20 rows a key above
    assert left == 4 * (2 * 5 + 20)
    later = [(k, rng.randrange(160, 260), rng.choice("abc"), 9.0) for k in range(4) for _ in range(8)]
    table.merge(spark.createDataFrame(later, SCHEMA), 2)
    assert rows(table.read(schema)) == rows(cdc.scd2(spark.createDataFrame(first + later, SCHEMA), ["k"], "seq", except_cols=["amount"]))


def test_stream_into_both_tables(spark, tmp):
    rng = random.Random(4)
    log = changes(rng, 90)
    for i in range(3):
        spark.createDataFrame(log[i * 30:(i + 1) * 30], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp}/in")
    schema = spark.createDataFrame([], SCHEMA).schema
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    latest = K.LatestTable(spark, f"{tmp}/l", ["k"], "seq", buckets=4)
    history = K.HistoryTable(spark, f"{tmp}/h", ["k"], "seq", SEG, except_cols=["amount"], buckets=4)
    for table, name in ((latest, "l"), (history, "h")):
        K.merge_stream(src, table, f"{tmp}/ck-{name}")
    whole = spark.createDataFrame(log, SCHEMA)
    assert rows(latest.read(schema)) == rows(cdc.scd1(whole, ["k"], "seq"))
    assert rows(history.read(schema)) == rows(cdc.scd2(whole, ["k"], "seq", except_cols=["amount"]))


def test_derived_table_follows_bucket_by_bucket(spark, tmp):
    rng = random.Random(8)
    schema = spark.createDataFrame([], "g long, k long, seq long, v long").schema

    def totals(rows):       # a group may lose its row again
        return rows.groupBy("g").agg(F.sum("v").alias("total"), F.count("*").alias("n")).where("total % 2 = 0")
    source = K.LatestTable(spark, f"{tmp}/s", ["g", "k"], "seq", buckets=8, by=["g"])
    derived = K.DerivedTable(source, f"{tmp}/d", totals)
    assert derived.read(schema).collect() == []
    log, sizes = [], []
    for i in range(10):
        g = rng.randrange(12)
        batch = [(g, rng.randrange(3), rng.randrange(1000), rng.randrange(5)) for _ in range(3)]
        log += batch
        df = spark.createDataFrame(batch, schema).coalesce(1)
        source.merge(df, i)
        sizes.append(derived.refresh(schema, i))
        if i == 4:
            derived.refresh(schema, i)                                          # a replay
        cells = derived.table.commits().where(F.col("batch_id") == i).collect()
        assert len(cells) == 1                                                  # one touched group, one bucket
    whole = spark.createDataFrame(log, schema)
    assert rows(derived.read(schema)) == rows(totals(cdc.scd1(whole, ["g", "k"], "seq")))
    assert derived.table.newest().where("n_rows = 0").count() + derived.table.newest().where("n_rows > 0").count() == source.table.newest().count()
    assert max(sizes) < len(log)
