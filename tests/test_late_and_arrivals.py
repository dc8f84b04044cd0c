"""Late rows kept, first arrivals without growing state: against one batch over all rows."""
import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from bourse.operators import bars as B
from bourse.streaming.arrivals import FirstArrivals
from bourse.streaming.late import BarTable

TRADE = "symbol string, price double, volume long, conditions array<string>, timestamp timestamp, previous_close_price double, id long"
T0 = dt.datetime(2024, 5, 1, 12)


def trades(rng, n, start):
    return [(rng.choice(["A", "B", None]), float(rng.randrange(9)), rng.choice([None, 3]), rng.choice([None, ["4"], ["1"]]),
             None if rng.random() < 0.05 else T0 + dt.timedelta(seconds=rng.randrange(240)), rng.choice([None, 5.0, 6.0]), start + i)
            for i in range(n)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_emitted_open_and_late_rows_add_up_and_correct_the_bars(spark, tmp):
    rng = random.Random(3)
    schema = spark.createDataFrame([], TRADE).schema
    table = BarTable(spark, f"{tmp}/t", schema, tie_break="id")
    every = []
    for i in range(4):
        batch = trades(rng, 25, 100 * i)
        every += batch
        table.merge(spark.createDataFrame(batch, schema).coalesce(1), i)
    table.merge(spark.createDataFrame([], schema), 4)
    late = table.late().collect()
    assert late and any(r["timestamp"] is None for r in late) and any(r["timestamp"] is not None for r in late)
    kept = sum(r["n_rows"] for r in table.partials(open_too=True).collect())
    assert kept + len(late) == len(every) == sum(r["n_rows"] for r in table.ledger().collect())
    assert rows(table.bars(open_too=True, corrected=True)) == rows(B.bars(spark.createDataFrame(every, schema), tie_break="id", watermark=None)
                                                                    .where("window_start is not null"))
    closed = table.partials().groupBy("symbol", "window").count()
    assert closed.where("count > 1").collect() == []            # a window is emitted once
    marks = [r["watermark"] for r in table.ledger().orderBy("batch_id").collect()]
    assert marks == sorted(marks) and all(r["window"]["end"] <= marks[-1] for r in table.partials().collect())


def test_a_replayed_batch_of_trades_changes_nothing(spark, tmp):
    rng = random.Random(4)
    schema = spark.createDataFrame([], TRADE).schema
    table = BarTable(spark, f"{tmp}/t", schema, tie_break="id")
    assert table.bars(open_too=True, corrected=True).collect() == [] and table.late().collect() == []
    a, b = (spark.createDataFrame(trades(rng, 20, 100 * i), schema).coalesce(1) for i in range(2))
    table.merge(a, 0)
    table.merge(b, 1)
    before = rows(table.bars(open_too=True)), rows(table.late())
    table.merge(b, 1)
    assert (rows(table.bars(open_too=True)), rows(table.late())) == before


def test_first_arrivals_equal_drop_duplicates_over_batches(spark, tmp):
    rng = random.Random(5)
    schema = spark.createDataFrame([], "k long, kind string, seq long").schema
    store = FirstArrivals(spark, f"{tmp}/s", ["k", "kind"], ["seq"], buckets=4, fold=3)
    first, seen_files = {}, {}
    for i in range(8):
        batch = [(rng.choice([None, *range(8)]), rng.choice(["a", None]), 100 * i + j) for j in range(rng.randrange(0, 6))]
        for k, kind, seq in batch:
            first.setdefault((k, kind), seq)
        store = FirstArrivals(spark, f"{tmp}/s", ["k", "kind"], ["seq"], buckets=4, fold=3)      # a restart
        store.merge(spark.createDataFrame(batch, schema).coalesce(1), i)
        if i in (2, 5):
            store.merge(spark.createDataFrame(batch, schema).coalesce(1), i)                      # a replay
        assert all(r["n"] <= 3 for r in store.pieces().groupBy("bucket").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect())
    assert {tuple(r) for r in store.read(schema).collect()} == {(*k, s) for k, s in first.items()}
    assert store.read(schema).count() == len(first)
    assert store.records().where("whole").count() > 0
    # files of a batch that was never recorded do not count
    spark.createDataFrame([(99, "x", 1)], schema).write.parquet(f"{tmp}/s/rows/batch_id=50")
    assert store.read(schema).where("k = 99").collect() == [] and os.path.isdir(f"{tmp}/s/rows/batch_id=50")


def test_a_failed_refresh_leaves_the_table(spark, tmp):
    from bourse.streaming.runners import run_refresh
    path = f"{tmp}/table"
    run_refresh(spark.range(3), path)
    with pytest.raises(Exception, match="broken"):
        run_refresh(spark.range(5).selectExpr("if(id = 4, raise_error('broken'), id) as id"), path)
    assert spark.read.parquet(path).count() == 3
    run_refresh(spark.read.parquet(path).selectExpr("id + 10 as id"), path)          # from itself
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [10, 11, 12]
    os.rename(path, f"{path}__old")                                                  # broken off between the renames
    run_refresh(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2 and not os.path.exists(f"{path}__old")


def test_trades_flow_keeps_late_rows(spark, tmp):
    from bourse.plans import flows
    schema = spark.createDataFrame([], TRADE).schema
    q = spark.createDataFrame([("A", 5.0, T0, T0)], "symbol string, close_price double, event_timestamp timestamp, ingest_timestamp timestamp") \
        .withColumns({"previous_close_price": F.lit(5.0)})
    kafka_rows = []
    for i, seconds in enumerate([(0, 200), (10, 210)]):
        ms = [int((T0 + dt.timedelta(seconds=s)).replace(tzinfo=dt.timezone.utc).timestamp() * 1000) for s in seconds]
        kafka_rows.append([json.dumps({"symbol": "A", "price": 2.0 + i, "volume": 1, "conditions": ["1"], "timestamp": m}) for m in ms])
    lay = flows.Layout(f"{tmp}/lake")
    for i, values in enumerate(kafka_rows):
        spark.createDataFrame([(None, bytes(v, "utf8"), "t", 0, j, T0, 0) for j, v in enumerate(values)],
                              "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int") \
            .coalesce(1).write.mode("append").parquet(f"{tmp}/kafka")
        stream = spark.readStream.schema(spark.read.parquet(f"{tmp}/kafka").schema).parquet(f"{tmp}/kafka")
        out = flows.trades_flow(spark, stream, lay, q, keep_late=True)
    assert out["late_trades"].count() == 1
    assert out["gold_realtime_corrected"].agg(F.sum("volume")).first()[0] == 4
    assert out["gold_fact_realtime_agg"].agg(F.sum("volume")).first()[0] == 1
