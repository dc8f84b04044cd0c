"""VARIANT bronze: any file can land, the kept schema only widens, series need no list of metrics."""
import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.sources import variants as V
from bourse.streaming.runners import run_append


def land(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as f:
        f.write("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines))


def load(spark, tmp):
    run_append(V.read_variant_stream(spark, f"{tmp}/in"), f"{tmp}/bronze", f"{tmp}/ck")
    b = spark.read.parquet(f"{tmp}/bronze")
    return b, V.evolve(spark, V.schema_of_records(b), f"{tmp}/schema")


def test_a_later_file_of_another_shape_loses_nothing(spark, tmp):
    land(f"{tmp}/in", "a", [{"symbol": "A", "cap": 5, "n": None, "sub": {"x": 1}}, {"symbol": "B", "cap": 6}])
    _, first = load(spark, tmp)
    assert first["cap"].dataType == T.LongType() and first["n"].dataType == T.NullType()
    land(f"{tmp}/in", "b", [{"symbol": "C", "cap": "n/a", "n": 2, "sub": {"y": "z"}, "odd' name": 1.5, "both'\"": 8}, "{broken", "", {"symbol": "D", "cap": 7.5}])
    b, schema = load(spark, tmp)
    assert schema["cap"].dataType == T.VariantType() and set(schema["sub"].dataType.names) == {"x", "y"}
    assert [r["_rescued_data"] for r in b.where("_rescued_data is not null").collect()] == ["{broken"]
    rows = {r["symbol"]: r for r in V.typed(b, schema).withColumn("cap", F.to_json("cap")).where("symbol is not null").collect()}
    assert {k: r["cap"] for k, r in rows.items()} == {"A": "5", "B": "6", "C": '"n/a"', "D": "7.5"}
    assert rows["C"]["odd' name"] == 1.5 and rows["C"]["both'\""] == 8 and rows["C"]["n"] == 2 and rows["A"]["sub"]["x"] == 1 and rows["C"]["sub"]["y"] == "z"


def test_lattice(spark):
    void, n, d, s, v = T.NullType(), T.LongType(), T.DoubleType(), T.StringType(), T.VariantType()
    for a, b, out in [(void, n, n), (n, d, d), (n, s, v), (v, n, v), (T.ArrayType(n), T.ArrayType(void), T.ArrayType(n)),
                      (T.ArrayType(n), n, v), (T.ArrayType(n), T.ArrayType(s), T.ArrayType(v))]:
        assert V.widen(a, b) == out and V.widen(b, a) == out


def test_schema_never_narrows(spark, tmp):
    wide = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.StringType())])
    assert V.evolve(spark, wide, f"{tmp}/s") == wide
    assert V.evolve(spark, T.StructType([T.StructField("a", T.LongType())]), f"{tmp}/s") == wide
    assert V.evolve(spark, T.StructType([]), f"{tmp}/s") == wide and os.listdir(f"{tmp}/s") == ["0"]
    # a state that was not written to its end does not count
    os.makedirs(f"{tmp}/s/1")
    assert V.evolve(spark, T.StructType([]), f"{tmp}/s") == wide


def test_empty_and_records_that_are_no_objects(spark):
    none = spark.createDataFrame([], "t string").select(F.parse_json("t").alias("record"))
    assert V.schema_of_records(none) == T.StructType([])
    listed = spark.createDataFrame([("[1]",), ("3",), (None,)], "t string").select(F.parse_json("t").alias("record"))
    assert V.schema_of_records(listed) == T.StructType([])
    assert V.typed(none, T.StructType([])).collect() == []


def test_series_are_found_in_each_record(spark):
    rows = [(1, '{"eps":[{"period":"P1","v":1.5},{"period":"P2"}],"none":[],"flat":3,"nil":null}'),
            (2, '{"brand new":[{"period":"P9","v":"text"}],"eps":[{"v":2}]}'), (3, None), (4, '[{"period":"P1"}]')]
    df = spark.createDataFrame(rows, "id int, t string").select("id", F.parse_json("t").alias("s"))
    out = {tuple(r) for r in V.unpivot_variant(df, ["id"], "s", {"period": "string", "v": "double"}).collect()}
    assert {r[:3] for r in out} == {(1, "eps", "P1"), (1, "eps", "P2"), (2, "brand new", "P9"), (2, "eps", None)}
    assert (1, "eps", "P1", 1.5) in out and (1, "eps", "P2", None) in out and (2, "eps", None, 2.0) in out
