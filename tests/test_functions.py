import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from datamove.functions import flatten_structs, normalize_types

D = dt.date
TS = dt.datetime


def test_normalize_clamps_and_casts(spark):
    df = spark.createDataFrame(
        [
            (1, 2.5, D(1850, 2, 2), TS(1850, 2, 2, 3), "a"),
            (2, -2.5, D(1899, 12, 31), TS(1899, 12, 31, 23, 59, 59), "b"),
            (3, None, D(1900, 1, 1), TS(1900, 1, 1, 0, 0, 1), None),
            (4, 1.0, None, None, "d"),
        ],
        "id long, AMT double, D date, TS timestamp, NAME string",
    )
    out = normalize_types(df, unbounded=["AMT"])
    assert out.columns == ["id", "amt", "d", "ts", "name"]
    assert out.schema["amt"].dataType == T.DecimalType(38, 0)
    assert [tuple(r) for r in out.orderBy("id").collect()] == [
        (1, Decimal(3), D(1900, 1, 1), TS(1900, 1, 1), "a"),
        (2, Decimal(-3), D(1900, 1, 1), TS(1900, 1, 1), "b"),
        (3, None, D(1900, 1, 1), TS(1900, 1, 1, 0, 0, 1), None),
        (4, Decimal(1), None, None, "d"),
    ]


def test_normalize_keeps_timestamp_kind_and_drops_time_of_dates(spark):
    df = spark.createDataFrame([(TS(2020, 5, 5, 10), TS(1800, 1, 1))], "a timestamp, b timestamp").select(
        "a", F.col("b").cast("timestamp_ntz").alias("b")
    )
    out = normalize_types(df, dates=["a"])
    assert [f.dataType.typeName() for f in out.schema.fields] == ["date", "timestamp_ntz"]
    assert out.first() == (D(2020, 5, 5), TS(1900, 1, 1))


def test_normalize_finds_unbounded_oracle_numbers(spark):
    df = spark.createDataFrame([(Decimal("7.5"), Decimal("7.5"))], "n decimal(38,10), m decimal(10,2)")
    out = normalize_types(df, dialect="ORACLE")
    assert [f.dataType for f in out.schema.fields] == [T.DecimalType(38, 0), T.DecimalType(10, 2)]
    assert normalize_types(df).schema == df.schema


def test_normalize_refuses_names_that_differ_in_case(spark):
    with pytest.raises(ValueError, match="differ only in case"):
        normalize_types(spark.createDataFrame([(1, 2)], "Id int, ID int"))


def test_normalize_keeps_filter_pushdown(spark, tmp_path, plan):
    spark.range(5).withColumn("T", F.lit(TS(2000, 1, 1))).write.parquet(f"{tmp_path}/t")
    out = normalize_types(spark.read.parquet(f"{tmp_path}/t")).where("id = 3").select("id")
    assert "EqualTo(id,3)" in plan(out) and "ReadSchema: struct<id:bigint>" in plan(out)


def test_flatten_order_and_arrays(spark, tmp_path):
    with open(f"{tmp_path}/one.json", "w") as f:
        f.write('{"id": 1,\n "a": {"x": 1, "b": {"y": "p"}}, "arr": [{"q": 1}], "z": 9}')
    with open(f"{tmp_path}/two.json", "w") as f:
        f.write('{"id": 2, "arr": [], "z": 8}')
    df = flatten_structs(spark.read.option("multiLine", True).json(str(tmp_path)))
    assert df.columns == ["arr", "id", "z", "x", "y"]
    got = {r.id: (r.z, r.x, r.y) for r in df.collect()}
    assert got == {1: (9, 1, "p"), 2: (8, None, None)}
    assert isinstance(df.schema["arr"].dataType.elementType, T.StructType)


def test_flatten_qualifies_repeated_names(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('id', 2, 'v', 3) AS a, named_struct('ID', 4, 'w', 5) AS b")
    flat = flatten_structs(df)
    assert flat.columns == ["id", "a_id", "v", "b_ID", "w"]
    assert tuple(flat.first()) == (1, 2, 3, 4, 5)


def test_flatten_handles_odd_names(spark):
    flat = flatten_structs(spark.sql("SELECT named_struct('a.b', 1, 'c d', 2) AS `s.t`, 3 AS `p.q`"))
    assert flat.columns == ["p.q", "a.b", "c d"]
    assert tuple(flat.first()) == (3, 1, 2)


def test_flatten_is_one_projection(spark, plan):
    df = spark.range(3).select(F.struct(F.struct(F.struct("id").alias("c")).alias("b")).alias("a"))
    assert plan(flatten_structs(df)).count("Project") <= 1
