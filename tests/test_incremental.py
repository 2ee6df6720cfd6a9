import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from datamove.operators import (
    align_schemas,
    changed_rows,
    column_diff,
    fits_broadcast,
    frequent_keys,
    high_watermark,
    latest_per_key,
    merge_upsert,
    touched_partitions,
)

DAY = dt.datetime(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_watermark_and_strictly_newer_rows(spark):
    df = spark.createDataFrame([(1, DAY), (2, DAY + dt.timedelta(1)), (3, None)], "id int, update_timestamp timestamp")
    mark = high_watermark(df)
    assert mark == DAY + dt.timedelta(1)
    later = spark.createDataFrame(
        [(4, mark), (5, mark + dt.timedelta(seconds=1)), (6, None)], "id int, update_timestamp timestamp"
    )
    assert [r.id for r in changed_rows(later, mark).collect()] == [5]


def test_overlap_picks_up_ties_and_late_rows(spark):
    df = spark.createDataFrame([(1, DAY), (2, DAY - dt.timedelta(hours=1))], "id int, update_timestamp timestamp")
    assert changed_rows(df, DAY).isEmpty()
    assert changed_rows(df, DAY, overlap=dt.timedelta(hours=2)).count() == 2


def test_empty_table_has_no_watermark(spark):
    empty = spark.createDataFrame([], "id int, update_timestamp timestamp")
    assert high_watermark(empty) is None
    df = spark.createDataFrame([(1, DAY)], "id int, update_timestamp timestamp")
    assert changed_rows(df, None).count() == 1


def test_changed_rows_filter_reaches_the_scan(spark, tmp_path, plan):
    spark.range(10).select("id", F.lit(DAY).alias("update_timestamp")).write.parquet(f"{tmp_path}/t")
    text = plan(changed_rows(spark.read.parquet(f"{tmp_path}/t"), DAY))
    assert "GreaterThan(update_timestamp" in text


def test_column_diff_ignores_case(spark):
    old = spark.createDataFrame([(1, 2)], "id int, Gone int")
    new = spark.createDataFrame([(1, 3)], "ID int, added int")
    assert column_diff(old, new) == (["added"], ["Gone"], ["id", "Gone", "added"])


@pytest.mark.parametrize("broadcast", [False, True])
def test_null_keys_match_nothing(spark, broadcast):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, v string")
    new = spark.createDataFrame([(2, "B"), (None, "n"), (3, "d")], "id int, v string")
    merged = merge_upsert(old, new, "id", broadcast_keys=broadcast)
    assert rows(merged) == sorted([(1, "a"), (None, "c"), (2, "B"), (None, "n"), (3, "d")], key=repr)


def test_repeated_keys_of_the_increment_are_kept(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    new = spark.createDataFrame([(1, "x"), (1, "y")], "id int, v string")
    assert rows(merge_upsert(old, new, "id")) == [(1, "x"), (1, "y"), (2, "c")]


def test_composite_key(spark):
    old = spark.createDataFrame([(1, "a", 10), (1, "b", 20), (None, "a", 30)], "k int, l string, v int")
    new = spark.createDataFrame([(1, "a", 11)], "k int, l string, v int")
    assert rows(merge_upsert(old, new, ["k", "l"])) == sorted([(1, "a", 11), (1, "b", 20), (None, "a", 30)], key=repr)


def test_columns_added_and_dropped_at_once(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, v string, gone string")
    new = spark.createDataFrame([(2, "B", 7)], "id int, v string, added int")
    merged = merge_upsert(old, new, "id")
    assert merged.columns == ["id", "v", "gone", "added"]
    assert rows(merged) == [(1, "a", "x", None), (2, "B", None, 7)]


def test_types_widen_or_are_refused(spark):
    old = spark.createDataFrame([(1, 5)], "id int, v int")
    new = spark.createDataFrame([(2, 2**40)], "id long, v long")
    assert rows(merge_upsert(old, new, "id")) == [(1, 5), (2, 2**40)]
    with pytest.raises(TypeError, match="v: int -> string"):
        align_schemas(old, spark.createDataFrame([(2, "x")], "id int, v string"))


def test_merge_again_changes_nothing(spark):
    old = spark.createDataFrame([(i, "old") for i in range(20)] + [(None, "old")], "id int, v string")
    new = spark.createDataFrame([(i, "new") for i in range(15, 25)], "id int, v string")
    once = merge_upsert(old, new, "id")
    assert rows(merge_upsert(once, new, "id")) == rows(once)


@pytest.mark.parametrize("seed", range(3))
def test_every_way_of_merging_agrees_with_brute_force(spark, seed, no_broadcast):
    rng = random.Random(seed)

    def table(n, label):
        # One key owns a third of the rows, some rows have none.
        return [(rng.choice([7, 7, 7, None] + list(range(8))), f"{label}{i}") for i in range(n)]

    before, change = table(300, "o"), [(k, v) for k, v in table(12, "n") if seed != 1 or k != 7]
    old = spark.createDataFrame(before, "id int, v string")
    new = spark.createDataFrame(change, "id int, v string")
    replaced = {k for k, _ in change if k is not None}
    expected = sorted([r for r in before if r[0] is None or r[0] not in replaced] + change, key=repr)
    assert rows(merge_upsert(old, new, "id")) == expected
    assert rows(merge_upsert(old, new, "id", broadcast_keys=True)) == expected
    assert rows(merge_upsert(old, new, "id", co_located=True)) == expected
    assert 7 in frequent_keys(old, "id", 0.1)
    assert rows(merge_upsert(old, new, "id", hot_keys=frequent_keys(old, "id", 0.1))) == expected


@pytest.mark.parametrize("hot", [1, None])
def test_hot_and_missing_keys_are_spread_over_tasks(spark, no_broadcast, hot):
    old = spark.range(4000).select(F.lit(hot).cast("int").alias("id"), F.col("id").alias("v"))
    new = spark.createDataFrame([(2, -1)], "id int, v long")
    kept = merge_upsert(old, new, "id", hot_keys=[1]).where("v >= 0")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 1500


def test_merge_reads_the_old_rows_once(spark, plan, tmp_path, no_broadcast):
    spark.range(9).write.parquet(f"{tmp_path}/old")
    spark.range(3).write.parquet(f"{tmp_path}/new")
    old, new = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("old", "new"))
    assert plan(merge_upsert(old, new, "id")).count(f"{tmp_path}/old") == 1


def test_merge_plan_is_an_equi_anti_join(spark, plan, no_broadcast):
    old = spark.createDataFrame([(1, "a")], "id int, v string")
    new = spark.createDataFrame([(2, "b")], "id int, v string")
    text = plan(merge_upsert(old, new, "id"))
    assert "SortMergeJoin" in text and "LeftAnti" in text and "NestedLoop" not in text
    assert "BroadcastHashJoin" in plan(merge_upsert(old, new, "id", broadcast_keys=True))


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 3, "b"), (2, 5, "c"), (None, 1, "x"), (None, 2, "y"), (3, None, "n"), (3, 0, "m")],
        "id int, t int, v string",
    )
    expected = [(1, 3, "b"), (2, 5, "c"), (3, 0, "m"), (None, 1, "x"), (None, 2, "y")]
    assert rows(latest_per_key(df, "id", "t")) == sorted(expected, key=repr)


def test_latest_per_key_breaks_ties_alike_in_any_order(spark):
    data = [(1, 1, f"v{i}", {"m": i}) for i in range(50)]
    schema = "id int, t int, v string, m map<string,int>"
    one = latest_per_key(spark.createDataFrame(data, schema), "id", "t")
    other = latest_per_key(spark.createDataFrame(data[::-1], schema).repartition(7), "id", "t")
    assert one.collect() == other.collect()


def test_latest_per_key_reduces_before_the_shuffle(spark, plan):
    text = plan(latest_per_key(spark.createDataFrame([(1, 1)], "id int, t int"), "id", "t"))
    assert "Partial" in text.split("WindowGroupLimit")[-1] and text.count("WindowGroupLimit") == 2


def test_fits_broadcast_counts_text(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 100, "id string")
    assert fits_broadcast(df, "id")
    assert not fits_broadcast(df, "id", limit=100_000)
    assert fits_broadcast(df.limit(0), "id", limit=0)


def test_touched_partitions(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, p string")
    new = spark.createDataFrame([(1, "d"), (9, None)], "id int, p string")
    assert {r.p for r in touched_partitions(old, new, "id", "p").collect()} == {"a", "d", None}


def test_many_false_candidates_are_dropped(spark, plan):
    import time

    old = spark.range(20_000).select(F.col("id"), F.lit("old").alias("v"))
    new = spark.createDataFrame([(5, "new")], "id long, v string")
    began = time.time()
    merged = merge_upsert(old, new, "id", hot_keys=range(5_000))
    text = plan(merged)
    assert time.time() - began < 20
    # None owns more rows than a task takes, so nothing is spread.
    assert "__pieces" not in text and "explode" not in text
    assert merged.count() == 20_000 and merged.where("v = 'new'").count() == 1


def test_hot_keys_are_cut_to_pieces_by_a_join(spark, plan, no_broadcast):
    old = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("k"), F.col("id").alias("v"))
    new = spark.createDataFrame([(7, -1), (103, -2), (None, -3)], "k long, v long")
    kept = merge_upsert(old, new, "k", hot_keys=[7, 101, 999], task_rows=100)
    assert sorted(r["v"] for r in kept.collect()) == sorted([-1, -2, -3, *[i for i in range(3_000) if i % 3 and i != 3 and i + 100 != 103]])
    text = plan(merge_upsert(old, new, "k", hot_keys=[7], task_rows=100).where("v >= 0"))
    assert "__pieces" in text and "LeftAnti" in text and "NestedLoop" not in text


NESTED_OLD = "id long, s struct<a: int, t: struct<x: string>>, l array<struct<b: int>>, m map<string, struct<c: int>>, d array<array<struct<e: int>>>"
NESTED_NEW = (
    "id long, s struct<n: date, a: long, t: struct<y: int, x: string>>, l array<struct<b: int, f: string>>, "
    "m map<string, struct<g: double, c: int>>, d array<array<struct<h: int, e: int>>>"
)


def test_nested_fields_are_filled(spark):
    old = spark.createDataFrame([(1, (1, ("x",)), [(1,), None], {"k": (5,), "n": None}, [[(7,)], None]), (2, None, None, None, None)], NESTED_OLD)
    new = spark.createDataFrame([(2, (dt.date(2024, 1, 1), 2**40, (9, "z")), [(3, "f")], {"q": (0.5, 6)}, [[(1, 2)]]), (3, (None, 3, None), [], {}, [])], NESTED_NEW)
    merged = merge_upsert(old, new, "id").orderBy("id")
    assert merged.select("s.*").columns == ["a", "t", "n"]
    assert merged.schema["s"].dataType["a"].dataType.simpleString() == "bigint"
    kind = merged.schema["l"].dataType.elementType
    assert kind.names == ["b", "f"] and merged.schema["m"].dataType.valueType.names == ["c", "g"]
    one, two, three = merged.collect()
    assert one["s"].asDict(True) == {"a": 1, "t": {"x": "x", "y": None}, "n": None}
    assert [x and tuple(x) for x in one["l"]] == [(1, None), None]
    assert tuple(one["m"]["k"]) == (5, None) and one["m"]["n"] is None
    assert one["d"] == [[(7, None)], None]
    assert two["s"].asDict(True) == {"a": 2**40, "t": {"x": "z", "y": 9}, "n": dt.date(2024, 1, 1)}
    assert [tuple(x) for x in two["l"]] == [(3, "f")] and tuple(two["m"]["q"]) == (6, 0.5) and two["d"] == [[(2, 1)]]
    assert three["s"].asDict(True) == {"a": 3, "t": None, "n": None} and three["l"] == [] and three["m"] == {}
    again = merge_upsert(merged, old, "id")
    assert again.schema["s"].dataType.names == ["a", "t", "n"] and again.count() == 3


def test_nested_fields_without_a_common_type_are_refused(spark):
    def frame(kind):
        return spark.createDataFrame([], f"k int, v {kind}")

    for a, b in (("struct<a:int,b:string>", "struct<a:date,b:string>"), ("array<struct<a:int>>", "array<struct<b:int>>"), ("array<struct<a:long>>", "array<struct<a:double,c:int>>")):
        with pytest.raises(TypeError, match="common type"):
            align_schemas(frame(a), frame(b))
    before, after = align_schemas(frame("struct<a:int,B:string>"), frame("struct<b:string,A:int,c:int>"))
    assert before.schema["v"].dataType.names == after.schema["v"].dataType.names == ["a", "B", "c"]


def test_old_rows_without_a_key_do_not_meet_in_one_task(spark, no_broadcast):
    old = spark.range(8_000).select(F.when(F.col("id") % 4 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    new = spark.range(0, 8_000, 400).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        held = merge_upsert(old, new, "k").where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in held) == 6_000 and len(held) == 8 and max(r["count"] for r in held) < 1_500
