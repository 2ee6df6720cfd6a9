import glob
import os

import pytest
from pyspark.sql import functions as F

from datamove.operators import merge_upsert
from datamove.sinks import tables
from datamove.sinks import merge_into_partitions, plan_output_files, run_transform, snapshot_copy, write_table


def files(path):
    return glob.glob(f"{path}/**/*.parquet", recursive=True)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_output_sizing():
    got = [plan_output_files(n) for n in (0, 999_999, 1_000_000, 2_500_000, 200_000_000, 500_000_000)]
    assert got == [1, 1, 1, 2, 200, 200]
    assert plan_output_files(5, explicit=7) == 7


def test_file_counts(spark, place):
    df = spark.range(100).repartition(8)
    write_table(df, place.table, place.path, rows=100)
    assert len(files(place.path)) == 1
    write_table(df, place.table, place.path, files=3)
    assert len(files(place.path)) == 3
    write_table(df, place.table, place.path, files=50)
    assert len(files(place.path)) == 8
    # The rule's upper limit is not one on tasks: so many rows want so many files.
    write_table(df, place.table, place.path, rows=30_000_000)
    assert len(files(place.path)) == 30


def test_append_and_overwrite(spark, place):
    write_table(spark.range(3), place.table, place.path)
    write_table(spark.range(2), place.table, place.path, mode="append")
    assert spark.table(place.table).count() == 5
    write_table(spark.range(2), place.table, place.path)
    assert spark.table(place.table).count() == 2


def test_bad_modes(spark, place):
    with pytest.raises(ValueError, match="unknown write mode"):
        write_table(spark.range(1), place.table, place.path, mode="upsert")
    with pytest.raises(ValueError, match="needs partition_by"):
        write_table(spark.range(1), place.table, place.path, mode="dynamic")


def test_partitions_prune(spark, place, plan):
    write_table(spark.range(10).withColumn("p", F.col("id") % 2), place.table, place.path, partition_by="p")
    df = spark.table(place.table).where("p = 1")
    assert df.count() == 5
    assert "PartitionFilters: [isnotnull(p" in plan(df)
    assert spark.sql(f"SHOW PARTITIONS {place.table}").count() == 2


def test_dynamic_overwrite_keeps_other_partitions(spark, place):
    old = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, p string")
    write_table(old, place.table, place.path, partition_by="p")
    new = spark.createDataFrame([(9, "a"), (8, "c")], "id int, p string")
    write_table(new, place.table, place.path, mode="dynamic", partition_by="p")
    assert rows(spark.table(place.table)) == [(3, "b"), (8, "c"), (9, "a")]


def test_partitioned_write_groups_by_value(spark, place):
    df = spark.range(1000).repartition(8).withColumn("p", F.col("id") % 4)
    write_table(df, place.table, place.path, partition_by="p")
    assert len(files(place.path)) == 4


def test_moved_row_leaves_no_stale_copy(spark, place, tmp_path):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "id int, p string, v string")
    write_table(old, place.table, place.path, partition_by="p")
    untouched = {f: os.stat(f).st_mtime_ns for f in files(f"{place.path}/p=c")}
    # The only row of partition a moves to b; it's in a value that needs quoting.
    new = spark.createDataFrame([(1, "it's\\", "X")], "id int, p string, v string")
    assert merge_into_partitions(place.table, new, "id", "p", f"{tmp_path}/backup")
    assert rows(spark.table(place.table).select("id", "p", "v")) == [(1, "it's\\", "X"), (2, "b", "y"), (3, "c", "z")]
    assert {f: os.stat(f).st_mtime_ns for f in files(f"{place.path}/p=c")} == untouched
    assert rows(spark.read.parquet(f"{tmp_path}/backup").select("id")) == [(1,)]


def test_partition_merge_agrees_with_full_merge(spark, place, tmp_path):
    old = spark.range(200).select(F.expr("nullif(id, -1)").alias("id"), (F.col("id") % 5).cast("int").alias("p"), F.expr("nullif('o', '')").alias("v"))
    old = old.unionByName(spark.createDataFrame([(None, 3, "n"), (500, None, "q")], old.schema))
    write_table(old, place.table, place.path, partition_by="p")
    new = spark.createDataFrame([(5, 1, "N"), (7, None, "N"), (500, 2, "N"), (None, 4, "N"), (900, 77, "N")], old.schema)
    assert merge_into_partitions(place.table, new, "id", "p", f"{tmp_path}/backup")
    assert rows(spark.table(place.table).select("id", "p", "v")) == rows(merge_upsert(old, new, "id"))


def test_partition_merge_declines_what_it_cannot_do(spark, place, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    write_table(old, place.table, place.path, partition_by="p")
    more = spark.createDataFrame([(1, "a", 5)], "id int, p string, extra int")
    assert not merge_into_partitions(place.table, more, "id", "p", f"{tmp_path}/b1")
    other = spark.createDataFrame([(1, "a")], "id long, p string")
    assert not merge_into_partitions(place.table, other, "id", "p", f"{tmp_path}/b3")
    wide = spark.createDataFrame([(1, "c"), (2, "d")], "id int, p string")
    assert not merge_into_partitions(place.table, wide, "id", "p", f"{tmp_path}/b2", most=3)
    assert rows(spark.table(place.table)) == rows(old)


def test_bucketed_table_is_not_shuffled_by_a_merge(spark, place, plan, no_broadcast):
    old = spark.range(100).withColumn("v", F.lit("o"))
    write_table(old, place.table, place.path, bucket_by=(4, "id"))
    assert len(files(place.path)) == 4
    new = spark.range(50, 60).withColumn("v", F.lit("n"))
    join = plan(merge_upsert(spark.table(place.table), new, "id", co_located=True)).split("LeftAnti")[1]
    left = join.split("Bucketed: true")[0]
    assert "Exchange" not in left


def test_snapshot_keeps_partition_values(spark, tmp_path):
    df = spark.createDataFrame([(1, "01", "x"), (2, "1", None)], "id int, p string, q string")
    df.write.partitionBy("p", "q").parquet(f"{tmp_path}/t")
    snapshot_copy(spark, f"{tmp_path}/t", f"{tmp_path}/c", ["p", "q"])

    def parts(d):
        return sorted(os.path.relpath(os.path.dirname(f), d) for f in files(d))

    assert parts(f"{tmp_path}/c") == parts(f"{tmp_path}/t")
    assert parts(f"{tmp_path}/c") == ["p=01/q=x", "p=1/q=__HIVE_DEFAULT_PARTITION__"]


def test_transform_overwrites_and_appends(spark, place):
    assert run_transform(spark, "SELECT 1 AS a", place.table, place.path).count() == 1
    assert run_transform(spark, "SELECT 2 AS a", place.table, place.path, incremental=True).count() == 2
    assert run_transform(spark, "SELECT 3 AS a", place.table, place.path).first().a == 3


@pytest.mark.parametrize("partitions", [1, 8, 40])
def test_files_follow_the_rows_alone(spark, place, monkeypatch, partitions):
    monkeypatch.setattr(tables, "ROWS_PER_FILE", 1000)
    for rows, files in ((10, 1), (1999, 1), (2000, 2), (7500, 7)):
        write_table(spark.range(rows).repartition(partitions), place.table, place.path, rows=rows)
        assert spark.table(place.table).select(F.input_file_name()).distinct().count() == files
        assert spark.table(place.table).count() == rows
