"""Rows, columns and values that an earlier version lost without a word."""

import os

import pytest
from pyspark.sql import functions as F, types as T

from datamove.layout import Place
from datamove.operators import align_schemas, audit_differences, latest_per_key, merge_upsert, profile_columns
from datamove.plans.jobs import Flips, Job, run_group
from datamove.session import scratch_path
from datamove.sinks import merge_into_partitions, publish_warehouse, write_table
from datamove.sources import read_delimited
from datamove.streaming import Landing, files_once, ingest_files_once, replace_with_new_files


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_null_and_empty_are_one_partition(spark, place, tmp_path):
    old = spark.createDataFrame([(1, None), (2, None), (3, "A")], "id int, p string")
    write_table(old, place.table, place.path, partition_by="p")
    new = spark.createDataFrame([(9, ""), (3, "B")], "id int, p string")
    assert merge_into_partitions(place.table, new, "id", "p", f"{tmp_path}/b")
    assert rows(spark.table(place.table)) == [(1, None), (2, None), (3, "B"), (9, None)]
    assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {place.table}").collect()} == {"p=B", "p=__HIVE_DEFAULT_PARTITION__"}


def drop(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(lines) + "\n")


def test_batches_of_a_stopped_run_are_published_too(spark, place, tmp_path, monkeypatch):
    landing = Landing(f"{tmp_path}/in", "CSV", schema="k int")
    drop(landing.path, "a.csv", ["k", "0", "1", "2"])

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="stopped"):
        patch.setattr(files_once, "publish_ab", stop)
        replace_with_new_files(spark, landing, place, f"{tmp_path}/c")
    drop(landing.path, "b.csv", ["k", "10", "11"])
    assert rows(replace_with_new_files(spark, landing, place, f"{tmp_path}/c")) == [(0,), (1,), (10,), (11,), (2,)]
    drop(landing.path, "c.csv", ["k", "20"])
    assert rows(replace_with_new_files(spark, landing, place, f"{tmp_path}/c")) == [(20,)]
    assert rows(replace_with_new_files(spark, landing, place, f"{tmp_path}/c")) == [(20,)]


def test_a_table_with_a_stream_log_is_not_ingested_into(spark, place, tmp_path):
    landing = Landing(f"{tmp_path}/in", "CSV", schema="k int")
    drop(landing.path, "a.csv", ["k", "7"])
    stream = spark.readStream.schema("k int").csv(landing.path).writeStream.format("parquet").option("path", place.path)
    stream.option("checkpointLocation", f"{tmp_path}/own").trigger(availableNow=True).toTable(place.table).awaitTermination()
    before = spark.table(place.table).count()
    with pytest.raises(ValueError, match="log of its own"):
        ingest_files_once(spark, landing, place.table, place.path, f"{tmp_path}/c")
    assert spark.table(place.table).count() == before


def test_narrower_types_and_new_columns_are_refused(spark, place, tmp_path):
    write_table(spark.createDataFrame([(1, "a")], "v int, p string"), place.table, place.path, partition_by="p")
    for given, kinds in (((2.75, "a"), "v double, p string"), ((2, "a", 5), "v int, p string, x int"), ((2**40, "a"), "v long, p string")):
        with pytest.raises(TypeError, match="lacks the columns|common type"):
            write_table(spark.createDataFrame([given], kinds), place.table, place.path, mode="dynamic", partition_by="p")
    assert rows(spark.table(place.table)) == [(1, "a")]
    landing = Landing(f"{tmp_path}/in", "CSV", schema="k double")
    other = f"{place.database}.other"
    drop(landing.path, "a.csv", ["k", "2"])
    ingest_files_once(spark, Landing(landing.path, "CSV", schema="k int"), other, f"{place.path}_o", f"{tmp_path}/c")
    drop(landing.path, "b.csv", ["k", "2.75"])
    with pytest.raises(TypeError, match="does not hold"):
        ingest_files_once(spark, landing, other, f"{place.path}_o", f"{tmp_path}/c")


def test_columns_are_bound_by_the_header(spark, place, tmp_path):
    drop(f"{tmp_path}/in", "a.csv", ["v,k", "x,1"])
    assert rows(read_delimited(spark, f"{tmp_path}/in", schema="k int, v string")) == [(1, "x")]
    drop(f"{tmp_path}/in", "b.csv", ["k,v", "2,y"])
    with pytest.raises(Exception, match="FAILED_READ_FILE|(?i:header)"):
        read_delimited(spark, f"{tmp_path}/in", schema="k int, v string").collect()
    assert rows(read_delimited(spark, f"{tmp_path}/in", schema="k int, v string", mixed_headers=True)) == [(1, "x"), (2, "y")]
    landing = Landing(f"{tmp_path}/in", "CSV", schema="k string, v string")
    assert rows(ingest_files_once(spark, landing, place.table, place.path, f"{tmp_path}/c")) == [("1", "x"), ("2", "y")]


def test_a_longer_column_list_reaches_the_warehouse(spark, place):
    df = spark.createDataFrame([(1, "a")], "k int, x string")
    for columns in ("k int", "(k int)", "k int, x string", "k int, x string"):
        publish_warehouse(df, place, columns)
    assert rows(spark.table(place.table)) == [(1, "a")]
    with pytest.raises(ValueError, match="nothing to load"):
        publish_warehouse(df, place, "k int, x string, y int")


def test_types_that_would_round_have_nothing_in_common(spark):
    def frame(kind):
        return spark.createDataFrame([], f"k int, v {kind}")

    for a, b in (("long", "double"), ("decimal(30,2)", "double"), ("decimal(38,0)", "decimal(38,10)"), ("array<long>", "array<double>"), ("struct<a:int>", "struct<b:int>")):
        with pytest.raises(TypeError, match="common type"):
            align_schemas(frame(a), frame(b))
    for a, b in (("int", "long"), ("int", "double"), ("float", "double"), ("long", "decimal(20,0)"), ("array<int>", "array<long>")):
        align_schemas(frame(a), frame(b))


def test_keys_with_a_dot(spark, no_broadcast):
    old = spark.createDataFrame([(1, 1), (2, 1)], T.StructType([T.StructField("a.b", T.IntegerType()), T.StructField("v", T.IntegerType())]))
    new = old.where("v = 1").limit(1).withColumn("v", F.lit(5))
    assert merge_upsert(old, new, "a.b").count() == 2
    assert latest_per_key(old, "a.b", "v").count() == 2


def test_extremes_are_compared_whole(spark):
    def profile(end, **options):
        return profile_columns(spark.createDataFrame([("x" * 150 + end,)], "t string"), "s", "a", "b", **options)

    assert audit_differences(profile("a"), profile("b")).first()["matches"]
    assert not audit_differences(profile("a", text_limit=None), profile("b", text_limit=None)).first()["matches"]


def test_scratch_needs_a_shared_folder_beyond_one_machine():
    class Session:
        class conf:
            get = staticmethod(lambda key, default: None)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="share"):
        scratch_path(Session, "x")
    Session.sparkContext.master = "local[4]"
    assert "x-" in scratch_path(Session, "x")


def test_reading_tasks_stay_when_few_rows_are_written(spark, place):
    df = spark.range(6400, numPartitions=64)
    write_table(df.withColumn("task", F.spark_partition_id()), place.table, place.path, rows=6400)
    assert spark.table(place.table).select("task").distinct().count() == 64


def test_flips_outlive_a_run_and_alternate(spark, place, tmp_path):
    flips = Flips(spark, Place(f"{tmp_path}/flips", place.database, "flips", "flips_tv"))
    job = Job("g", 1, "P", None, "s", "o", "w", "t", "k int", None, None, True, False, False, "a", "b", "LAKE", "DB", None, None, 1, 0)
    control = {"jobs": job}
    seen = []

    def run(job):
        seen.append(job.pb_flip)
        return {None: "_a", "_a": "_b", "_b": "_a"}[job.pb_flip]

    import datamove.plans.jobs as jobs

    before = jobs.to_jobs, jobs.jobs_for_group
    jobs.to_jobs, jobs.jobs_for_group = lambda frame: [frame], lambda control, group: control["jobs"]
    try:
        results = [run_group(control, "g", run, flips)[0].result for _ in range(3)]
    finally:
        jobs.to_jobs, jobs.jobs_for_group = before
    assert seen == [None, "_a", "_b"] and results == ["_a", "_b", "_a"]


def test_an_append_writes_its_own_rows_only(spark, place, monkeypatch):
    import glob

    from datamove.sinks import publish

    monkeypatch.setattr(publish, "MOST_PARTS", 2)

    def files():
        return set(glob.glob(f"{place.path}*/**/*.parquet", recursive=True))

    assert publish.publish_ab(spark.range(1000), place) == "_a"
    for i in range(2):
        before = files()
        assert publish.publish_ab(spark.range(1000 + i, 1001 + i), place, incremental=True) == "_a"
        assert before < files() and spark.table(place.table).count() == 1001 + i
    # Two parts are due to become one copy.
    assert publish.publish_ab(spark.range(1002, 1003), place, incremental=True) == "_b"
    assert publish.publish_ab(spark.range(1003, 1004), place, incremental=True) == "_b"
    assert spark.table(place.table).count() == 1004
    assert publish.publish_ab(spark.range(5), place) == "_a"
    assert spark.table(place.table).count() == 5 and not spark.catalog.tableExists(f"{place.database}.{place.name}_a_p0")
