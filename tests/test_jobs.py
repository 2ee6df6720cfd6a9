import datetime as dt
import os

import pytest

from datamove.plans import Job, RawLoad, jobs_for_group, load_raw, record_flip, run_group, run_job, to_jobs
from datamove.sources import JdbcSource, ParquetSource

DAY = dt.datetime(2024, 1, 1)
SCHEMA = "Id long, v string, update_timestamp timestamp"


def source(spark, path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{path}/db.t")
    return ParquetSource(location=f"{path}/{{table}}")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"buckets": 4}, {"spread_hot_keys": False}, {"overlap": dt.timedelta(days=1)}])
def test_full_then_increments(spark, place, tmp_path, options):
    load = RawLoad("db.t", place, key="Id", incremental=True, normalize=True, **options)
    first = source(spark, f"{tmp_path}/1", [(1, "a", DAY), (2, "b", DAY)])
    assert (load_raw(spark, first, load).kind, spark.table(place.table).columns[0]) == ("full", "id")
    next_day = DAY + dt.timedelta(days=1)
    second = source(spark, f"{tmp_path}/2", [(1, "a", DAY), (2, "B", next_day), (3, "c", next_day)])
    result = load_raw(spark, second, load)
    assert (result.kind, result.rows) == ("merged", 3)
    assert [r[:2] for r in rows(spark.table(place.table))] == [(1, "a"), (2, "B"), (3, "c")]
    again = load_raw(spark, second, load)
    assert again.kind == ("merged" if "overlap" in options else "unchanged") and again.rows == 3
    third = source(spark, f"{tmp_path}/3", [(3, "C", next_day + dt.timedelta(days=1))])
    load_raw(spark, third, load)
    assert [r[:2] for r in rows(spark.table(place.table))] == [(1, "a"), (2, "B"), (3, "C")]


@pytest.mark.parametrize("buckets", [0, 4])
def test_merge_without_broadcast(spark, place, tmp_path, monkeypatch, no_broadcast, buckets):
    import datamove.plans.raw as module

    monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    load = RawLoad("db.t", place, key="id", incremental=True, buckets=buckets)
    schema = "id long, v string, update_timestamp timestamp"
    load_raw(spark, source(spark, f"{tmp_path}/1", [(i, "o", DAY) for i in range(50)], schema), load)
    later = [(i, "n", DAY + dt.timedelta(1)) for i in range(40, 60)]
    assert load_raw(spark, source(spark, f"{tmp_path}/2", later, schema), load).rows == 60
    table = spark.table(place.table)
    assert table.where("id = 45").first().v == "n" and table.groupBy("v").count().count() == 2


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_noted_watermark_is_the_newest_change(spark, place, tmp_path, kind, monkeypatch):
    import datamove.plans.raw as module

    load = RawLoad("db.t", place, key="id", incremental=True)
    schema = f"id string, update_timestamp {kind}"
    load_raw(spark, source(spark, f"{tmp_path}/1", [("a", DAY)], schema), load)
    second = source(spark, f"{tmp_path}/2", [("b", DAY + dt.timedelta(hours=1)), ("c", None)], schema)
    assert load_raw(spark, second, load).kind == "merged"
    # From here on the note is used, not the table.
    monkeypatch.setattr(module, "high_watermark", None)
    assert load_raw(spark, second, load).kind == "unchanged"
    third = source(spark, f"{tmp_path}/3", [("d", DAY + dt.timedelta(hours=1, microseconds=1))], schema)
    assert load_raw(spark, third, load).rows == 3


def test_newest_of_several_changes(spark, place, tmp_path):
    load = RawLoad("db.t", place, key="id", incremental=True, latest_only=True)
    schema = "id long, v string, update_timestamp timestamp"
    load_raw(spark, source(spark, f"{tmp_path}/1", [(1, "a", DAY)], schema), load)
    changes = [(1, f"v{n}", DAY + dt.timedelta(n)) for n in (1, 3, 2)]
    assert load_raw(spark, source(spark, f"{tmp_path}/2", changes, schema), load).rows == 1
    assert spark.table(place.table).first().v == "v3"


def test_columns_come_and_go(spark, place, tmp_path):
    load = RawLoad("db.t", place, key="id", incremental=True)
    schema = "id long, v string, update_timestamp timestamp"
    load_raw(spark, source(spark, f"{tmp_path}/1", [(1, "a", DAY)], schema), load)
    changed = source(spark, f"{tmp_path}/2", [(2, 5, DAY + dt.timedelta(1))], "id long, w int, update_timestamp timestamp")
    load_raw(spark, changed, load)
    assert spark.table(place.table).columns == ["id", "v", "update_timestamp", "w"]
    assert rows(spark.table(place.table).select("id", "v", "w")) == [(1, "a", None), (2, None, 5)]


def test_needs_a_key_and_rows(spark, place, tmp_path):
    empty = source(spark, str(tmp_path), [])
    with pytest.raises(ValueError, match="needs a key"):
        load_raw(spark, empty, RawLoad("db.t", place, incremental=True))
    for key in (None, "Id"):
        with pytest.raises(ValueError, match="no rows extracted"):
            load_raw(spark, empty, RawLoad("db.t", place, key=key))
    assert not spark.catalog.tableExists(place.table)


def test_partition_merge_leaves_other_copies_alone(spark, place, tmp_path):
    schema = "id long, p string, update_timestamp timestamp"
    load = RawLoad("db.t", place, key="id", incremental=True, partition_by="p", in_partitions=True)
    load_raw(spark, source(spark, f"{tmp_path}/1", [(1, "a", DAY), (2, "b", DAY)], schema), load)
    moved = [(1, "b", DAY + dt.timedelta(1))]
    assert load_raw(spark, source(spark, f"{tmp_path}/2", moved, schema), load).rows == 2
    assert rows(spark.table(place.table).select("id", "p")) == [(1, "b"), (2, "b")]
    # The version before stays for rollback, and no other copy is made.
    assert os.path.isdir(f"{place.path}/v0/p=a") and not os.path.exists(f"{place.path}_b")
    # A new column makes it fall back to rewriting the table.
    wider = [(3, "c", DAY + dt.timedelta(2), 1)]
    load_raw(spark, source(spark, f"{tmp_path}/3", wider, schema + ", w int"), load)
    assert rows(spark.table(place.table).select("id", "p", "w")) == [(1, "b", None), (2, "b", None), (3, "c", 1)]


def test_load_from_a_database(spark, place, tmp_path, monkeypatch):
    """The database is stood in for by views; what it would be asked runs as Spark SQL."""
    asked = []

    def load(self, spark, by_timestamp, **options):
        asked.append(options)
        return spark.sql(options["query"]) if "query" in options else spark.table(options["dbtable"])

    monkeypatch.setattr(JdbcSource, "_load", load)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS crm LOCATION '{tmp_path}/crm'")
    spark.createDataFrame([(1, "a", DAY), (9, None, DAY)], SCHEMA).write.mode("overwrite").saveAsTable("crm.people")
    job = RawLoad("crm.people", place, key="Id", source_partitions=4, normalize=True, audit=True, request_id=3)
    assert load_raw(spark, JdbcSource("ORACLE", "u", "u", "p"), job).rows == 2
    assert any(o.get("partitionColumn") == "Id" and o.get("numPartitions") == "4" for o in asked)
    audit = spark.table(f"{place.database}.meta_audit_table")
    assert rows(audit.where("column_name = 'v'").select("source", "min", "max", "count", "request_id")) == [
        ("lake", "a", "a", 1, 3),
        ("oracle", "a", "a", 1, 3),
    ]
    assert any("COUNT(DISTINCT v)" in o.get("query", "") for o in asked)


def control(spark):
    def table(rows, schema):
        return spark.createDataFrame(rows, schema)

    return {
        "meta_logical_map": table([("g1", "src", "dst", "acme")], "logical_group_id string, obj_source string, obj_target string, group_name string"),
        "meta_object_connection_map": table(
            [("src", "ORACLE", "s1"), ("dst", "POSTGRES", "s2")], "obj_connection string, connection_type string, secret_key string"
        ),
        "meta_table_map": table(
            [
                ("g1", 20, "C", None, "sales", "t", None, "t", "SELECT v, count(*) AS n FROM {raw} GROUP BY v", False, None, False, False, False, True),
                ("g1", 10, "R", "QY", "db", "t", None, None, None, True, None, False, False, True, True),
                ("g1", 30, "P", None, "sales", "t", "acme", "t", "(v string, n bigint)", False, None, False, False, False, True),
                ("g1", 5, "R", "TB", "db", "off", None, None, None, False, None, False, False, False, False),
                ("g2", 1, "R", "TB", "db", "t", None, None, None, False, None, False, False, False, True),
            ],
            "logical_group_id string, run_priority int, storage_layer string, extract_type string, obj_schema string, obj_name string, target_obj_schema string, "
            "target_obj_name string, transform_query string, custom_flag boolean, delimiter_val string, inc_header boolean, is_incremental boolean, "
            "to_validate boolean, is_valid boolean",
        ),
        "meta_object_flip": table([("acme", "t", "_a", "_b")], "target_obj_schema string, target_obj_name string, conformance_flip string, pb_flip string"),
        "meta_custom_query": table([("g1", "db", "t", "SELECT * FROM src_t"), ("g1", "sales", "t", "ignored")], "logical_group_id string, obj_schema string, obj_name string, custom_query string"),
        "meta_raw_properties": table(
            [("g1", "db", "t", False, "id", True, "p", 8, 3)],
            "logical_group_id string, obj_schema string, obj_name string, source_partition_flag boolean, source_primary_key string, "
            "target_partition_flag boolean, target_partition_column string, source_partitions int, target_partitions int",
        ),
    }


def test_jobs_of_a_group(spark):
    jobs = to_jobs(jobs_for_group(control(spark), "g1"))
    assert [(j.run_priority, j.storage_layer) for j in jobs] == [(10, "R"), (20, "C"), (30, "P")]
    raw, conform, publish = jobs
    assert (raw.group_name, raw.obj_source, raw.source_connection_type, raw.target_connection_type) == ("acme", "src", "ORACLE", "POSTGRES")
    # The key is hidden while its flag is off; the custom query while its flag is off.
    assert (raw.source_primary_key, raw.target_partition_column, raw.source_partitions, raw.target_partitions) == (None, "p", 8, 3)
    assert (raw.custom_query, conform.custom_query) == ("SELECT * FROM src_t", None)
    assert (conform.source_partitions, conform.target_partitions) == (1, 0)
    assert (publish.pb_flip, raw.pb_flip) == ("_b", None)


def test_group_runs_in_order_and_goes_on_after_a_failure(spark):
    ran = []

    def run(job):
        ran.append(job.run_priority)
        if job.storage_layer == "C":
            raise RuntimeError("broken")

    outcomes = run_group(control(spark), "g1", run)
    assert ran == [10, 20, 30]
    assert [str(o.error) if o.error else None for o in outcomes] == [None, "broken", None]
    with pytest.raises(ValueError, match="no valid jobs"):
        run_group(control(spark), "nobody", run)


def test_layers_end_to_end(spark, layout, tmp_path):
    from dataclasses import replace

    spark.createDataFrame([(1, "x", "p1"), (2, "x", "p2"), (3, "y", "p1")], "id int, v string, p string").createOrReplaceTempView("src_t")
    raw_table = layout.raw("acme", "db", "t").table

    def run(job):
        if job.transform_query:
            job = replace(job, transform_query=job.transform_query.replace("{raw}", raw_table))
        return run_job(spark, job, layout, {"src": ParquetSource(location=f"{tmp_path}/{{table}}")}, request_id=1)

    spark.sql("DROP DATABASE IF EXISTS acme CASCADE")
    outcomes = run_group(control(spark), "g1", run)
    assert [o.error for o in outcomes] == [None, None, None]
    assert rows(spark.table("acme.t_tv")) == [("x", 2), ("y", 1)]


def job(**changes):
    base = dict.fromkeys(Job.__dataclass_fields__) | {
        "group_name": "acme", "inc_header": True, "is_incremental": True, "to_validate": False, "source_partitions": 1, "target_partitions": 0,
    }
    return Job(**(base | changes))


@pytest.mark.parametrize("incremental, expected", [(True, [1, 2, 3]), (False, [3])])
def test_file_jobs(spark, layout, incremental, expected):
    landing = layout.landing("acme", "web")
    os.makedirs(landing)
    files = job(storage_layer="F", extract_type="CS", obj_schema="web", obj_name="hits", target_obj_schema="web",
                target_obj_name="hits", is_incremental=incremental, delimiter_val=";")
    for name, text in (("hits1.csv", "v;w\n1;a\n2;b\n"), ("hits2.csv", "v;w\n3;c\n")):
        with open(f"{landing}/{name}", "w") as f:
            f.write(text)
        table = run_job(spark, files, layout, {}, schema="v int, w string")
    assert sorted(r.v for r in table.collect()) == expected


def test_bad_codes(spark, layout):
    with pytest.raises(ValueError, match="unknown storage layer"):
        run_job(spark, job(storage_layer="X"), layout, {})
    with pytest.raises(ValueError, match="unknown extract type"):
        run_job(spark, job(storage_layer="R", extract_type="ZZ"), layout, {})


def test_flip_is_recorded_or_added(spark):
    flips = control(spark)["meta_object_flip"]
    known = job(target_obj_schema="acme", target_obj_name="t")
    fresh = job(target_obj_schema="acme", target_obj_name="new")
    assert rows(record_flip(flips, known, "_a")) == [("acme", "t", "_a", "_a")]
    assert rows(record_flip(flips, fresh, "_a")) == [("acme", "new", None, "_a"), ("acme", "t", "_a", "_b")]


def test_options_of_jobs(spark):
    from dataclasses import replace

    from datamove.plans.jobs import FILE_OPTIONS, RAW_OPTIONS, job_options

    rows = [("g1", "db", "t", "overlap", "90"), ("g1", "db", "t", "dates", "a, b"), ("g1", "db", "t", "latest_only", "True"), ("g1", "other", "t", "slices", "4")]
    kind = "logical_group_id string, obj_schema string, obj_name string, option_name string, option_value string"
    tables = control(spark) | {"meta_load_options": spark.createDataFrame(rows, kind)}
    job = to_jobs(jobs_for_group(tables, "g1"))[0]
    assert job_options(job, RAW_OPTIONS) == {"overlap": dt.timedelta(minutes=90), "dates": ("a", "b"), "latest_only": True}
    assert to_jobs(jobs_for_group(control(spark), "g1"))[0].options is None
    with pytest.raises(ValueError, match="unknown options"):
        job_options(job, FILE_OPTIONS)
    with pytest.raises(ValueError, match="true or false"):
        job_options(replace(job, options={"latest_only": "yes"}), RAW_OPTIONS)


def test_date_watermarks_are_noted(spark, place, tmp_path):
    schema = "id long, update_timestamp date"
    load = RawLoad("db.t", place, key="id", incremental=True)
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    load_raw(spark, source(spark, f"{tmp_path}/1", [(1, days[0])], schema), load)
    assert load_raw(spark, source(spark, f"{tmp_path}/2", [(2, days[1])], schema), load).kind == "merged"
    noted = spark.sql(f"SHOW TBLPROPERTIES {place.table}").where("key = 'datamove.watermark'").first()
    assert noted["value"] == "2024-01-02"
    feed = source(spark, f"{tmp_path}/3", [(2, days[1]), (3, days[2])], schema)
    assert load_raw(spark, feed, load).rows == 3
    assert load_raw(spark, feed, load).kind == "unchanged"


@pytest.mark.parametrize("balanced", [False, True])
def test_ranges_of_an_increment_are_those_of_its_rows(spark, place, tmp_path, balanced):
    from dataclasses import dataclass

    from datamove.plans import raw
    from datamove.sources import JdbcSource

    asked = []

    @dataclass(frozen=True)
    class Recorded(JdbcSource):
        def table(self, spark, table, by_timestamp=False):
            return spark.createDataFrame([], "id long, update_timestamp timestamp")

        def bounds(self, spark, table, key):
            asked.append(table)
            return spark.createDataFrame([(1, 9, 9)], "lo long, hi long, n long")

        def ranges(self, spark, table, key, bounds, partitions, by_timestamp=False):
            asked.append(table)
            return self.table(spark, table)

        def cuts(self, spark, table, key, partitions):
            asked.append(table)
            return []

    source = Recorded("ORACLE", "u", "n", "p")
    load = RawLoad("s.t", place, key="id", incremental=True, source_partitions=4, balanced=balanced)
    raw._extract(spark, source, load)
    assert set(asked) == {"s.t"}
    asked.clear()
    raw._extract(spark, source, load, True, dt.datetime(2024, 1, 2, 3))
    assert set(asked) == {"(SELECT * FROM s.t WHERE update_timestamp > TIMESTAMP '2024-01-02 03:00:00') changed"}
