import pytest

from datamove.layout import Layout, backup_path
from datamove.sinks import JdbcWarehouse, active_copy, next_copy, publish_ab, publish_warehouse
from datamove.sources import JdbcSource


def test_flip():
    assert [next_copy(s) for s in (None, "_a", "_b", "_fixed")] == ["_a", "_b", "_a", "_fixed"]


def test_copies_alternate_and_the_last_one_stays(spark, place):
    assert active_copy(spark, place) is None
    for n, suffix in ((1, "_a"), (2, "_b"), (3, "_a")):
        assert publish_ab(spark.range(n), place) == suffix
        assert active_copy(spark, place) == suffix
        assert spark.table(place.table).count() == n
    assert spark.read.parquet(place.path + "_b").count() == 2


def test_failed_write_changes_nothing(spark, place):
    publish_ab(spark.range(2), place)
    with pytest.raises(Exception):
        publish_ab(spark.range(3).selectExpr("raise_error('broken') AS id"), place)
    assert spark.table(place.table).count() == 2 and active_copy(spark, place) == "_a"


def test_empty_is_refused_unless_allowed(spark, place):
    publish_ab(spark.range(2), place)
    with pytest.raises(ValueError, match="empty"):
        publish_ab(spark.range(0), place)
    assert spark.table(place.table).count() == 2
    publish_ab(spark.range(0), place, allow_empty=True)
    assert spark.table(place.table).isEmpty()


def test_name_taken_by_a_table(spark, place):
    spark.range(1).write.saveAsTable(place.table)
    with pytest.raises(ValueError, match="is a table"):
        publish_ab(spark.range(2), place)


def test_incremental_publish_survives_the_flip_and_new_columns(spark, place):
    publish_ab(spark.range(2), place)
    publish_ab(spark.range(2, 4), place, incremental=True)
    publish_ab(spark.range(4, 5).selectExpr("id", "'x' AS note"), place, incremental=True)
    assert [tuple(r) for r in spark.table(place.table).orderBy("id").collect()] == [
        (0, None),
        (1, None),
        (2, None),
        (3, None),
        (4, "x"),
    ]


def test_view_prunes_partitions(spark, place, plan):
    publish_ab(spark.range(10).selectExpr("id", "id % 2 AS p"), place, partition_by="p")
    assert "PartitionFilters: [isnotnull(p" in plan(spark.table(place.table).where("p = 1"))


def test_warehouse_truncates_and_loads_by_name(spark, place):
    for n, suffix in ((3, "_a"), (2, "_b"), (1, "_a")):
        df = spark.range(n).selectExpr("'x' AS note", "id")
        assert publish_warehouse(df, place, "(id bigint, note varchar(10))") == suffix
        assert spark.table(place.table).columns == ["id", "note"]
        assert spark.table(place.table).count() == n


def test_jdbc_warehouse_checks_before_repointing(spark, monkeypatch):
    written, executed = {}, []
    warehouse = JdbcWarehouse(JdbcSource("POSTGRES", "u", "u", "p"), "dw")
    monkeypatch.setattr(JdbcWarehouse, "_load", lambda self, df, options: written.update(options))
    monkeypatch.setattr(JdbcWarehouse, "_execute", lambda self, spark, sql: executed.append(sql))
    monkeypatch.setattr(JdbcSource, "query", lambda self, spark, sql: spark.sql("SELECT 3 AS n"))
    assert warehouse.publish(spark.range(3), "t", "t_tv", "_a", "(id bigint)") == "_b"
    assert written["dbtable"] == "dw.t_b" and written["truncate"] == "true"
    assert written["createTableColumnTypes"] == "id bigint"
    assert executed == ["CREATE OR REPLACE VIEW dw.t_tv AS SELECT * FROM dw.t_b"]
    with pytest.raises(RuntimeError, match="holds 3 rows after loading 2"):
        warehouse.publish(spark.range(2), "t", "t_tv", "_b")
    assert len(executed) == 1


def test_layout():
    import datetime as dt

    layout = Layout()
    raw = layout.raw("acme", "sales", "orders")
    assert (raw.path, raw.table) == ("s3://acme-raw-dev/sales/orders", "acme_raw_dev.sales__orders")
    conformed = layout.conformance("acme", "orders")
    assert (conformed.path, conformed.table) == ("s3://acme-conformance-dev/orders", "acme_conformance_dev.orders_tv")
    assert layout.published("acme", "orders").table == "acme.orders_tv"
    assert layout.landing("acme", "sales") == "s3://acme-landing-dev/sales"
    assert backup_path("s3://b/x/t", dt.datetime(2024, 12, 31, 23, 5, 9)) == "s3://b/x/backup/20241231_230509/t"
