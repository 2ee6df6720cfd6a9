import pytest
from pyspark.sql import functions as F

from datamove.sources import (
    CatalogSource,
    JdbcSource,
    ParquetSource,
    extract_balanced,
    extract_keyrange,
    extract_query,
    extract_table,
    key_bounds,
    key_range,
    range_of,
)
from datamove.sources.extract import DRIVERS, Bounds


class RecordingReader:
    """Stands in for ``spark.read``: keeps what a JDBC read would be given."""

    def __init__(self):
        self.given = {}

    read = property(lambda self: self)

    def format(self, name):
        self.given["format"] = name
        return self

    def options(self, **options):
        self.given |= options
        return self

    def load(self):
        return self.given


def oracle_source():
    return JdbcSource("ORACLE", "jdbc:oracle:thin:@//example/db", "someone", "hidden-word")


def test_jdbc_table_and_query_options():
    given = extract_table(RecordingReader(), oracle_source(), "s.t")
    assert given == {
        "format": "jdbc",
        "url": "jdbc:oracle:thin:@//example/db",
        "user": "someone",
        "password": "hidden-word",
        "driver": "oracle.jdbc.OracleDriver",
        "fetchsize": "100000",
        "dbtable": "s.t",
    }
    given = extract_query(RecordingReader(), oracle_source(), "select 1 from dual")
    assert given["query"] == "select 1 from dual" and "dbtable" not in given


def test_oracle_sets_its_timestamp_format_for_increments_only():
    assert "NLS_TIMESTAMP_FORMAT" in extract_table(RecordingReader(), oracle_source(), "t", True)["sessionInitStatement"]
    other = JdbcSource("POSTGRES", "u", "u", "p")
    assert "sessionInitStatement" not in extract_table(RecordingReader(), other, "t", True)


def test_jdbc_key_ranges():
    given = extract_keyrange(RecordingReader(), oracle_source(), "t", "id", 4, Bounds(2**60, 2**60 + 99, 100))
    assert {k: given[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions", "dbtable")} == {
        "partitionColumn": "id",
        "lowerBound": str(2**60),
        "upperBound": str(2**60 + 100),
        "numPartitions": "4",
        "dbtable": "t",
    }
    empty = extract_keyrange(RecordingReader(), oracle_source(), "t", "id", 4, Bounds(None, None, 0))
    assert "partitionColumn" not in empty


def test_connection_values_do_not_show():
    text = repr(oracle_source())
    assert "hidden-word" not in text and "someone" not in text and "example" not in text


@pytest.mark.parametrize("dialect", DRIVERS)
def test_dialects(dialect):
    assert JdbcSource(dialect, "u", "u", "p").connection()["driver"] == DRIVERS[dialect]


def test_unknown_dialect():
    with pytest.raises(ValueError, match="unknown dialect"):
        JdbcSource("DBASE", "u", "u", "p")


def test_bounds(spark):
    spark.createDataFrame([(2**53 + 1,), (None,), (5,)], "id long").createOrReplaceTempView("bounds_t")
    assert key_bounds(spark, CatalogSource(), "bounds_t", "id") == (5, 2**53 + 1, 3)
    spark.createDataFrame([], "id long").createOrReplaceTempView("bounds_e")
    assert key_bounds(spark, CatalogSource(), "bounds_e", "id") == (None, None, 0)


@pytest.mark.parametrize("partitions", [1, 3, 7, 100])
def test_ranges_cover_the_table_without_overlap(spark, tmp_path, partitions):
    spark.createDataFrame([(i,) for i in [-7, -1, 0, 3, 4, 50, 51]] + [(None,)], "id long").write.parquet(f"{tmp_path}/t")
    source = ParquetSource(location=f"{tmp_path}/{{table}}")
    bounds = key_bounds(spark, source, "t", "id")
    found = extract_keyrange(spark, source, "t", "id", partitions, bounds)
    numbered = found.select("id", key_range("id", bounds, partitions).alias("r")).collect()
    assert len(numbered) == 8
    assert {x.r for x in numbered} <= set(range(partitions))
    assert next(x.r for x in numbered if x.id is None) == 0
    in_order = [x.r for x in sorted((x for x in numbered if x.id is not None), key=lambda x: x.id)]
    assert in_order == sorted(in_order)


def test_bounds_read_one_column(spark, tmp_path, plan):
    spark.range(3).selectExpr("id", "id AS other").write.parquet(f"{tmp_path}/t")
    source = ParquetSource(location=f"{tmp_path}/{{table}}")
    assert "ReadSchema: struct<id:bigint>" in plan(source.bounds(spark, "t", "id"))


def test_balanced_ranges_of_a_database():
    import datetime
    import types

    asked = {}
    reader = types.SimpleNamespace(jdbc=lambda url, table, predicates, properties: asked.update(url=url, table=table, predicates=predicates, properties=properties))
    session = types.SimpleNamespace(read=reader)
    source = oracle_source()
    extract_balanced(session, source, "s.t", "id", 3, cuts=[10, 250])
    assert asked["predicates"] == ["id < 10 OR id IS NULL", "id >= 10 AND id < 250", "id >= 250"]
    assert asked["table"] == "s.t" and "url" not in asked["properties"] and asked["properties"]["driver"].startswith("oracle")
    extract_balanced(session, source, "s.t", "d", 2, cuts=[datetime.date(2024, 1, 2)])
    assert asked["predicates"] == ["d < DATE '2024-01-02' OR d IS NULL", "d >= DATE '2024-01-02'"]
    moment = datetime.datetime(2024, 1, 2, 3, 4, 5)
    assert source.literal(moment) == "TIMESTAMP '2024-01-02 03:04:05'"
    assert JdbcSource("MSSQL", "u", "n", "p").literal(moment) == "'2024-01-02 03:04:05'"
    with pytest.raises(TypeError):
        source.literal("x")


def test_balanced_ranges_follow_the_rows(spark, tmp_path):
    spark.range(4_000).select((F.col("id") * F.col("id")).alias("k")).unionByName(spark.range(50).select(F.lit(None).cast("long").alias("k"))).write.parquet(f"{tmp_path}/t")
    source = ParquetSource(location=f"{tmp_path}/{{table}}")
    cuts = source.cuts(spark, "t", "k", 8)
    rows = extract_balanced(spark, source, "t", "k", 8, cuts)
    counts = {r["r"]: r["count"] for r in rows.groupBy(range_of("k", cuts).alias("r")).count().collect()}
    assert sorted(counts) == list(range(8)) and abs(counts[0] - 550) < 20 and all(abs(counts[i] - 500) < 20 for i in range(1, 8))
    assert source.cuts(spark, "t", "k", 1) == [] and range_of("k", []) is not None
    spark.createDataFrame([], "k long").write.parquet(f"{tmp_path}/none")
    assert source.cuts(spark, "none", "k", 8) == []
    assert extract_balanced(spark, source, "none", "k", 8).count() == 0
