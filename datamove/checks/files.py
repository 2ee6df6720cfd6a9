"""Files: JSON, delimited text, selection by name, once-only ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from datamove.checks.common import EVENTS_CUT, load, readable, scratch_place
from datamove.session import scratch_path
from datamove.sinks import write_table
from datamove.sources import read_delimited, read_json_flat, select_files
from datamove.streaming import Landing, files_once, ingest_files_once, replace_with_new_files

EVENT_SCHEMA = """
    event_id long, ts string, who struct<user_id: long>, what struct<event_type: string, value: double, props: string>
"""


ORDERS_SCHEMA = (
    "o_orderkey int, o_custkey int, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string"
)


def json_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_path(spark, "landing")
    nation = load(spark, sf_dir, "nation").join(
        load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = load(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    customers.select(
        "c_custkey",
        F.struct("c_name", F.struct("n_nationkey", "n_name", F.struct("r_regionkey", "r_name").alias("region")).alias("nation")).alias("who"),
        F.struct("c_nationkey", "c_acctbal", "c_mktsegment").alias("account"),
    ).write.json(landing)
    return read_json_flat(spark, landing, prefix="part", multi_line=False)


def delimited_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_path(spark, "landing")
    readable(load(spark, sf_dir, "orders")).write.option("header", True).csv(landing)
    return read_delimited(spark, landing, "part", "CSV", schema=ORDERS_SCHEMA)


def delimited_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_path(spark, "landing")
    # Tab-parted, without a header, under a .tsv name.
    parts = load(spark, sf_dir, "part")
    parts.write.option("sep", "\t").option("extension", "tsv").csv(landing)
    read = read_delimited(spark, landing, "part", "TSV", header=False)
    return read.toDF(*parts.columns)


def delimited_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_path(spark, "landing")
    load(spark, sf_dir, "customer").write.option("sep", "|").option("header", True).option("extension", "txt").csv(landing)
    return read_delimited(spark, landing, "part", "TXT", delimiter="|")


def selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_path(spark, "landing")
    customers = load(spark, sf_dir, "customer")
    customers.write.json(f"{landing}/json")
    load(spark, sf_dir, "supplier").write.option("header", True).csv(f"{landing}/deep/er/csv")
    # The CSV files of each nation lie two levels down.
    customers.write.option("header", True).partitionBy("c_nationkey").csv(f"{landing}/nations")
    nations = select_files(spark, f"{landing}/nations", "part", "CSV").select(
        F.regexp_extract("path", "c_nationkey=([^/]*)", 1).alias("nation")
    )
    none = select_files(spark, f"{landing}/nations", "other", "CSV").unionByName(
        select_files(spark, f"{landing}/json", "", "CS")
    )
    rows = read_delimited(spark, landing, "part", "CSV", schema="a string, b string, c string, d string, e string")

    def counted(df: DataFrame, what: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "n")

    return (
        counted(nations.distinct(), "nations with files")
        .unionByName(counted(none, "files of another name or type"))
        .unionByName(counted(rows, "rows in csv files"))
    )


def _event_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = load(spark, sf_dir, "events")
    documents = events.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.struct("user_id").alias("who"),
        F.struct("event_type", "value", "props").alias("what"),
    )
    early = F.col("ts") <= F.lit(EVENTS_CUT)
    return documents.where(early), documents.where(~early)


def ingested_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    place, drops = scratch_place(spark, "events"), scratch_path(spark, "landing")
    landing = Landing(drops, "JSON", "part", EVENT_SCHEMA, multi_line=False, archive=scratch_path(spark, "processed"))
    for i, drop in enumerate(_event_documents(spark, sf_dir)):
        drop.write.json(f"{drops}/drop{i}")
        # Called twice per drop: the second call finds nothing new.
        for _ in range(2):
            ingest_files_once(spark, landing, place.table, place.path, f"{place.path}_checkpoint")
    return spark.table(place.table)


def replaced_by_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    place, drops = scratch_place(spark, "events"), scratch_path(spark, "landing")
    landing = Landing(drops, "JSON", "part", EVENT_SCHEMA, multi_line=False)
    for i, drop in enumerate(_event_documents(spark, sf_dir)):
        drop.write.json(f"{drops}/drop{i}")
        for _ in range(2):
            replace_with_new_files(spark, landing, place, f"{place.path}_checkpoint")
    return spark.table(place.table)


def ingested_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in two drops whose headers list the columns in different orders."""
    orders = readable(load(spark, sf_dir, "orders"))
    drops = []
    for i, columns in enumerate((orders.columns, orders.columns[::-1])):
        landing = scratch_path(spark, "landing")
        orders.where(F.col("o_orderkey") % 2 == i).select(*columns).write.option("header", True).csv(landing)
        drops.append(read_delimited(spark, landing, "part", "CSV", schema=ORDERS_SCHEMA))
    return drops[0].union(drops[1])


def ingested_into_batch_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of which a batch wrote a third; the rest lands in files whose headers differ, one with a column more."""
    place, landing = scratch_place(spark, "orders"), scratch_path(spark, "landing")
    orders = readable(load(spark, sf_dir, "orders"))
    third = lambda i: orders.where(F.col("o_orderkey") % 3 == i)
    typed = [F.col(c.split()[0]).cast(c.split()[1]) for c in ORDERS_SCHEMA.split(", ")]
    write_table(third(0).select(*typed), place.table, place.path)
    third(1).select(*orders.columns[::-1]).write.option("header", True).csv(f"{landing}/one")
    third(2).withColumn("note", F.concat(F.lit("order "), "o_orderkey")).write.option("header", True).csv(f"{landing}/two")
    files = Landing(landing, "CSV", "part", ORDERS_SCHEMA, evolve=True)
    for _ in range(2):
        ingest_files_once(spark, files, place.table, place.path, f"{place.path}_checkpoint")
    return spark.table(place.table)


def replaced_after_a_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that took the first drop but stopped before it published, and one that took the second."""
    place, drops = scratch_place(spark, "events"), scratch_path(spark, "landing")
    landing = Landing(drops, "JSON", "part", EVENT_SCHEMA, multi_line=False)
    early, late = _event_documents(spark, sf_dir)
    early.write.json(f"{drops}/drop0")
    arrivals = f"{place.database}.{place.name}_arrivals"
    files_once._run(spark, landing, arrivals, f"{place.path}_arrivals", f"{place.path}_checkpoint", files_once._BATCH)
    late.write.json(f"{drops}/drop1")
    return replace_with_new_files(spark, landing, place, f"{place.path}_checkpoint")


QUERIES = {
    "ingest_reordered_header": ingested_reordered,
    "ingest_into_batch_table": ingested_into_batch_table,
    "replace_after_stopped_run": replaced_after_a_stop,
    "read_json_flat": json_flat,
    "read_delimited_csv": delimited_csv,
    "read_delimited_tsv": delimited_tsv,
    "read_delimited_txt": delimited_txt,
    "select_files": selected,
    "ingest_files_once": ingested_once,
    "replace_with_new_files": replaced_by_new_files,
}

_EVENTS = "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props FROM events"

ORACLES = {
    "ingest_reordered_header": """
        SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
               o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders
    """,
    "ingest_into_batch_table": """
        SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
               o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority,
               CASE WHEN o_orderkey % 3 = 2 THEN 'order ' || o_orderkey END AS note FROM orders
    """,
    "replace_after_stopped_run": _EVENTS,
    "read_json_flat": """
        SELECT customer.*, nation.n_nationkey, n_name, r_regionkey, r_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
    "read_delimited_csv": """
        SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
               o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders
    """,
    "read_delimited_tsv": "SELECT * REPLACE (CAST(p_partkey AS INTEGER) AS p_partkey) FROM part",
    "read_delimited_txt": "SELECT * REPLACE (CAST(c_custkey AS INTEGER) AS c_custkey) FROM customer",
    "select_files": """
        SELECT 'nations with files' AS what, count(DISTINCT c_nationkey) AS n FROM customer
        UNION ALL SELECT 'files of another name or type', 0
        UNION ALL SELECT 'rows in csv files', (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier)
    """,
    "ingest_files_once": _EVENTS,
    "replace_with_new_files": f"{_EVENTS} WHERE ts > TIMESTAMP '{EVENTS_CUT}'",
}
