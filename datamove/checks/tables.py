"""Table writes, partition overwrite, copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from datamove.checks.common import load, readable, scratch_place, staged
from datamove.checks.incremental import ORDERS_SQL, orders_changed, orders_loaded
from datamove.session import scratch_path
from datamove.sinks import Slices, merge_into_partitions, merge_version, publish_version, snapshot_copy, write_table


def written_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = scratch_place(spark, "orders")
    write_table(load(spark, sf_dir, "orders"), place.table, place.path, partition_by="o_orderstatus")
    return readable(spark.table(place.table))


def written_sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = scratch_place(spark, "lineitem")
    lines = load(spark, sf_dir, "lineitem")
    write_table(lines, place.table, place.path, rows=lines.count())
    return (
        spark.table(place.table)
        .withColumn("file", F.input_file_name())
        .agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("n"))
    )


def written_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = scratch_place(spark, "orders")
    write_table(load(spark, sf_dir, "orders"), place.table, place.path, bucket_by=(8, "o_custkey"))
    return spark.table(place.table).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


def overwritten_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    place, orders = scratch_place(spark, "orders"), load(spark, sf_dir, "orders")
    write_table(orders, place.table, place.path, partition_by="o_orderstatus")
    doubled = orders.where(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    write_table(doubled, place.table, place.path, mode="dynamic", partition_by="o_orderstatus")
    return readable(spark.table(place.table))


def merged_in_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = scratch_place(spark, "orders")
    publish_version(orders_loaded(spark, sf_dir), place, Slices(column="o_orderstatus"))
    # Filled orders that shipped again move to a partition of their own.
    moved = F.when(F.col("o_orderstatus") == "F", "S").otherwise(F.col("o_orderstatus"))
    increment = staged(orders_changed(spark, sf_dir).withColumn("o_orderstatus", moved))
    if merge_version(increment, place, "o_orderkey") is None:
        raise RuntimeError("an increment of the table's types must be mergeable")
    return readable(spark.table(place.table))


def merged_in_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order in a thousand changes, in a table kept in slices of the key."""
    place, orders = scratch_place(spark, "orders"), load(spark, sf_dir, "orders")
    publish_version(orders, place, Slices(key="o_orderkey", buckets=64))
    raised = orders.where("o_orderkey % 1000 = 7").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    merge_version(raised.withColumn("note", F.lit("raised")), place, "o_orderkey")
    return readable(spark.table(place.table))


def merged_in_null_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of which some have no status, merged with some whose status is empty."""
    place = scratch_place(spark, "orders")
    status = F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus"))
    orders = load(spark, sf_dir, "orders").withColumn("o_orderstatus", status)
    write_table(orders, place.table, place.path, partition_by="o_orderstatus")
    emptied = orders.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit(""))
    merge_into_partitions(place.table, emptied, "o_orderkey", "o_orderstatus", scratch_path(spark, "backup"))
    return readable(spark.table(place.table))


def copied_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    place, copy = scratch_place(spark, "lineitem"), scratch_path(spark, "copy")
    write_table(load(spark, sf_dir, "lineitem"), place.table, place.path, partition_by="l_linenumber")
    snapshot_copy(spark, place.path, copy, ["l_linenumber"])
    return readable(spark.read.parquet(copy))


QUERIES = {
    "write_partitioned": written_partitioned,
    "write_sized": written_sized,
    "write_bucketed": written_bucketed,
    "overwrite_dynamic": overwritten_dynamic,
    "merge_in_partitions": merged_in_partitions,
    "merge_in_null_partition": merged_in_null_partition,
    "merge_in_slices": merged_in_slices,
    "snapshot_copy": copied_snapshot,
}

_ORDERS = """o_orderkey, o_custkey, o_orderstatus, {price} AS o_totalprice,
    strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority"""

ORACLES = {
    "write_partitioned": f"SELECT {_ORDERS.format(price='o_totalprice')} FROM orders",
    "write_sized": """
        SELECT greatest(1, least(200, count(*) // 1000000)) AS files, count(*) AS n FROM lineitem
    """,
    "write_bucketed": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey",
    "overwrite_dynamic": f"""
        SELECT {_ORDERS.format(price="CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END")}
        FROM orders
    """,
    "merge_in_partitions": f"""
        WITH {ORDERS_SQL},
        merged AS (
            SELECT * FROM kept
            UNION ALL SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN 'S' ELSE o_orderstatus END AS o_orderstatus)
            FROM changed)
        SELECT {_ORDERS.format(price='o_totalprice')}, strftime(upd, '%Y-%m-%d') AS update_timestamp FROM merged
    """,
    "merge_in_null_partition": """
        SELECT * REPLACE (CASE WHEN o_orderstatus <> 'O' AND o_orderkey % 3 <> 0 THEN o_orderstatus END AS o_orderstatus,
                          strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders
    """,
    "merge_in_slices": f"""
        SELECT {_ORDERS.format(price="CASE WHEN o_orderkey % 1000 = 7 THEN o_totalprice * 2 ELSE o_totalprice END")},
               CASE WHEN o_orderkey % 1000 = 7 THEN 'raised' END AS note
        FROM orders
    """,
    "snapshot_copy": "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem",
}
