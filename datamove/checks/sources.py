"""Extraction and type normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from datamove.checks.common import day_text, load, readable, register
from datamove.functions import flatten_structs, normalize_types
from datamove.session import scratch_path
from datamove.sources import (
    CatalogSource,
    ParquetSource,
    extract_balanced,
    extract_keyrange,
    extract_query,
    extract_table,
    key_bounds,
    key_range,
    range_of,
)

RANGES = 16


def _source(sf_dir: str) -> ParquetSource:
    return ParquetSource(location=f"{sf_dir}/{{table}}.parquet")


def extract_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readable(extract_table(spark, _source(sf_dir), "orders"))


def extract_by_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir)
    sql = """
        SELECT o_custkey, count(*) AS n_orders, count(DISTINCT o_orderstatus) AS n_statuses
        FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY o_custkey
    """
    return extract_query(spark, CatalogSource(), sql)


def extract_by_keyrange(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _source(sf_dir)
    bounds = key_bounds(spark, source, "lineitem", "l_partkey")
    rows = extract_keyrange(spark, source, "lineitem", "l_partkey", RANGES, bounds)
    return rows.groupBy(key_range("l_partkey", bounds, RANGES).alias("range_id")).agg(
        F.count(F.lit(1)).alias("n"), F.min("l_partkey").alias("lo"), F.max("l_partkey").alias("hi")
    )


def extract_in_balanced_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose keys lie ever further apart, in ranges of about equally many rows; some lines have no key."""
    source, root = _source(sf_dir), scratch_path(spark, "source")
    far = F.when(F.col("l_linenumber") < 6, F.col("l_orderkey") * F.col("l_orderkey"))
    load(spark, sf_dir, "lineitem").withColumn("far", far).write.parquet(f"{root}/lines")
    source = ParquetSource(location=f"{root}/{{table}}")
    cuts = source.cuts(spark, "lines", "far", RANGES)
    rows = extract_balanced(spark, source, "lines", "far", RANGES, cuts)
    ranges = rows.groupBy(range_of("far", cuts).alias("range_id")).agg(
        F.count("far").alias("keys"), F.count(F.lit(1)).alias("n"), F.min("far").alias("lo"), F.max("far").alias("hi")
    )
    before = F.max("hi").over(Window.orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.withColumn("apart", F.coalesce(F.col("lo") > before, F.lit(True)))
    share = F.sum("keys").over(Window.partitionBy(F.lit(1))) / RANGES
    even = F.col("keys").between(0.9 * share - 7, 1.1 * share + 7)
    return ranges.withColumn("even", even).agg(
        F.count(F.lit(1)).alias("ranges"), F.sum("n").alias("n"), F.min("apart").alias("apart"), F.min("even").alias("even"),
        F.sum(F.when(F.col("range_id") == 0, F.col("n") - F.col("keys"))).alias("without_key"),
    )


def bounds_of_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"orders": "o_orderkey", "customer": "c_custkey", "lineitem": "l_orderkey"}
    found = [(t, *key_bounds(spark, _source(sf_dir), t, k)) for t, k in keys.items()]
    return spark.createDataFrame(found, "table_name string, lower_bound long, upper_bound long, n long")


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A century earlier, some orders fall before 1900; pending ones have no date.
    moved = F.when(F.col("o_orderstatus") != "P", F.expr("o_orderdate - INTERVAL '100' YEAR"))
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ROW_KEY"),
        F.col("o_totalprice").alias("Amount"),
        (moved + F.expr("INTERVAL '13' HOUR")).alias("Placed_On"),
        (moved + F.expr("INTERVAL '13' HOUR")).alias("PLACED_AT"),
        F.col("o_orderpriority").alias("Priority"),
    )
    result = normalize_types(orders, unbounded=["amount"], row_ids=["row_key"], dates=["placed_on"])
    return result.withColumn("placed_at", F.date_format("placed_at", "yyyy-MM-dd HH:mm:ss"))


def flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Both structs have a field "key", so those keep their parent's name.
    nested = load(spark, sf_dir, "lineitem").select(
        F.struct(
            F.col("l_orderkey").alias("key"),
            F.struct("l_quantity", "l_extendedprice", F.struct("l_returnflag", "l_linestatus").alias("flags")).alias("detail"),
        ).alias("line"),
        "l_linenumber",
        F.struct(F.col("l_partkey").alias("key"), "l_suppkey", "l_discount", "l_tax").alias("item"),
        day_text("l_shipdate"),
    )
    return flatten_structs(nested)


QUERIES = {
    "extract_full": extract_full,
    "extract_query": extract_by_query,
    "extract_keyrange": extract_by_keyrange,
    "extract_balanced": extract_in_balanced_ranges,
    "key_bounds": bounds_of_keys,
    "normalize_types": normalized,
    "flatten_structs": flattened,
}

ORACLES = {
    "extract_full": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
        FROM orders
    """,
    "extract_query": """
        SELECT o_custkey, count(*) AS n_orders, count(DISTINCT o_orderstatus) AS n_statuses
        FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY o_custkey
    """,
    "extract_keyrange": f"""
        WITH b AS (SELECT min(l_partkey) AS lo, (max(l_partkey) - min(l_partkey)) // {RANGES} + 1 AS stride FROM lineitem)
        SELECT CAST((l_partkey - b.lo) // b.stride AS INTEGER) AS range_id,
               count(*) AS n, min(l_partkey) AS lo, max(l_partkey) AS hi
        FROM lineitem, b GROUP BY 1
    """,
    "extract_balanced": f"""
        SELECT {RANGES} AS ranges, count(*) AS n, true AS apart, true AS even, count(*) FILTER (l_linenumber >= 6) AS without_key FROM lineitem
    """,
    "key_bounds": """
        SELECT 'orders' AS table_name, min(o_orderkey) AS lower_bound, max(o_orderkey) AS upper_bound, count(*) AS n FROM orders
        UNION ALL SELECT 'customer', min(c_custkey), max(c_custkey), count(*) FROM customer
        UNION ALL SELECT 'lineitem', min(l_orderkey), max(l_orderkey), count(*) FROM lineitem
    """,
    "normalize_types": """
        WITH moved AS (
            SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate - INTERVAL 100 YEAR + INTERVAL 13 HOUR END AS moved_at
            FROM orders)
        SELECT CAST(o_orderkey AS VARCHAR) AS row_key,
               CAST(o_totalprice AS DECIMAL(38, 0)) AS amount,
               CASE WHEN year(moved_at) < 1900 THEN DATE '1900-01-01' ELSE CAST(moved_at AS DATE) END AS placed_on,
               CASE WHEN year(moved_at) < 1900 THEN '1900-01-01 00:00:00' ELSE strftime(moved_at, '%Y-%m-%d %H:%M:%S') END AS placed_at,
               o_orderpriority AS priority
        FROM moved
    """,
    "flatten_structs": """
        SELECT l_linenumber, l_orderkey AS line_key, l_partkey AS item_key, l_suppkey, l_quantity, l_extendedprice,
               l_discount, l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
        FROM lineitem
    """,
}
