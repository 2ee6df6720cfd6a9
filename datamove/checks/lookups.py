"""Facts resolved against required and optional lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from datamove.checks.common import load, readable
from datamove.operators import Lookup, resolve_lookups


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation")
    filled = load(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return resolve_lookups(
        readable(load(spark, sf_dir, "lineitem")),
        [
            Lookup(load(spark, sf_dir, "supplier"), {"l_suppkey": "s_suppkey"}, {"s_nationkey": "s_nationkey"}),
            Lookup(filled, {"l_orderkey": "o_orderkey"}, {"o_custkey": "o_custkey"}, required=False),
            Lookup(
                load(spark, sf_dir, "customer"), {"o_custkey": "c_custkey"}, {"c_nationkey": "c_nationkey"}, required=False
            ),
            Lookup(nation, {"s_nationkey": "n_nationkey"}, {"supplier_nation": "n_name", "n_regionkey": "n_regionkey"}),
            Lookup(nation, {"c_nationkey": "n_nationkey"}, {"customer_nation": "n_name"}, required=False),
            Lookup(load(spark, sf_dir, "region"), {"n_regionkey": "r_regionkey"}, {"supplier_region": "r_name"}),
        ],
        valid=F.col("l_returnflag") != "R",
    )


def conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load(spark, sf_dir, "customer")
    urgent = (
        load(spark, sf_dir, "orders")
        .where(F.col("o_orderpriority") == "1-URGENT")
        .groupBy("o_custkey", "o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("newest"))
        .withColumn("many", F.when(F.col("n") != 2, F.col("n") > 2))
    )
    return resolve_lookups(
        customers.withColumn("status", F.lit("F")),
        [
            Lookup(
                urgent,
                {"c_custkey": "o_custkey", "status": "o_orderstatus"},
                {"n": "n", "newest": "newest"},
                required=False,
                defaults={"n": 0, "newest": None},
                only_if={"newest": "many"},
            )
        ],
    )


QUERIES = {"resolve_lookups": resolved, "conditional_lookup": conditional}

ORACLES = {
    "resolve_lookups": """
        SELECT lineitem.* REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate), s_nationkey, o_custkey,
               c_nationkey, sn.n_name AS supplier_nation, sn.n_regionkey, cn.n_name AS customer_nation,
               r_name AS supplier_region
        FROM lineitem
        JOIN supplier ON l_suppkey = s_suppkey
        LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus = 'F'
        LEFT JOIN customer ON o_custkey = c_custkey
        JOIN nation sn ON s_nationkey = sn.n_nationkey
        LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
        JOIN region ON sn.n_regionkey = r_regionkey
        WHERE l_returnflag <> 'R'
    """,
    "conditional_lookup": """
        WITH urgent AS (
            SELECT o_custkey, o_orderstatus, count(*) AS n, max(o_orderkey) AS newest
            FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2)
        SELECT customer.*, 'F' AS status, coalesce(n, 0) AS n, CASE WHEN n > 2 THEN newest END AS newest
        FROM customer LEFT JOIN urgent ON c_custkey = o_custkey AND o_orderstatus = 'F'
    """,
}
