"""SQL texts run and saved by the transform operator, one per kind of query it passes on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from datamove.checks.common import register, scratch_place
from datamove.sinks import run_transform

# Texts both engines take as they are.
SHARED = {
    "transform_star_agg": """
        SELECT n_name, p_brand, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(12, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2)))) AS DOUBLE) AS revenue
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN part ON l_partkey = p_partkey
        GROUP BY n_name, p_brand
    """,
    "transform_join_kinds": """
        SELECT 'busy' AS kind, c.c_custkey, o.o_orderkey
        FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey AND o.o_orderpriority = '1-URGENT'
        UNION ALL
        SELECT 'shipped', s.c_custkey, CAST(NULL AS BIGINT) FROM customer s
        WHERE EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                      WHERE o_custkey = s.c_custkey AND l_returnflag = 'R')
        UNION ALL
        SELECT 'never pending', a.c_custkey, CAST(NULL AS BIGINT) FROM customer a
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = a.c_custkey AND o_orderstatus = 'P')
    """,
    "transform_rollup": """
        SELECT o_orderstatus, o_orderpriority, CAST(grouping(o_orderstatus) AS INTEGER) AS all_statuses, count(*) AS n,
               CAST(sum(CAST(o_totalprice AS DECIMAL(12, 2))) AS DOUBLE) AS total
        FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)
    """,
    "transform_rank": """
        SELECT c_nationkey, c_custkey, c_acctbal, place
        FROM (SELECT c_nationkey, c_custkey, c_acctbal,
                     CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS place
              FROM customer) ranked
        WHERE place <= 3
    """,
    "transform_topk": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
        ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 100
    """,
    "transform_setops": """
        SELECT 'both' AS what, k FROM (
            SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'
            INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') b
        UNION ALL
        SELECT 'none', k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders) n
        UNION
        SELECT 'region', CAST(r_regionkey AS BIGINT) FROM region
    """,
}

# Texts that need each engine's own function names: Spark's, DuckDB's.
OWN = {
    "transform_dates_strings": (
        """
        SELECT year(o_orderdate) AS y, quarter(o_orderdate) AS q, date_format(trunc(o_orderdate, 'MM'), 'yyyy-MM-dd') AS month_start,
               upper(substring(o_orderpriority, 3)) AS priority, lpad(o_orderstatus, 3, '*') AS status,
               count(*) AS n, count(DISTINCT date_format(o_orderdate, 'yyyyMMdd')) AS n_days
        FROM orders GROUP BY 1, 2, 3, 4, 5
        """,
        """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(quarter(o_orderdate) AS INTEGER) AS q,
               strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start,
               upper(substring(o_orderpriority, 3)) AS priority, lpad(o_orderstatus, 3, '*') AS status,
               count(*) AS n, count(DISTINCT strftime(o_orderdate, '%Y%m%d')) AS n_days
        FROM orders GROUP BY 1, 2, 3, 4, 5
        """,
    ),
    "transform_json_field": (
        """
        SELECT event_type, CAST(get_json_object(props, '$.k') AS BIGINT) AS k, count(*) AS n,
               min(event_id) AS first_event
        FROM events GROUP BY 1, 2
        """,
        """
        SELECT event_type, CAST(props ->> '$.k' AS BIGINT) AS k, count(*) AS n, min(event_id) AS first_event
        FROM events GROUP BY 1, 2
        """,
    ),
}

APPENDED = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus {} 'F'"


def _saved(sql: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        register(spark, sf_dir)
        place = scratch_place(spark, "result")
        return run_transform(spark, sql, place.table, place.path)

    return query


def appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir)
    place = scratch_place(spark, "result")
    run_transform(spark, APPENDED.format("="), place.table, place.path)
    return run_transform(spark, APPENDED.format("<>"), place.table, place.path, incremental=True)


QUERIES = {
    **{name: _saved(sql) for name, sql in SHARED.items()},
    **{name: _saved(sql) for name, (sql, _) in OWN.items()},
    "transform_append": appended,
}

ORACLES = {
    **SHARED,
    **{name: sql for name, (_, sql) in OWN.items()},
    "transform_append": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
}
