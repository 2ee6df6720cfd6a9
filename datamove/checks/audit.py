"""Column profiles and reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from datamove.checks.common import load, staged
from datamove.operators import audit_differences, profile_columns, profile_from_sketches, reconcile, reconcile_rows, sketch_columns

PROFILED = ("customer", "part", "orders", "lineitem")

# Fractions as decimals, whose text both engines write the same way.
FRACTIONS = {
    "customer": ("c_acctbal",),
    "part": ("p_retailprice",),
    "orders": ("o_totalprice",),
    "lineitem": ("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
}
EXACT = "decimal(18,4)"


def _exact(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return load(spark, sf_dir, table).withColumns({c: F.col(c).cast(EXACT) for c in FRACTIONS[table]})


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [profile_columns(_exact(spark, sf_dir, t), "lake", "sales", t) for t in PROFILED],
    )


def _source_and_damaged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = _exact(spark, sf_dir, "orders")
    damaged = orders.where(F.col("o_orderpriority") != "5-LOW").withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    )
    return (
        profile_columns(orders, "oracle", "sales", "orders"),
        profile_columns(damaged, "lake", "sales_raw", "sales__orders"),
    )


def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile(*_source_and_damaged(spark, sf_dir), request_id=42)


def differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_differences(*_source_and_damaged(spark, sf_dir))


def rows_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines against a copy that lacks some orders, changed some, repeats one and has some of its own."""
    lines = load(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey")
    copy = lines.where(key % 97 != 0).withColumn("l_quantity", F.when(key % 89 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    copy = copy.unionByName(lines.where("l_orderkey = 1")).unionByName(lines.where(key % 83 == 0).withColumn("l_orderkey", -key - 1))
    return reconcile_rows(lines, copy.select(*reversed(copy.columns)), "l_orderkey", buckets=512)


def profiled_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines profiled in three loads; the ends are exact, the distinct counts within two percent."""
    lines = _exact(spark, sf_dir, "lineitem")
    loads = [sketch_columns(lines.where(F.col("l_orderkey") % 3 == i)) for i in range(3)]
    kept = staged(reduce(DataFrame.unionByName, loads))
    profile = profile_from_sketches(kept, lines.columns, "lake", "sales", "lineitem")
    exact = lines.agg(*[F.count_distinct(F.col(c)).alias(c) for c in lines.columns]).unpivot([], lines.columns, "column_name", "exact")
    close = F.abs(F.col("count") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.03 * F.col("exact"))
    return profile.join(F.broadcast(exact), "column_name").select("column_name", "min", "max", close.alias("close"))


QUERIES = {
    "reconcile_rows": rows_reconciled,
    "profile_by_load": profiled_by_load,
    "profile_columns": profiles,
    "reconcile": reconciled,
    "audit_differences": differences,
}


def _profile_sql(source: str, schema: str, name: str, relation: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{source}' AS source, '{schema}' AS schema_name, '{name}' AS table_name, '{c}' AS column_name,
            left(CAST(min({value}) AS VARCHAR), 100) AS min, left(CAST(max({value}) AS VARCHAR), 100) AS max,
            count(DISTINCT {value}) AS count FROM {relation}"""
        for c in columns
        for value in [f"CAST({c} AS {EXACT})" if c in _FRACTIONS else c]
    )


_COLUMNS = {
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment".split(),
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice".split(),
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split(),
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate".split(),
}
_FRACTIONS = {c for columns in FRACTIONS.values() for c in columns}

_DAMAGED = """(SELECT * REPLACE (CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus)
    FROM orders WHERE o_orderpriority <> '5-LOW')"""
_SIDES = (
    _profile_sql("oracle", "sales", "orders", "orders", _COLUMNS["orders"]),
    _profile_sql("lake", "sales_raw", "sales__orders", _DAMAGED, _COLUMNS["orders"]),
)

ORACLES = {
    "reconcile_rows": """
        SELECT DISTINCT l_orderkey, CASE WHEN l_orderkey % 97 = 0 THEN 'missing' ELSE 'changed' END AS change
        FROM lineitem WHERE l_orderkey % 97 = 0 OR l_orderkey % 89 = 0 OR l_orderkey = 1
        UNION ALL SELECT DISTINCT -l_orderkey - 1, 'extra' FROM lineitem WHERE l_orderkey % 83 = 0
    """,
    "profile_by_load": "SELECT column_name, min, max, true AS close FROM ("
    + _profile_sql("lake", "sales", "lineitem", "lineitem", _COLUMNS["lineitem"])
    + ")",
    "profile_columns": " UNION ALL ".join(_profile_sql("lake", "sales", t, t, c) for t, c in _COLUMNS.items()),
    "reconcile": f"SELECT *, 42 AS request_id FROM ({_SIDES[0]} UNION ALL {_SIDES[1]})",
    "audit_differences": f"""
        SELECT s.column_name, s.min AS source_min, s.max AS source_max, s.count AS source_count,
               t.min AS target_min, t.max AS target_max, t.count AS target_count,
               s.min IS NOT DISTINCT FROM t.min AND s.max IS NOT DISTINCT FROM t.max AND s.count = t.count AS matches
        FROM ({_SIDES[0]}) s FULL JOIN ({_SIDES[1]}) t ON s.column_name = t.column_name
    """,
}
