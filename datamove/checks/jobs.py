"""Whole loads: raw tables in full and by increment, and a job per layer."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from datamove.checks.common import load, readable, scratch_layout, scratch_place
from datamove.checks.incremental import ORDERS_SQL, orders_loaded, orders_now
from datamove.plans import Flips, Job, RawLoad, load_raw, run_group, run_job
from datamove.session import scratch_path
from datamove.sources import ParquetSource

CONFORMED = """
    SELECT o_custkey, o_orderstatus, count(*) AS n, max(o_orderkey) AS newest
    FROM {orders} GROUP BY o_custkey, o_orderstatus
"""


def _source_states(spark: SparkSession, sf_dir: str) -> list[ParquetSource]:
    """The source database before and after the day's changes."""
    root = scratch_path(spark, "source")
    orders_loaded(spark, sf_dir).write.parquet(f"{root}/before/sales.orders")
    orders_now(spark, sf_dir).write.parquet(f"{root}/after/sales.orders")
    return [ParquetSource(location=f"{root}/{state}/{{table}}") for state in ("before", "after")]


def loaded_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    task = RawLoad("sales.orders", scratch_place(spark, "sales__orders"), key="o_orderkey", incremental=True)
    before, after = _source_states(spark, sf_dir)
    # Full load, increment, and an increment with nothing new.
    for source in (before, after, after):
        load_raw(spark, source, task)
    return readable(spark.table(task.target.table))


def loaded_in_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    task = RawLoad(
        "sales.orders",
        scratch_place(spark, "sales__orders"),
        key="o_orderkey",
        incremental=True,
        partition_by="o_orderpriority",
        in_partitions=True,
        audit=True,
        request_id=7,
    )
    for source in _source_states(spark, sf_dir):
        load_raw(spark, source, task)
    return readable(spark.table(task.target.table))


def ran_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = scratch_layout(spark, "acme")
    raw = Job(
        group_name="acme",
        run_priority=1,
        storage_layer="R",
        extract_type="QY",
        obj_schema="sales",
        obj_name="orders",
        target_obj_schema=None,
        target_obj_name=None,
        transform_query=None,
        custom_query=None,
        delimiter_val=None,
        inc_header=False,
        is_incremental=False,
        to_validate=True,
        obj_source="lake",
        obj_target="lake",
        source_connection_type=None,
        target_connection_type=None,
        source_primary_key="o_orderkey",
        target_partition_column="o_orderstatus",
        source_partitions=4,
        target_partitions=0,
    )
    orders = layout.raw("acme", "sales", "orders").table
    conform = replace(
        raw, run_priority=2, storage_layer="C", target_obj_name="by_customer", transform_query=CONFORMED.format(orders=orders)
    )
    publish = replace(
        conform,
        run_priority=3,
        storage_layer="P",
        obj_name="by_customer",
        transform_query="(o_custkey bigint, o_orderstatus varchar(1), n bigint, newest bigint)",
    )
    source = scratch_path(spark, "source")
    load(spark, sf_dir, "orders").write.parquet(f"{source}/sales.orders")
    sources = {"lake": ParquetSource(location=f"{source}/{{table}}")}
    result = None
    for job in (raw, conform, publish):
        result = run_job(spark, job, layout, sources)
    return result


def loaded_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders under other column names and types, as a database might hand them out."""
    target, root = scratch_place(spark, "sales__orders"), scratch_path(spark, "source")
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("decimal(38,10)").alias("O_ORDERKEY"),
        F.col("o_custkey").alias("O_CUSTKEY"),
        "o_orderstatus",
        "o_totalprice",
        (F.col("o_orderdate") + F.expr("interval 13 hours")).alias("O_ORDERDATE"),
        "o_orderpriority",
    )
    orders.write.parquet(f"{root}/sales.orders")
    task = RawLoad("sales.orders", target, normalize=True, unbounded=("O_ORDERKEY",), row_ids=("o_custkey",), dates=("o_orderdate",))
    load_raw(spark, ParquetSource(location=f"{root}/{{table}}"), task)
    loaded = spark.table(target.table)
    return loaded.withColumns({"o_orderkey": F.col("o_orderkey").cast("long"), "o_orderdate": F.col("o_orderdate").cast("string")})


def _control(spark: SparkSession, table: list, properties: list = (), options: list = ()) -> dict[str, DataFrame]:
    """Control tables of group ``g``, from rows of layer, extract type, schema, name, target schema, target name, query."""
    head = "storage_layer string, extract_type string, obj_schema string, obj_name string, target_obj_schema string, target_obj_name string, transform_query string"
    flags = "logical_group_id string, run_priority int, custom_flag boolean, delimiter_val string, inc_header boolean, is_incremental boolean, to_validate boolean, is_valid boolean"
    rows = [(*row, "g", i, False, None, True, False, False, True) for i, row in enumerate(table)]
    return {
        "meta_table_map": spark.createDataFrame(rows, f"{head}, {flags}"),
        "meta_logical_map": spark.createDataFrame([("g", "acme", "lake", "lake")], "logical_group_id string, group_name string, obj_source string, obj_target string"),
        "meta_object_connection_map": spark.createDataFrame([("lake", "LAKE")], "obj_connection string, connection_type string"),
        "meta_object_flip": spark.createDataFrame([], "target_obj_schema string, target_obj_name string, pb_flip string"),
        "meta_custom_query": spark.createDataFrame([], "logical_group_id string, obj_schema string, obj_name string, custom_query string"),
        "meta_raw_properties": spark.createDataFrame(
            [("g", *row) for row in properties],
            "logical_group_id string, obj_schema string, obj_name string, source_partition_flag boolean, source_primary_key string, "
            "target_partition_flag boolean, target_partition_column string, source_partitions int, target_partitions int",
        ),
        "meta_load_options": spark.createDataFrame(
            [("g", *row) for row in options], "logical_group_id string, obj_schema string, obj_name string, option_name string, option_value string"
        ),
    }


def ran_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group of control-table rows in the layers R, F, C and P."""
    layout, source = scratch_layout(spark, "acme"), scratch_path(spark, "source")
    load(spark, sf_dir, "orders").write.parquet(f"{source}/sales.orders")
    landing = layout.landing("acme", "crm")
    load(spark, sf_dir, "customer").write.option("header", True).csv(f"{landing}/drop")
    orders, customers = layout.raw("acme", "sales", "orders").table, layout.raw("acme", "crm", "customers").table
    joined = f"SELECT c_mktsegment, count(*) AS n, max(o_orderkey) AS newest FROM {orders} JOIN {customers} ON o_custkey = c_custkey GROUP BY c_mktsegment"
    # layer, extract type, schema, name, target schema, target name, query
    table = [
        ("R", "TB", "sales", "orders", None, None, None),
        ("F", "CS", "crm", "part", "crm", "customers", None),
        ("C", None, None, None, None, "segments", joined),
        ("P", None, None, "segments", "w", "segments", "(c_mktsegment string, n bigint, newest bigint)"),
    ]
    control = _control(spark, table)
    sources = {"lake": ParquetSource(location=f"{source}/{{table}}")}
    flips = Flips(spark, scratch_place(spark, "flips"))
    outcomes = run_group(control, "g", lambda job: run_job(spark, job, layout, sources), flips)
    for outcome in outcomes:
        if outcome.error is not None:
            raise outcome.error
    return outcomes[-1].result


def ran_group_with_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of odd names and types by partition, and customers from JSON lines, as rows of the options table say."""
    layout, source = scratch_layout(spark, "acme"), scratch_path(spark, "source")
    orders = load(spark, sf_dir, "orders").withColumn("o_orderkey", F.col("o_orderkey").cast("decimal(38,10)"))
    orders = orders.withColumn("O_ORDERDATE", F.col("o_orderdate") + F.expr("interval 13 hours"))
    orders.withColumnRenamed("o_custkey", "O_CUSTKEY").write.parquet(f"{source}/sales.orders")
    load(spark, sf_dir, "customer").repartition(5).write.json(f"{layout.landing('acme', 'crm')}/drop")
    table = [("R", "TB", "sales", "orders", None, None, None), ("F", "JS", "crm", "part", "crm", "customers", None)]
    options = {
        ("sales", "orders"): {"normalize": "true", "unbounded": "o_orderkey", "row_ids": "O_CUSTKEY", "dates": "o_orderdate", "in_partitions": "true"},
        ("crm", "part"): {"multi_line": "false", "files_per_batch": "2"},
    }
    listed = [(*obj, name, value) for obj, named in options.items() for name, value in named.items()]
    control = _control(spark, table, [("sales", "orders", True, "o_orderkey", True, "o_orderstatus", 1, 0)], listed)
    sources = {"lake": ParquetSource(location=f"{source}/{{table}}")}
    for outcome in run_group(control, "g", lambda job: run_job(spark, job, layout, sources)):
        if outcome.error is not None:
            raise outcome.error
    loaded = spark.table(layout.raw("acme", "sales", "orders").table)
    customers = spark.table(layout.raw("acme", "crm", "customers").table)
    joined = loaded.join(customers, F.col("o_custkey") == F.col("c_custkey").cast("string"))
    return joined.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("string").alias("o_orderdate"), "c_mktsegment")


def _audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows that the load of all orders leaves behind."""
    target, root = scratch_place(spark, "sales__orders"), scratch_path(spark, "source")
    # Fractions as decimals, whose text both engines write the same way.
    orders = load(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,4)"))
    orders.write.parquet(f"{root}/sales.orders")
    source = ParquetSource(location=f"{root}/{{table}}")
    load_raw(spark, source, RawLoad("sales.orders", target, audit=True, request_id=7))
    audit = spark.table(f"{target.database}.meta_audit_table")
    return audit.select(
        "source", "table_name", "column_name", "min", "max", "count", "request_id"
    )


QUERIES = {
    "load_raw": loaded_raw,
    "load_raw_in_partitions": loaded_in_partitions,
    "load_raw_audit": _audited,
    "load_raw_normalized": loaded_normalized,
    "run_jobs": ran_jobs,
    "run_group": ran_group,
    "run_group_options": ran_group_with_options,
}

_MERGED = f"""
    WITH {ORDERS_SQL}, merged AS (SELECT * FROM kept UNION ALL SELECT * FROM changed)
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
           o_orderpriority, strftime(upd, '%Y-%m-%d') AS update_timestamp FROM merged
"""
_AUDITED = [
    ("o_orderkey", "o_orderkey"),
    ("o_custkey", "o_custkey"),
    ("o_orderstatus", "o_orderstatus"),
    ("o_totalprice", "CAST(o_totalprice AS DECIMAL(18,4))"),
    ("o_orderdate", "o_orderdate"),
    ("o_orderpriority", "o_orderpriority"),
]

ORACLES = {
    "load_raw": _MERGED,
    "load_raw_in_partitions": _MERGED,
    "load_raw_audit": " UNION ALL ".join(
        f"""SELECT s.source, s.table_name, '{name}' AS column_name, CAST(min({column}) AS VARCHAR) AS min,
            CAST(max({column}) AS VARCHAR) AS max, count(DISTINCT {column}) AS count, 7 AS request_id
            FROM orders, (VALUES ('lake', 'orders'), ('lake', 'sales__orders')) s(source, table_name)
            GROUP BY s.source, s.table_name"""
        for name, column in _AUDITED
    ),
    "load_raw_normalized": """
        SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_totalprice,
               strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders
    """,
    "run_group": """
        SELECT c_mktsegment, count(*) AS n, max(o_orderkey) AS newest
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
    """,
    "run_group_options": """
        SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, c_mktsegment
        FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    "run_jobs": CONFORMED.format(orders="orders"),
}
