"""Watermark, changed rows, merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from datamove.checks.common import EVENTS_CUT, ORDERS_CUT, day_text, load, moment_text, readable, staged
from datamove.operators import (
    align_schemas,
    changed_rows,
    fits_broadcast,
    frequent_keys,
    high_watermark,
    latest_per_key,
    merge_upsert,
    watermark_literal,
)

SUPPLIERS_CUT = "2001-10-15"


def orders_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders placed up to the cut, as they were first written."""
    orders = load(spark, sf_dir, "orders").where(F.col("o_orderdate") <= F.lit(ORDERS_CUT).cast("timestamp_ntz"))
    return orders.withColumn("update_timestamp", F.col("o_orderdate"))


def orders_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as of today: shipping one reprices it and counts as its last update."""
    shipped = (
        load(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            # In whole cents, so the sum does not depend on the order of the rows.
            (F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).cast("double") / 100).alias("shipped_value"),
            F.max("l_shipdate").alias("shipped_on"),
        )
    )
    orders = load(spark, sf_dir, "orders").join(shipped, "o_orderkey", "left")
    return orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.coalesce("shipped_value", "o_totalprice").alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
        F.greatest("o_orderdate", "shipped_on").alias("update_timestamp"),
    )


def orders_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    watermark = high_watermark(orders_loaded(spark, sf_dir))
    return staged(changed_rows(orders_now(spark, sf_dir), watermark))


def watermark_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = load(spark, sf_dir, "events").where(F.col("ts") <= F.lit(EVENTS_CUT).cast("timestamp_ntz"))
    found = high_watermark(loaded, "ts")
    return spark.range(1).select(watermark_literal(found, loaded.schema["ts"].dataType).alias("ts")).select(moment_text("ts"))


def events_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    loaded = events.where(F.col("ts") <= F.lit(EVENTS_CUT).cast("timestamp_ntz"))
    changed = changed_rows(events, high_watermark(loaded, "ts"), "ts")
    return changed.withColumn("ts", moment_text("ts"))


def merged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readable(merge_upsert(orders_loaded(spark, sf_dir), orders_changed(spark, sf_dir), "o_orderkey"))


def merged_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = orders_changed(spark, sf_dir).withColumn("late", F.datediff("update_timestamp", "o_orderdate") > 60)
    return readable(merge_upsert(orders_loaded(spark, sf_dir), new, "o_orderkey"))


def merged_dropped_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = orders_changed(spark, sf_dir).drop("o_orderpriority")
    return readable(merge_upsert(orders_loaded(spark, sf_dir), new, "o_orderkey"))


def merged_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = orders_changed(spark, sf_dir).withColumn("late", F.datediff("update_timestamp", "o_orderdate") > 60)
    return readable(merge_upsert(orders_loaded(spark, sf_dir), new.drop("o_orderpriority"), "o_orderkey"))


def merged_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    loaded = events.where(F.col("ts") <= F.lit(EVENTS_CUT).cast("timestamp_ntz"))
    changed = changed_rows(events, high_watermark(loaded, "ts"), "ts")
    order = ["ts", "event_id"]
    increment = staged(latest_per_key(changed, "user_id", order))
    small = fits_broadcast(increment, "user_id")
    merged = merge_upsert(latest_per_key(loaded, "user_id", order), increment, "user_id", broadcast_keys=small)
    return merged.withColumn("ts", moment_text("ts"))


def merged_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    cut = F.lit(SUPPLIERS_CUT).cast("timestamp_ntz")
    old, new = lines.where(F.col("l_shipdate") <= cut), lines.where(F.col("l_shipdate") > cut)
    # Small tasks, so that some suppliers have more lines than one takes.
    merged = merge_upsert(old, new, "l_suppkey", hot_keys=frequent_keys(old, "l_suppkey", 0.005), task_rows=100)
    return merged.withColumn("l_shipdate", day_text("l_shipdate"))


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    cut = F.lit(ORDERS_CUT).cast("timestamp_ntz")
    old = orders.where(F.col("o_orderdate") <= cut).drop("o_orderpriority")
    new = orders.where(F.col("o_orderdate") > cut).drop("o_orderstatus")
    before, after = align_schemas(old, new)
    return readable(before.unionByName(after))


def merged_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their orders in an array; the increment's orders have a field more, in another order."""
    orders = load(spark, sf_dir, "orders")

    def customers(*fields: str) -> DataFrame:
        placed = F.sort_array(F.collect_list(F.struct(*fields)))
        return orders.groupBy("o_custkey").agg(placed.alias("orders"), F.struct(F.count(F.lit(1)).alias("many")).alias("total"))

    old = customers("o_orderkey", "o_totalprice")
    new = customers("o_orderpriority", "o_orderkey", "o_totalprice").where("o_custkey % 5 = 0")
    merged = merge_upsert(old, new, "o_custkey").select("o_custkey", "total.many", F.explode("orders").alias("o"))
    return merged.select("o_custkey", "many", "o.o_orderkey", "o.o_totalprice", "o.o_orderpriority")


QUERIES = {
    "merge_nested_fields": merged_nested,
    "high_watermark": watermark_of_events,
    "changed_rows": events_changed,
    "align_schemas": aligned,
    "merge_upsert": merged_orders,
    "merge_schema_new": merged_new_column,
    "merge_schema_dropped": merged_dropped_column,
    "merge_schema_both": merged_both,
    "merge_latest_per_key": merged_latest,
    "merge_hot_keys": merged_hot_keys,
}

ORDERS_SQL = f"""
    shipped AS (
        SELECT l_orderkey, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS shipped_value,
               max(l_shipdate) AS shipped_on
        FROM lineitem GROUP BY l_orderkey),
    loaded AS (SELECT *, o_orderdate AS upd FROM orders WHERE o_orderdate <= TIMESTAMP '{ORDERS_CUT}'),
    now AS (
        SELECT o_orderkey, o_custkey, o_orderstatus, coalesce(shipped_value, o_totalprice) AS o_totalprice,
               o_orderdate, o_orderpriority, greatest(o_orderdate, shipped_on) AS upd
        FROM orders LEFT JOIN shipped ON l_orderkey = o_orderkey),
    changed AS (SELECT * FROM now WHERE upd > (SELECT max(upd) FROM loaded)),
    kept AS (SELECT * FROM loaded l WHERE NOT EXISTS (SELECT 1 FROM changed c WHERE c.o_orderkey = l.o_orderkey))
"""
_DATES = "strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, strftime(upd, '%Y-%m-%d') AS update_timestamp"
_LATE = "date_diff('day', o_orderdate, upd) > 60"


def _merged(kept: str, changed: str) -> str:
    head = f"o_orderkey, o_custkey, o_orderstatus, o_totalprice, {_DATES}"
    return f"WITH {ORDERS_SQL} SELECT {head}, {kept} FROM kept UNION ALL SELECT {head}, {changed} FROM changed"


ORACLES = {
    "high_watermark": f"""
        SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events WHERE ts <= TIMESTAMP '{EVENTS_CUT}'
    """,
    "changed_rows": f"""
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props
        FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '{EVENTS_CUT}')
    """,
    "align_schemas": f"""
        SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate <= TIMESTAMP '{ORDERS_CUT}' THEN o_orderstatus END AS o_orderstatus,
               o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
               CASE WHEN o_orderdate > TIMESTAMP '{ORDERS_CUT}' THEN o_orderpriority END AS o_orderpriority
        FROM orders
    """,
    "merge_upsert": _merged("o_orderpriority", "o_orderpriority"),
    "merge_schema_new": _merged(
        "o_orderpriority, CAST(NULL AS BOOLEAN) AS late", f"o_orderpriority, {_LATE} AS late"
    ),
    "merge_schema_dropped": _merged("o_orderpriority", "CAST(NULL AS VARCHAR) AS o_orderpriority"),
    "merge_schema_both": _merged(
        "o_orderpriority, CAST(NULL AS BOOLEAN) AS late",
        f"CAST(NULL AS VARCHAR) AS o_orderpriority, {_LATE} AS late",
    ),
    "merge_latest_per_key": """
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1
    """,
    "merge_nested_fields": """
        SELECT o_custkey, count(*) OVER (PARTITION BY o_custkey) AS many, o_orderkey, o_totalprice,
               CASE WHEN o_custkey % 5 = 0 THEN o_orderpriority END AS o_orderpriority
        FROM orders
    """,
    "merge_hot_keys": f"""
        SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem
        WHERE l_shipdate > TIMESTAMP '{SUPPLIERS_CUT}'
           OR l_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_shipdate > TIMESTAMP '{SUPPLIERS_CUT}')
    """,
}
