"""Publishing through two copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from datamove.checks.common import load, scratch_place
from datamove.sinks import active_copy, publish_ab, publish_warehouse


def _by_segment(customers: DataFrame) -> DataFrame:
    return customers.groupBy("c_mktsegment", "c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("c_acctbal").cast("decimal(12,2)")).cast("double").alias("balance")
    )


def published_ab(spark: SparkSession, sf_dir: str) -> DataFrame:
    place, customers = scratch_place(spark, "segments"), load(spark, sf_dir, "customer")
    # The third publish shows all customers again, in the copy written first.
    for rows in (customers, customers.where(F.col("c_acctbal") > 0), customers):
        publish_ab(_by_segment(rows), place)
    return spark.table(place.table).withColumn("shown", F.lit(active_copy(spark, place)))


def published_incrementally(spark: SparkSession, sf_dir: str) -> DataFrame:
    place, customers = scratch_place(spark, "segments"), load(spark, sf_dir, "customer")
    in_debt = F.col("c_acctbal") < 0
    publish_ab(_by_segment(customers.where(~in_debt)), place)
    publish_ab(_by_segment(customers.where(in_debt)).withColumn("in_debt", F.lit(True)), place, incremental=True)
    return spark.table(place.table).withColumn("shown", F.lit(active_copy(spark, place)))


def published_to_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    place, customers = scratch_place(spark, "segments"), load(spark, sf_dir, "customer")
    columns = "(n bigint, c_mktsegment varchar(20), c_nationkey int, balance double)"
    for rows in (customers.where(F.col("c_acctbal") > 0), customers):
        publish_warehouse(_by_segment(rows), place, columns)
    return spark.table(place.table).withColumn("shown", F.lit(active_copy(spark, place)))


QUERIES = {
    "publish_ab": published_ab,
    "publish_ab_incremental": published_incrementally,
    "publish_warehouse": published_to_warehouse,
}

_BY_SEGMENT = """
    SELECT c_mktsegment, c_nationkey, count(*) AS n,
           CAST(sum(CAST(c_acctbal AS DECIMAL(12, 2))) AS DOUBLE) AS balance{more}
    FROM customer {where} GROUP BY c_mktsegment, c_nationkey
"""

ORACLES = {
    "publish_ab": _BY_SEGMENT.format(more=", '_a' AS shown", where=""),
    "publish_ab_incremental": " UNION ALL ".join(
        [
            _BY_SEGMENT.format(more=", CAST(NULL AS BOOLEAN) AS in_debt, '_b' AS shown", where="WHERE c_acctbal >= 0"),
            _BY_SEGMENT.format(more=", TRUE AS in_debt, '_b' AS shown", where="WHERE c_acctbal < 0"),
        ]
    ),
    "publish_warehouse": _BY_SEGMENT.format(more=", '_b' AS shown", where=""),
}
