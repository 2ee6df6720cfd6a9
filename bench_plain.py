"""Time plain formulations of a few operators, as a yardstick for ``bench.py``.

Each does what the operator of the same name does, written the first way that comes to
mind: ``NOT IN`` for a merge, one aggregate with every distinct count for a profile, a
ranking window for the latest row, whole copies around an overwrite.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from datamove.checks.audit import PROFILED
from datamove.checks.common import EVENTS_CUT, load, scratch_place
from datamove.checks.incremental import orders_changed, orders_loaded, orders_now
from datamove.session import build_session, scratch_path


def _not_in(spark: SparkSession, old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    old.createOrReplaceTempView("plain_old")
    new.createOrReplaceTempView("plain_new")
    return spark.sql(f"SELECT * FROM plain_old WHERE {key} NOT IN (SELECT {key} FROM plain_new)").unionByName(new)


def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _not_in(spark, orders_loaded(spark, sf_dir), orders_changed(spark, sf_dir), "o_orderkey")


def load_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    place, root = scratch_place(spark, "orders"), scratch_path(spark, "plain")
    orders_loaded(spark, sf_dir).write.parquet(f"{root}/before")
    orders_now(spark, sf_dir).write.parquet(f"{root}/after")
    spark.read.parquet(f"{root}/before").coalesce(1).write.option("path", place.path).saveAsTable(place.table)
    for n in range(2):
        spark.read.parquet(place.path).write.parquet(f"{root}/landing{n}")
        landed = spark.read.parquet(f"{root}/landing{n}")
        mark = landed.agg(F.max("update_timestamp")).first()[0]
        new = spark.read.parquet(f"{root}/after").where(F.col("update_timestamp") > F.lit(mark).cast("timestamp_ntz"))
        if new.isEmpty():
            continue
        merged = _not_in(spark, landed, new, "o_orderkey").cache()
        merged.count()
        spark.read.parquet(place.path).write.parquet(f"{root}/backup{n}")
        merged.coalesce(1).write.mode("overwrite").option("path", place.path).saveAsTable(place.table)
        merged.unpersist()
    return spark.table(place.table)


def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = None
    for table, columns in PROFILED.items():
        row = load(spark, sf_dir, table).agg(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.min(c).cast("string").alias("min"),
                    F.max(c).cast("string").alias("max"),
                    F.count_distinct(c).alias("count"),
                ).alias(c)
                for c in columns
            ]
        )
        profile = row.select(F.inline(F.array(*columns))).withColumn("table_name", F.lit(table))
        profiles = profile if profiles is None else profiles.unionByName(profile)
    return profiles


def merge_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    newest = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))

    def latest(df: DataFrame) -> DataFrame:
        return df.withColumn("rn", F.row_number().over(newest)).where("rn = 1").drop("rn")

    early = F.col("ts") <= F.lit(EVENTS_CUT).cast("timestamp_ntz")
    return _not_in(spark, latest(events.where(early)), latest(events.where(~early)), "user_id")


PLAIN = {f.__name__: f for f in (merge_upsert, load_raw, profile_columns, merge_latest_per_key)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench-plain",
        f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, query in PLAIN.items():
        taken = []
        for _ in range(2):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(min(taken), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({"metric": "plain formulations", "queries": seconds}))


if __name__ == "__main__":
    main()
