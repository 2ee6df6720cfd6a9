"""Shared by the checks: inputs, scratch databases, and values both engines print alike."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from datamove.layout import Layout, Place
from datamove.session import scratch_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Day up to which the orders and events are taken as loaded already.
ORDERS_CUT = "1999-06-30"
EVENTS_CUT = "2024-01-20"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(spark: SparkSession, sf_dir: str) -> None:
    """Views of the tables for SQL texts."""
    for name in TABLES:
        load(spark, sf_dir, name).createOrReplaceTempView(name)


def scratch_place(spark: SparkSession, name: str) -> Place:
    """A table of its own in a database of its own, with files in the shared scratch folder."""
    root = scratch_path(spark, "check")
    database = f"check_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    return Place(f"{root}/{name}", database, name, f"{name}_tv")


def scratch_layout(spark: SparkSession, group: str) -> Layout:
    """A layout below the shared scratch folder whose databases exist already."""
    root, env = scratch_path(spark, "check"), uuid.uuid4().hex[:12]
    layout = Layout(root=f"{root}/", env=env)
    for place in (layout.raw(group, "s", "o"), layout.conformance(group, "o"), layout.published(group, "o")):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {place.database} LOCATION '{root}/{place.database}'")
    return layout


def staged(df: DataFrame) -> DataFrame:
    """A written copy in the shared folder, for a frame that is read more than once."""
    path = scratch_path(df.sparkSession, "staged")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def day_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def moment_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def readable(df: DataFrame) -> DataFrame:
    """Dates as text, which both engines write the same way."""
    return df.select(
        *[day_text(f.name) if f.dataType.typeName().startswith("timestamp") else f.name for f in df.schema.fields]
    )
