"""Running a SQL text and saving its result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from datamove.sinks.tables import write_table


def run_transform(
    spark: SparkSession,
    sql: str,
    table: str,
    path: str,
    incremental: bool = False,
    partition_by: str | None = None,
) -> DataFrame:
    """Run any Spark SQL text and save the result as a table; returns the table.

    Overwrites, or appends when ``incremental``.
    """
    write_table(
        spark.sql(sql), table, path, mode="append" if incremental else "overwrite", partition_by=partition_by
    )
    return spark.table(table)
