"""Writing tables: size, layout, partition overwrite, copies."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from datamove.operators.incremental import align_schemas, merge_upsert, touched_partitions

# Fixed values of the sizing rule: rows per output file, and most files it asks for.
ROWS_PER_FILE = 1_000_000
MOST_FILES = 200


def plan_output_files(rows: int, explicit: int = 0, rows_per_file: int = ROWS_PER_FILE, most: int | None = MOST_FILES) -> int:
    """Number of output files: the explicit count if any, else one per million rows, 1 to ``most``."""
    wanted = max(1, rows // rows_per_file)
    return explicit or (wanted if most is None else min(most, wanted))


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def write_table(
    df: DataFrame,
    table: str,
    path: str,
    mode: str = "overwrite",
    partition_by: str | None = None,
    files: int = 0,
    rows: int | None = None,
    bucket_by: tuple[int, str] | None = None,
    grouped: bool = False,
) -> None:
    """Write ``df`` as the external Parquet table ``database.name`` at ``path``.

    ``mode`` is ``overwrite`` (the whole table), ``append``, or ``dynamic``: replace only the
    partitions that occur in ``df`` and keep the others.

    ``files`` is the most writing tasks, to which the rows are dealt once they are made;
    ``rows``, where known, deals them to as many tasks as the sizing rule has files, without its
    upper limit, which would leave a large table to 200 tasks.  Neither holds up the tasks that read and
    join, nor depends on the number of cores.  Without either the frame's own partitions are kept.  A partitioned table is regrouped by partition value, and Spark
    splits a value again that is oversized.  No file exceeds the rule's rows.

    ``dynamic`` refuses columns the table lacks and values its types do not hold.

    ``bucket_by`` (count, column) stores rows grouped by key, so later merges on that key
    do not have to shuffle the table; ``grouped`` says the frame already is.  One key is
    always in one bucket, so leave it where few keys own most rows.
    """
    spark = df.sparkSession
    most_rows = ROWS_PER_FILE
    if mode not in ("overwrite", "append", "dynamic"):
        raise ValueError(f"unknown write mode {mode!r}")
    ensure_database(spark, table.split(".")[0])
    if bucket_by is not None:
        df = df if grouped else df.repartition(*bucket_by)
    elif files:
        # Fewer tasks than the cluster has slots would also read and join in so few.
        df = df.repartition(files) if files < spark.sparkContext.defaultParallelism else df.coalesce(files)
    elif partition_by is not None:
        df = df.hint("rebalance", partition_by)
    elif rows is not None:
        df = df.repartition(plan_output_files(rows, rows_per_file=ROWS_PER_FILE, most=None))
        most_rows = 2 * ROWS_PER_FILE  # of a task, where the last million is not full
    if mode == "dynamic" and partition_by is None:
        raise ValueError("mode 'dynamic' needs partition_by")
    if mode == "dynamic" and spark.catalog.tableExists(table):
        _overwrite_partitions(df, table, partition_by)
        return
    writer = df.write.format("parquet").option("path", path).option("maxRecordsPerFile", most_rows).mode("append" if mode == "append" else "overwrite")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    if bucket_by is not None:
        writer = writer.bucketBy(*bucket_by)
    # Saving as a table also registers its partitions.
    writer.saveAsTable(table)


def snapshot_copy(spark: SparkSession, path: str, target: str, partition_by: Sequence[str] = ()) -> None:
    """Copy a Parquet directory, keeping its partition layout, by parallel tasks.

    Partition values are read as text, so ``01`` is not rewritten as ``1``.
    """
    names = set(partition_by)
    frame = spark.read.parquet(path)
    if names:
        text = [T.StructField(f.name, T.StringType() if f.name in names else f.dataType) for f in frame.schema.fields]
        frame = spark.read.schema(T.StructType(text)).parquet(path)
    writer = frame.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)


def merge_into_partitions(
    table: str,
    new: DataFrame,
    key: str | Sequence[str],
    partition_by: str,
    backup: str,
    broadcast_keys: bool = False,
    hot_keys: Iterable[Any] = (),
    most: int | None = None,
) -> bool:
    """Merge ``new`` into a partitioned table by rewriting only the partitions it touches.

    The touched partitions are first copied to ``backup``; the merge reads that copy, so
    nothing is read from where it is written, and the copy remains for rollback.  Partitions
    all of whose rows moved elsewhere are dropped.  A null and an empty text are one partition,
    as they are in the table's directories.  Returns False, having changed nothing, where the
    increment adds columns, changes types, or touches more than ``most`` partitions where the
    caller sets such a limit: then the whole table has to be rewritten.
    """
    spark = new.sparkSession
    old = spark.table(table)
    kinds = {f.name.lower(): f.dataType for f in old.schema.fields}
    if partition_by not in new.columns or any(kinds.get(f.name.lower()) != f.dataType for f in new.schema.fields):
        return False
    if isinstance(old.schema[partition_by].dataType, T.StringType):
        place = F.col(_quoted(partition_by))
        new = new.withColumn(partition_by, F.when(place != "", place))
    # The touched values stay a frame: they are joined to the old rows, never collected.
    touched = touched_partitions(old, new, key, partition_by, broadcast_keys)
    if most is not None and touched.limit(most + 1).count() > most:
        return False
    here = touched.select(F.col(_quoted(partition_by)).alias("__touched__"))
    moved = old.join(here, F.col(_quoted(partition_by)).eqNullSafe(F.col("__touched__")), "left_semi")
    moved.write.mode("overwrite").partitionBy(partition_by).parquet(backup)
    before = spark.read.schema(old.schema).parquet(backup).select(*map(_quoted, old.columns))
    merged = merge_upsert(before, new, key, broadcast_keys=broadcast_keys, hot_keys=hot_keys)
    location = table_location(spark, table)
    write_table(merged, table, location, mode="dynamic", partition_by=partition_by)
    _drop_emptied(spark, table, partition_by, before, new, key, broadcast_keys)
    return True


def _drop_emptied(
    spark: SparkSession, table: str, partition_by: str, before: DataFrame, new: DataFrame, key: str | Sequence[str], broadcast_keys: bool
) -> None:
    """Drop the partitions of ``before`` that the merge left without a row."""
    keys = [key] if isinstance(key, str) else list(key)
    placed = [frame.select(*map(_quoted, [*keys, partition_by])) for frame in (before, new)]
    left = merge_upsert(*placed, key, broadcast_keys=broadcast_keys).select(_quoted(partition_by)).distinct()
    was, now = (f.select(F.col(_quoted(partition_by)).cast("string").alias("v")).distinct() for f in (placed[0], left))
    emptied = was.alias("was").join(now.alias("now"), F.col("was.v").eqNullSafe(F.col("now.v")), "left_anti")
    # One catalog call a partition, as it comes; the list is never held.
    for row in emptied.toLocalIterator():
        _empty_partition(spark.table(table), table, partition_by, row["v"])


def _overwrite_partitions(df: DataFrame, table: str, partition_by: str) -> None:
    # A write to the table's files: inserting by table name does not take the per-write
    # overwrite mode, and saving as a table would drop and recreate its catalog entry.
    spark = df.sparkSession
    fields = spark.table(table).schema.fields
    _, given = align_schemas(spark.table(table), df)
    extra = [c for c in df.columns if c.lower() not in {f.name.lower() for f in fields}]
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    narrowed = [f.name for f in fields if not holds(f.dataType, kinds.get(f.name.lower(), f.dataType))]
    if extra or narrowed:
        raise TypeError(f"{table} lacks the columns {extra} and does not hold the values of {narrowed}")
    typed = [F.col(_quoted(f.name)).cast(f.dataType).alias(f.name) for f in fields]
    writer = given.select(*typed).write.partitionBy(partition_by).mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE)
    writer.option("partitionOverwriteMode", "dynamic").parquet(table_location(spark, table))
    spark.catalog.refreshTable(table)
    spark.sql(f"MSCK REPAIR TABLE {table}")


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def holds(kind: T.DataType, given: T.DataType) -> bool:
    """Whether a column of ``kind`` takes values of type ``given`` as they are."""
    if kind == given or isinstance(given, T.NullType) or isinstance(kind, T.StringType):
        return True
    if type(kind) in _WHOLE and type(given) in _WHOLE:
        return _WHOLE.index(type(given)) <= _WHOLE.index(type(kind))
    if isinstance(kind, T.DoubleType):
        return isinstance(given, (T.FloatType, T.ByteType, T.ShortType, T.IntegerType))
    if isinstance(kind, T.DecimalType) and isinstance(given, T.DecimalType):
        return given.scale <= kind.scale and given.precision - given.scale <= kind.precision - kind.scale
    return isinstance(kind, (T.TimestampType, T.TimestampNTZType)) and isinstance(given, T.DateType)


def table_location(spark: SparkSession, table: str) -> str:
    """Where the files of an external table lie."""
    described = spark.sql(f"DESCRIBE EXTENDED {table}")
    return described.where("col_name = 'Location'").first()["data_type"]


def _empty_partition(old: DataFrame, table: str, partition_by: str, value: str | None) -> None:
    spark = old.sparkSession
    literal = "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    nothing = spark.createDataFrame([], old.drop(partition_by).schema)
    place = f"PARTITION ({_quoted(partition_by)} = {literal})"
    spark.sql(f"INSERT OVERWRITE TABLE {table} {place} SELECT * FROM {{nothing}}", nothing=nothing)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {place}")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
