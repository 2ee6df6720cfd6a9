"""Loading one source table into the raw layer, in full or by increments."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from datamove.functions.normalize import normalize_types
from datamove.layout import Place, backup_path
from datamove.operators.audit import profile_columns, profile_from_summary, reconcile
from datamove.operators.incremental import (
    BROADCAST_BYTES,
    changed_rows,
    frequent_keys,
    high_watermark,
    key_bytes,
    latest_per_key,
    merge_upsert,
)
from datamove.session import drop_path, scratch_path
from datamove.sinks.publish import EmptyResult, active_copy, publish_ab, view_property
from datamove.sinks.tables import merge_into_partitions, write_table
from datamove.sinks.versions import Slices, current_version, merge_or_publish_version, publish_version
from datamove.sources.extract import JdbcSource, Source, extract_balanced, extract_keyrange, extract_query, extract_table

AUDIT_TABLE = "meta_audit_table"
# View property that notes the newest change merged.
_WATERMARK = "datamove.watermark"


@dataclass(frozen=True)
class RawLoad:
    """What to load and how.

    ``query`` replaces ``table`` as what is extracted.  ``key`` is needed for increments and
    makes a full load read in ``source_partitions`` parallel ranges of ``split_by``, a number,
    date or timestamp, which is the key unless another column is named; ``balanced`` cuts these where equally many rows
    lie between, for keys with gaps, at the price of sorting them in the database.  ``normalize`` brings the
    types to what the lake stores, with its columns of numbers without a precision
    (``unbounded``), row ids and ``dates`` without time of day.  ``overlap`` re-reads that much before the
    watermark; ``latest_only`` keeps the newest of several changes to one key.

    ``partition_by`` and ``files`` shape the target, ``in_partitions`` merges by rewriting
    only the touched partitions, ``slices`` keeps the target in that many slices of the key and merges by rewriting only the
    touched ones, ``broadcast_bytes`` is how large the increment's keys may be
    in memory to be sent to every executor, and ``buckets`` stores the target in that many buckets of
    the key, so merges leave it unshuffled.  ``spread_hot_keys`` looks, before a merge too
    large to broadcast, for keys that own many of the loaded rows, at the price of reading
    the key column once.  ``audit`` profiles source and target into ``meta_audit_table``
    under ``request_id``.
    """

    table: str
    target: Place
    key: str | None = None
    query: str | None = None
    incremental: bool = False
    update_column: str = "update_timestamp"
    overlap: dt.timedelta | None = None
    latest_only: bool = False
    normalize: bool = False
    source_partitions: int = 1
    split_by: str | None = None
    balanced: bool = False
    unbounded: tuple[str, ...] = ()
    row_ids: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    broadcast_bytes: int = BROADCAST_BYTES
    partition_by: str | None = None
    files: int = 0
    in_partitions: bool = False
    spread_hot_keys: bool = True
    buckets: int = 0
    slices: int = 0
    audit: bool = False
    request_id: int = 0


@dataclass(frozen=True)
class LoadResult:
    """``kind`` is ``full``, ``merged`` or ``unchanged``; ``rows`` counts the table now."""

    kind: str
    rows: int


def load_raw(spark: SparkSession, source: Source, load: RawLoad) -> LoadResult:
    """Extract, normalise, merge with what is loaded, publish and audit.

    An increment on a table that does not exist becomes a full load.  An empty full extract
    is an error, an empty increment is success and writes nothing.
    """
    if load.incremental and load.key is None:
        raise ValueError(f"incremental load of {load.table} needs a key")
    if bool(load.in_partitions) + bool(load.buckets) + bool(load.slices) > 1:
        raise ValueError("a table is merged by partition, by bucket or by slice, not by several of them")
    if load.slices and load.key is None:
        raise ValueError(f"slices of {load.table} need a key")
    if load.incremental and spark.catalog.tableExists(load.target.table):
        kind = _increment(spark, source, load)
    else:
        _full(spark, source, load)
        kind = "full"
    if load.audit and kind != "unchanged":
        _audit(spark, source, load)
    # Counted from file footers.
    return LoadResult(kind, spark.table(load.target.table).count())


def _full(spark: SparkSession, source: Source, load: RawLoad) -> None:
    # Publishing refuses an empty extract, so nothing is read ahead to find out.
    extract = _normal(_extract(spark, source, load), source, load)
    try:
        if load.slices or load.in_partitions and load.partition_by is not None:
            publish_version(extract, load.target, _slices(load))
        else:
            publish_ab(extract, load.target, partition_by=load.partition_by, files=load.files, bucket_by=_buckets(load))
    except EmptyResult:
        raise ValueError(f"no rows extracted from {load.table}") from None


def _increment(spark: SparkSession, source: Source, load: RawLoad) -> str:
    loaded = spark.table(load.target.table)
    watermark = _watermark(spark, load, loaded)
    since = watermark - load.overlap if watermark is not None and load.overlap is not None else watermark
    changed = changed_rows(_extract(spark, source, load, True, since), watermark, load.update_column, load.overlap)
    # The merge reads the increment more than once; a copy in the shared folder makes that
    # one read of the source, of one consistent state, that survives lost executors.
    staged = scratch_path(spark, "increment")
    try:
        _normal(changed, source, load).write.parquet(staged)
        increment = spark.read.parquet(staged)
        if load.latest_only:
            increment = latest_per_key(increment, _stored(load, load.key), _stored(load, load.update_column))
        return _merge(spark, load, loaded, increment, watermark)
    finally:
        drop_path(spark, staged)


def _merge(spark: SparkSession, load: RawLoad, loaded: DataFrame, increment: DataFrame, watermark: Any) -> str:
    key, column = _stored(load, load.key), _stored(load, load.update_column)
    found = increment.agg(
        F.count(F.lit(1)).alias("rows"), F.max(column).alias("newest"), key_bytes(key).alias("bytes")
    ).first()
    if found.rows == 0:
        return "unchanged"
    newest = found.newest if watermark is None else max(watermark, found.newest or watermark)
    noted = _note(newest, increment.schema[column].dataType)
    # A bucketed table is joined bucket by bucket, which does not move it either.
    small = found.bytes <= load.broadcast_bytes and not load.buckets
    if current_version(spark, load.target) is not None:
        whole = merge_upsert(loaded, increment, key, broadcast_keys=small)
        merge_or_publish_version(whole, increment, load.target, key, broadcast_keys=small, properties=noted)
        return "merged"
    if load.in_partitions and load.partition_by is not None:
        table = f"{load.target.database}.{load.target.name}{active_copy(spark, load.target)}"
        backup = backup_path(load.target.path, dt.datetime.now(dt.timezone.utc))
        hot = frequent_keys(loaded, key) if load.spread_hot_keys and not small else []
        if merge_into_partitions(table, increment, key, load.partition_by, backup, broadcast_keys=small, hot_keys=hot):
            spark.catalog.refreshTable(load.target.table)
            for name, value in noted.items():
                spark.sql(f"ALTER VIEW {load.target.table} SET TBLPROPERTIES ('{name}' = '{value}')")
            return "merged"
    hot = []
    if load.buckets:
        increment = increment.repartition(load.buckets, key)
    elif load.spread_hot_keys and not small:
        hot = frequent_keys(loaded, key)
    publish_ab(
        merge_upsert(
            loaded,
            increment,
            key,
            broadcast_keys=small,
            hot_keys=hot,
            co_located=load.buckets > 0,
            broadcast_limit=load.broadcast_bytes,
        ),
        load.target,
        partition_by=load.partition_by,
        files=load.files,
        # The loaded rows are counted in file footers; together they bound the result.
        rows=loaded.count() + found.rows,
        bucket_by=_buckets(load),
        # Old rows are read bucket by bucket and the increment was just grouped the same way.
        grouped=True,
        properties=noted,
    )
    return "merged"


def _watermark(spark: SparkSession, load: RawLoad, loaded: DataFrame) -> Any:
    """The newest loaded change: as noted by the last merge, else looked up in the table.

    The note spares each increment a pass over the whole table.  It is never newer than the
    table; where a merge in partitions failed to renew it, some rows are merged once more,
    which replaces them by themselves as long as they have a key.
    """
    column = _stored(load, load.update_column)
    noted = view_property(spark, load.target, _WATERMARK)
    if noted is None:
        return high_watermark(loaded, column)
    if isinstance(loaded.schema[column].dataType, T.DateType):
        return dt.date.fromisoformat(noted)
    moment = dt.datetime.fromisoformat(noted)
    # As Spark hands it out: in the driver's local time.
    return moment if moment.tzinfo is None else moment.astimezone().replace(tzinfo=None)


def _note(newest: Any, kind: T.DataType) -> dict[str, str]:
    """The property that notes a watermark: an instant in UTC, or a wall-clock time as it is."""
    if isinstance(newest, dt.datetime) and isinstance(kind, T.TimestampType):
        newest = newest.astimezone(dt.timezone.utc)
    return {_WATERMARK: newest.isoformat()} if isinstance(newest, dt.date) else {}


def _stored(load: RawLoad, column: str) -> str:
    return column.lower() if load.normalize else column


def _slices(load: RawLoad) -> Slices:
    if load.slices:
        return Slices(key=_stored(load, load.key), buckets=load.slices)
    return Slices(column=_stored(load, load.partition_by))


def _buckets(load: RawLoad) -> tuple[int, str] | None:
    return (load.buckets, _stored(load, load.key)) if load.buckets and load.key is not None else None


def _whole(spark: SparkSession, source: Source, load: RawLoad, by_timestamp: bool = False) -> DataFrame:
    if load.query is not None:
        return extract_query(spark, source, load.query, by_timestamp)
    return extract_table(spark, source, load.table, by_timestamp)


def _extract(spark: SparkSession, source: Source, load: RawLoad, by_timestamp: bool = False, since: Any = None) -> DataFrame:
    whole, split = _whole(spark, source, load, by_timestamp), load.split_by or load.key
    table = load.table
    if isinstance(source, JdbcSource) and since is not None:
        # Ranges of an increment lie between the keys of its own rows, and the database looks at no others.
        table = f"(SELECT * FROM {load.table} WHERE {load.update_column} > {source.literal(since)}) changed"
    # Only a database needs ranges; file splits divide a lake table already.
    if isinstance(source, JdbcSource) and load.query is None and split is not None and load.source_partitions > 1:
        if _can_split(whole, split) and load.balanced:
            return extract_balanced(spark, source, table, split, load.source_partitions, by_timestamp=by_timestamp)
        if _can_split(whole, split):
            return extract_keyrange(spark, source, table, split, load.source_partitions, by_timestamp=by_timestamp)
    return whole


def _can_split(df: DataFrame, column: str) -> bool:
    kinds = (T.NumericType, T.DateType, T.TimestampType)
    return any(f.name.lower() == column.lower() and isinstance(f.dataType, kinds) for f in df.schema.fields)


def _normal(df: DataFrame, source: Source, load: RawLoad) -> DataFrame:
    if not load.normalize:
        return df
    return normalize_types(df, source.dialect, unbounded=load.unbounded, row_ids=load.row_ids, dates=load.dates)


def _audit(spark: SparkSession, source: Source, load: RawLoad) -> None:
    schema_name, _, table_name = load.table.rpartition(".")
    label, loaded = (source.dialect or "lake").lower(), spark.table(load.target.table)
    if load.query is not None:
        # A query is asked once: its result is kept while its columns are profiled one by one.
        kept = scratch_path(spark, "audit")
        _normal(_whole(spark, source, load), source, load).write.parquet(kept)
        before = profile_columns(spark.read.parquet(kept), label, schema_name, table_name)
    elif isinstance(source, JdbcSource):
        # Aggregated by the database: one row travels, not the table.
        columns = extract_table(spark, source, load.table).columns
        summary = source.summary(spark, load.table, columns)
        before = profile_from_summary(summary, [_stored(load, c) for c in columns], label, schema_name, table_name)
    else:
        extract = _normal(_extract(spark, source, load), source, load)
        before = profile_columns(extract, label, schema_name, table_name)
    after = profile_columns(loaded, "lake", load.target.database, load.target.name)
    parent = load.target.path.rpartition("/")[0]
    write_table(
        reconcile(before, after, load.request_id),
        f"{load.target.database}.{AUDIT_TABLE}",
        f"{parent}/{AUDIT_TABLE}",
        mode="append",
        rows=len(loaded.columns) * 2,
    )
