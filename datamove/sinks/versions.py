"""Tables kept in slices: a merge rewrites the slices it touches and switches readers in one catalog change.

A slice is the rows of one partition value, or of one bucket of the key.  Each version of the table is a
catalog table whose partitions lie where each slice was last written, in the folder of that version or of an
earlier one; files are never changed.  Readers use a view, and replacing it is what makes a version current, so
they see all of a merge or nothing of it, wherever it stops.  The version before stays for rollback.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from datamove.layout import Place
from datamove.operators.incremental import merge_upsert, row_hash, touched_partitions
from datamove.session import drop_path
from datamove.sinks.publish import EmptyResult, check_name, sql_text, view_property
from datamove.sinks.tables import ROWS_PER_FILE, ensure_database

# Properties of the view: the version it shows, and how the table is sliced.
_VERSION, _COLUMN, _KEY, _BUCKETS = (f"datamove.{n}" for n in ("version", "slice_column", "slice_key", "slice_buckets"))

# Partition column of a table sliced by its key.
BUCKET = "__bucket"

# Fixed value: the folder name Spark gives to rows without a partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

# Partitions that one catalog statement adds.
_AT_ONCE = 200


@dataclass(frozen=True)
class Slices:
    """By the values of ``column``, or in ``buckets`` of the ``key``."""

    column: str | None = None
    key: str | None = None
    buckets: int = 0

    def __post_init__(self) -> None:
        if (self.column is None) == (self.key is None) or (self.key is None) != (self.buckets == 0):
            raise ValueError("name a column, or a key and a number of buckets")

    @property
    def folder(self) -> str:
        return BUCKET if self.column is None else self.column

    def bucket(self, df: DataFrame) -> Column:
        """Rows without a key are dealt out by a hash of the row."""
        key = F.col(_quoted(self.key))
        chance = F.when(key.isNull(), row_hash(df)).otherwise(F.xxhash64(key))
        return F.pmod(chance, F.lit(self.buckets)).cast("int")

    def put(self, df: DataFrame) -> DataFrame:
        """``df`` with its slices as Spark's folders hold them."""
        if self.column is None:
            return df.withColumn(BUCKET, self.bucket(df))
        if isinstance(df.schema[self.column].dataType, T.StringType):  # a null and an empty text are one slice
            place = F.col(_quoted(self.column))
            return df.withColumn(self.column, F.when(place != "", place))
        return df


@dataclass(frozen=True)
class Merged:
    """The version made, and how many of its slices were written for it."""

    version: int
    slices: int
    written: int


def current_version(spark: SparkSession, place: Place) -> int | None:
    """The version readers see, or None where the table is not kept in versions."""
    found = view_property(spark, place, _VERSION)
    return None if found is None else int(found)


def publish_version(
    df: DataFrame, place: Place, slices: Slices, allow_empty: bool = False, properties: Mapping[str, str] | None = None
) -> Merged:
    """Make ``df`` the whole table, as a version of its own."""
    spark = df.sparkSession
    ensure_database(spark, place.database)
    check_name(spark, place)
    version = _next(current_version(spark, place))
    columns = df.columns
    written = _write(slices.put(df), place, slices, version)
    if not written and not allow_empty:
        raise EmptyResult(f"refusing to publish an empty {place.table}")
    _switch(spark, place, slices, slices.put(df).schema, columns, {f: version for f in written}, version, properties)
    return Merged(version, len(written), len(written))


def merge_version(
    new: DataFrame,
    place: Place,
    key: str | Sequence[str],
    broadcast_keys: bool = False,
    hot_keys: Iterable[Any] = (),
    properties: Mapping[str, str] | None = None,
) -> Merged | None:
    """Merge ``new`` by rewriting only the slices that hold its keys, or held them.

    Slices all of whose rows went elsewhere are left out of the new version, in the same step.  Columns may be
    added or missing; files written before read as null there.  Returns None, having changed nothing, where a type changed, or
    the table is sliced by buckets of another key: then the whole table has to be written.  Which slices
    a table has is known to the driver, as it is to the catalog; rows are not.
    """
    spark = new.sparkSession
    before = current_version(spark, place)
    if before is None:
        raise ValueError(f"{place.table} is not kept in versions")
    slices = _slices(spark, place)
    old = spark.table(_physical(place, before))
    visible = spark.table(place.table)
    kinds = {f.name.lower(): f.dataType for f in visible.schema.fields}
    if any(kinds.get(f.name.lower(), f.dataType) != f.dataType for f in new.schema.fields):
        return None
    keys = [key] if isinstance(key, str) else list(key)
    if slices.column is None and [k.lower() for k in keys] != [slices.key.lower()] or slices.column is not None and slices.column not in new.columns:
        return None
    manifest = _manifest(spark, place, before)
    new = slices.put(new).drop(BUCKET)
    if slices.column is None:
        reached = new.select(slices.bucket(new).alias("slice"))
    else:
        reached = touched_partitions(visible, new, key, slices.column, broadcast_keys).select(F.col(_quoted(slices.column)).alias("slice"))
    touched = {r[0] for r in reached.select(F.col("slice").cast("string")).distinct().collect()}
    # The slice is the partition column, so nothing else is read.
    at = F.col(_quoted(slices.folder)).cast("string")
    here = at.isin(sorted(t for t in touched if t is not None))
    held = old.where(F.coalesce(here, F.lit(None in touched))).select(*map(_quoted, visible.columns))
    merged = merge_upsert(held, new, key, broadcast_keys=broadcast_keys, hot_keys=hot_keys)
    version = _next(before)
    columns, placed = merged.columns, slices.put(merged)
    written = _write(placed, place, slices, version)
    kept = {f: v for f, v in manifest.items() if _value(f) not in touched}
    _switch(spark, place, slices, placed.schema, columns, kept | {f: version for f in written}, version, properties)
    return Merged(version, len(kept) + len(written), len(written))


def merge_or_publish_version(merged: DataFrame, new: DataFrame, place: Place, key: str | Sequence[str], **options: Any) -> Merged:
    """``merge_version``, or where that cannot be, ``merged`` as the whole table."""
    done = merge_version(new, place, key, **options)
    if done is not None:
        return done
    return publish_version(merged, place, _slices(new.sparkSession, place), properties=options.get("properties"))


def roll_back(spark: SparkSession, place: Place) -> int:
    """Show the version before the current one again; returns it."""
    version = current_version(spark, place)
    before = version - 1 if version else None
    if before is None or not spark.catalog.tableExists(_physical(place, before)):
        raise ValueError(f"{place.table} has no version before")
    slices = _slices(spark, place)
    columns = [c for c in spark.table(_physical(place, before)).columns if c != BUCKET]
    shown = [c for c in spark.table(place.table).columns if c in columns]
    _point(spark, place, slices, shown, before, None)
    return before


def _next(version: int | None) -> int:
    return 0 if version is None else version + 1


def _physical(place: Place, version: int) -> str:
    return f"{place.database}.{place.name}_v{version}"


def _folder(place: Place, version: int) -> str:
    return f"{place.path}/v{version}"


def _slices(spark: SparkSession, place: Place) -> Slices:
    column, key, buckets = (view_property(spark, place, p) for p in (_COLUMN, _KEY, _BUCKETS))
    return Slices(column or None, key or None, int(buckets or 0))


def _value(folder: str) -> str | None:
    text = folder.partition("=")[2]
    return None if text == NO_VALUE else unquote(text)


def _write(df: DataFrame, place: Place, slices: Slices, version: int) -> list[str]:
    """Write a version's own slices; returns the folders made.  What a stopped attempt left there is replaced."""
    path = _folder(place, version)
    grouped = df.hint("rebalance", slices.folder)
    writer = grouped.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(slices.folder)
    writer.parquet(path)
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return sorted(s.getPath().getName() for s in listed if s.isDirectory() and "=" in s.getPath().getName())


def _note(spark: SparkSession, place: Place, manifest: Mapping[str, int], version: int) -> None:
    rows = spark.createDataFrame(sorted(manifest.items()), "folder string, version int")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{place.path}/manifest/v{version}")


def _manifest(spark: SparkSession, place: Place, version: int) -> dict[str, int]:
    """The version that last wrote each slice."""
    return {r["folder"]: r["version"] for r in spark.read.parquet(f"{place.path}/manifest/v{version}").collect()}


def _register(spark: SparkSession, place: Place, slices: Slices, schema: T.StructType, manifest: Mapping[str, int], version: int) -> None:
    table = _physical(place, version)
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # left by a stopped attempt
    fields = [f for f in schema.fields if f.name != slices.folder] + [f for f in schema.fields if f.name == slices.folder]
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({_quoted(slices.folder)}) LOCATION {sql_text(_folder(place, version))}")
    parts = []
    for folder, written in sorted(manifest.items()):
        value = _value(folder)
        literal = "NULL" if value is None else sql_text(value)
        parts.append(f"PARTITION ({_quoted(slices.folder)} = {literal}) LOCATION {sql_text(_folder(place, written) + '/' + folder)}")
    for i in range(0, len(parts), _AT_ONCE):
        spark.sql(f"ALTER TABLE {table} ADD {' '.join(parts[i : i + _AT_ONCE])}")


def _point(spark: SparkSession, place: Place, slices: Slices, columns: Sequence[str], version: int, properties: Mapping[str, str] | None) -> None:
    noted = {_VERSION: str(version), _COLUMN: slices.column or "", _KEY: slices.key or "", _BUCKETS: str(slices.buckets)} | dict(properties or {})
    listed = ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in noted.items())
    shown = ", ".join(map(_quoted, columns))
    spark.sql(f"CREATE OR REPLACE VIEW {place.table} TBLPROPERTIES ({listed}) AS SELECT {shown} FROM {_physical(place, version)}")


def _switch(
    spark: SparkSession,
    place: Place,
    slices: Slices,
    schema: T.StructType,
    columns: Sequence[str],
    manifest: Mapping[str, int],
    version: int,
    properties: Mapping[str, str] | None,
) -> None:
    _note(spark, place, manifest, version)
    _register(spark, place, slices, schema, manifest, version)
    _point(spark, place, slices, columns, version, properties)
    _forget(spark, place, version - 2)


def _forget(spark: SparkSession, place: Place, version: int) -> None:
    """Drop a version that is neither current nor for rollback, and the slices that only it shows."""
    if version < 0 or not spark.catalog.tableExists(_physical(place, version)):
        return
    gone = set(_manifest(spark, place, version).items())
    for later in (version + 1, version + 2):
        gone -= set(_manifest(spark, place, later).items())
    spark.sql(f"DROP TABLE {_physical(place, version)}")
    for folder, written in sorted(gone):
        drop_path(spark, f"{_folder(place, written)}/{folder}")
    drop_path(spark, f"{place.path}/manifest/v{version}")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
