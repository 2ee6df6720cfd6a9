"""Publishing through two copies: write the idle one, then repoint the stable name."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from datamove.layout import Place
from datamove.operators.incremental import align_schemas
from datamove.session import drop_path, scratch_path
from datamove.sinks.tables import ensure_database, write_table
from datamove.sources.extract import JdbcSource

# The two copies.
COPIES = ("_a", "_b")
# Property of the stable view that says which copy it shows.
_ACTIVE = "datamove.active_copy"
# Property that counts the parts appended to that copy, and how many make a new copy due: until
# then an append costs its own rows, and every row is rewritten once in so many appends.
_PARTS = "datamove.appended_parts"
MOST_PARTS = 32


class EmptyResult(ValueError):
    """There is nothing to publish."""


def next_copy(active: str | None) -> str:
    """The copy to write next: ``_a`` at first, then the other one; a fixed suffix stays."""
    if active is None:
        return COPIES[0]
    return {COPIES[0]: COPIES[1], COPIES[1]: COPIES[0]}.get(active, active)


def active_copy(spark: SparkSession, place: Place) -> str | None:
    """Suffix of the copy the stable name shows now, or None before the first publish."""
    return view_property(spark, place, _ACTIVE)


def view_property(spark: SparkSession, place: Place, key: str) -> str | None:
    """A property of the stable view, or None where the view or the property is missing."""
    if not spark.catalog.tableExists(place.table):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {place.table}").where(F.col("key") == key).first()
    return None if found is None else found["value"]


def publish_ab(
    df: DataFrame,
    place: Place,
    incremental: bool = False,
    partition_by: str | None = None,
    files: int = 0,
    rows: int | None = None,
    bucket_by: tuple[int, str] | None = None,
    grouped: bool = False,
    allow_empty: bool = False,
    properties: Mapping[str, str] | None = None,
) -> str:
    """Write ``df`` to the idle copy of ``place`` and repoint its view; returns the suffix.

    ``incremental`` publishes the active rows plus ``df``: where neither columns nor layout
    change, ``df`` is written as a further part of the active copy and the view takes it in,
    until ``MOST_PARTS`` are due to become one copy; else all rows are written anew.  The stable name is a view, so
    repointing is one catalog operation that also carries the flip: readers see the old
    copy or the new one, and a failed write changes nothing.  The previous copy stays for
    rollback until the next publish.  An empty result is refused unless ``allow_empty``.
    ``properties`` are put on the view in the same operation.
    """
    spark = df.sparkSession
    check_name(spark, place)
    active = active_copy(spark, place)
    if incremental and active is not None:
        before = spark.table(place.table)
        loaded, added = align_schemas(before, df)
        parts = int(view_property(spark, place, _PARTS) or 0)
        df = loaded.unionByName(added)
        if partition_by is None and bucket_by is None and parts < MOST_PARTS and _same_columns(before.schema, df.schema):
            part = f"{active}_p{parts}"
            write_table(added, f"{place.database}.{place.name}{part}", place.path + part, files=files, rows=rows)
            _repoint(spark, place, active, parts + 1, properties)
            return active
    copy = next_copy(active)
    physical = f"{place.database}.{place.name}{copy}"
    write_table(
        df,
        physical,
        place.path + copy,
        partition_by=partition_by,
        files=files,
        rows=rows,
        bucket_by=bucket_by,
        grouped=grouped,
    )
    if not allow_empty and spark.table(physical).isEmpty():
        raise EmptyResult(f"refusing to publish an empty {place.table}")
    # Parts of this copy are from before it was written anew.
    _drop_parts(spark, place, copy)
    _repoint(spark, place, copy, 0, properties)
    return copy


def _drop_parts(spark: SparkSession, place: Place, copy: str) -> None:
    part = 0
    while spark.catalog.tableExists(f"{place.database}.{place.name}{copy}_p{part}"):
        spark.sql(f"DROP TABLE {place.database}.{place.name}{copy}_p{part}")
        drop_path(spark, f"{place.path}{copy}_p{part}")
        part += 1


def publish_warehouse(df: DataFrame, place: Place, columns: str) -> str:
    """Load ``df`` into the idle warehouse table and repoint the view; returns the suffix.

    The table is created from ``columns`` (a DDL column list, with or without its outer
    parentheses) if it is absent or was made from another list, emptied, and filled by column
    name; then the view over it is replaced.
    """
    spark = df.sparkSession
    ensure_database(spark, place.database)
    check_name(spark, place)
    copy = next_copy(active_copy(spark, place))
    physical = f"{place.database}.{place.name}{copy}"
    wanted = T.StructType.fromDDL(bare_columns(columns))
    if spark.catalog.tableExists(physical) and not _same_columns(spark.table(physical).schema, wanted):
        # Readers are on the other copy, so this one can be made anew.
        spark.sql(f"DROP TABLE {physical}")
    location = sql_text(f"{place.path}{copy}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {physical} ({bare_columns(columns)}) USING parquet LOCATION {location}")
    # Overwriting a table in place truncates and loads it in one committed write.
    missing = {f.name.lower() for f in wanted.fields} - {c.lower() for c in df.columns}
    if missing:
        raise ValueError(f"nothing to load into the columns {sorted(missing)}")
    df.select(*spark.table(physical).columns).write.mode("overwrite").insertInto(physical)
    _repoint(spark, place, copy)
    return copy


@dataclass(frozen=True)
class JdbcWarehouse:
    """A warehouse database reached over JDBC; its view is repointed after a counted load."""

    connection: JdbcSource
    schema: str
    # Connections that load at the same time.
    writers: int = 8

    def publish(self, df: DataFrame, name: str, view: str, active: str | None, columns: str | None = None) -> str:
        """Truncate and load the idle table, check its row count, replace the view.

        Returns the new suffix, for the caller to store.  A retried task may have loaded its
        rows twice, which a database cannot undo on its own, hence the check before readers
        are moved over.
        """
        spark = df.sparkSession
        copy = next_copy(active)
        table = f"{self.schema}.{name}{copy}"
        options = self.connection.connection() | {"dbtable": table, "truncate": "true"}
        if columns is not None:
            options["createTableColumnTypes"] = bare_columns(columns)
        options["numPartitions"] = str(self.writers)
        # Written once in the shared folder: what is loaded is what is counted, in file footers.
        kept = scratch_path(spark, "warehouse")
        try:
            df.write.parquet(kept)
            rows = spark.read.schema(df.schema).parquet(kept)
            self._load(rows, options)
            expected = rows.count()
        finally:
            drop_path(spark, kept)
        loaded = self.connection.query(spark, f"SELECT COUNT(*) AS n FROM {table}").first()[0]
        if int(loaded) != expected:
            raise RuntimeError(f"{table} holds {loaded} rows after loading {expected}; view not repointed")
        self._execute(spark, f"CREATE OR REPLACE VIEW {self.schema}.{view} AS SELECT * FROM {table}")
        return copy

    def _load(self, df: DataFrame, options: Mapping[str, str]) -> None:
        df.write.format("jdbc").options(**options).mode("overwrite").save()

    def _execute(self, spark: SparkSession, statement: str) -> None:
        # Spark writes tables over JDBC but has no call for a view, so the statement goes
        # through the driver's own connection.
        settings = self.connection.connection()
        jvm = spark._jvm
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(settings["driver"])
        opened = jvm.java.sql.DriverManager.getConnection(settings["url"], settings["user"], settings["password"])
        try:
            opened.createStatement().execute(statement)
        finally:
            opened.close()


def _same_columns(a: T.StructType, b: T.StructType) -> bool:
    return [(f.name.lower(), f.dataType) for f in a.fields] == [(f.name.lower(), f.dataType) for f in b.fields]


def sql_text(text: str) -> str:
    """A text as a literal of a statement."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bare_columns(columns: str) -> str:
    text = columns.strip()
    return text[1:-1] if text.startswith("(") and text.endswith(")") else text


def check_name(spark: SparkSession, place: Place) -> None:
    if spark.catalog.tableExists(place.table) and spark.catalog.getTable(place.table).tableType != "VIEW":
        raise ValueError(f"{place.table} is a table; rename it before publishing a view under its name")


def _repoint(spark: SparkSession, place: Place, copy: str, parts: int = 0, properties: Mapping[str, str] | None = None) -> None:
    noted = {_ACTIVE: copy, _PARTS: str(parts)} | dict(properties or {})
    listed = ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in noted.items())
    tables = [f"{place.database}.{place.name}{copy}{part}" for part in ["", *[f"_p{i}" for i in range(parts)]]]
    rows = " UNION ALL ".join(f"SELECT * FROM {table}" for table in tables)
    spark.sql(f"CREATE OR REPLACE VIEW {place.table} TBLPROPERTIES ({listed}) AS {rows}")
