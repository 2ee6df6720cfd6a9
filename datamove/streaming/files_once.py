"""Loading each landed file exactly once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from datamove.functions.flatten import flatten_structs
from datamove.layout import Place
from datamove.session import drop_path
from datamove.sinks.publish import publish_ab, view_property
from datamove.sinks.tables import ROWS_PER_FILE, ensure_database, holds, table_location
from datamove.sources.files import delimited_options, file_type, json_options, literal_path, read_by_header, select_files, selection

# Column of the arrivals table that marks the batch, and the view property that names the
# batch it shows.
_BATCH = "arrived_batch"
_PUBLISHED = "datamove.arrived_batch"


@dataclass(frozen=True)
class Landing:
    """Files that arrive in a directory, and how to read them.

    ``archive`` (outside ``path``) is where finished files are moved; a file moves one batch
    after it was loaded.  ``files_per_batch`` bounds the files one batch takes on a large
    backlog.  Give ``schema`` for anything but a first look: an inferred one costs a pass
    over all landed files and may differ between calls.  Files with a header are each read by their own;
    ``evolve`` adds the columns that the table lacks instead of refusing them, those the schema lacks too as text.
    """

    path: str
    kind: str
    prefix: str = ""
    schema: T.StructType | str | None = None
    delimiter: str | None = None
    header: bool = True
    multi_line: bool = True
    archive: str | None = None
    files_per_batch: int | None = None
    evolve: bool = False


def ingest_files_once(spark: SparkSession, landing: Landing, table: str, path: str, checkpoint: str) -> DataFrame:
    """Append the files that landed since the last call to ``table``; returns the table.

    A file stream that stops when it has caught up: the checkpoint remembers which files
    were taken.  Each batch is written beside the table first, then its files are moved into it one by one, and a ledger notes
    the batch.  A run that fails half-way and is repeated moves what is left, so a file is loaded
    once wherever it stopped.  Nothing new is success.  The table may have been written by anything but a
    stream with a log of its own, which would hide the rows.  When it exists, its column types win
    where they hold the files' values.
    """
    return _run(spark, landing, table, path, checkpoint, stamp=None)


def replace_with_new_files(spark: SparkSession, landing: Landing, place: Place, checkpoint: str) -> DataFrame:
    """Make ``place`` hold just the files that landed since the last call; returns it.

    The stream first appends them to an arrivals table, marked with the time of their batch;
    all batches later than the one noted on the view are then published together, and the
    last of them is noted in the same operation.  So a run that stopped in between is made up
    for by the next one, and a call without new files leaves the table alone.
    """
    landing = replace(landing, files_per_batch=None)
    arrivals = f"{place.database}.{place.name}_arrivals"
    arrived = _run(spark, landing, arrivals, f"{place.path}_arrivals", checkpoint, stamp=_BATCH)
    newest = arrived.agg(F.max(_BATCH).cast("string")).first()[0] if arrived.columns else None
    if newest is None:
        return arrived.drop(_BATCH)
    published = view_property(spark, place, _PUBLISHED)
    if published != newest:
        fresh = arrived
        if published is not None:
            fresh = arrived.where(F.col(_BATCH) > F.lit(published).cast("timestamp"))
        publish_ab(fresh.drop(_BATCH), place, properties={_PUBLISHED: newest})
    return spark.table(place.table)


def _run(
    spark: SparkSession, landing: Landing, table: str, path: str, checkpoint: str, stamp: str | None
) -> DataFrame:
    ensure_database(spark, table.split(".")[0])
    exists = spark.catalog.tableExists(table)
    schema, kind = landing.schema, file_type(landing.kind)
    if schema is None:
        if select_files(spark, landing.path, landing.prefix, landing.kind).isEmpty():
            return spark.table(table) if exists else spark.createDataFrame([], T.StructType())
        schema = _inferred(spark, landing)
    if exists:
        _check_log(spark, table)
    if kind.delimiter is None or not landing.header or not landing.evolve:  # known before a file is opened
        _fitting(_read(spark, landing, schema, []), table, stamp, landing.evolve)
    # The stream tells which files arrived; their contents are read by batch.
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    reader = reader.options(**selection(landing.prefix, kind.ending))
    if landing.archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", landing.archive)
    if landing.files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", landing.files_per_batch)
    # The batch's own time, which a repeated batch repeats.
    listed = reader.load(landing.path).select("path", F.current_timestamp().alias("stamp"))
    failed: list[Exception] = []

    def take(batch: DataFrame, number: int) -> None:
        try:
            _take(spark, landing, schema, table, path, checkpoint, stamp, batch, number)
        except Exception as error:
            failed.append(error)
            raise

    try:
        listed.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    except StreamingQueryException:
        if failed:
            raise failed[0] from None
        raise
    if not spark.catalog.tableExists(table):
        return spark.createDataFrame([], T.StructType())
    spark.catalog.refreshTable(table)
    return spark.table(table)


def _take(
    spark: SparkSession, landing: Landing, schema: T.StructType | str, table: str, path: str, checkpoint: str, stamp: str | None, batch: DataFrame, number: int
) -> None:
    """Load one batch of files, or what is left of it where an earlier run stopped."""
    ledger, beside = f"{checkpoint}/ledger/{number}", f"{checkpoint}/arrived/{number}"
    if _exists(spark, ledger):
        return
    # As many rows as the batch has files, which the stream has listed on the driver too.
    rows = batch.collect()
    if not rows:
        return
    if not _exists(spark, f"{beside}/_SUCCESS"):
        arrived = _read(spark, landing, schema, [r["path"] for r in rows])
        if stamp is not None:
            arrived = arrived.withColumn(stamp, F.lit(rows[0]["stamp"]))
        arrived = _fitting(arrived, table, None, landing.evolve)
        if not spark.catalog.tableExists(table):
            nothing = spark.createDataFrame([], arrived.schema).write.format("parquet").option("path", path)
            (nothing.partitionBy(stamp) if stamp is not None else nothing).saveAsTable(table)
        parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
        writer = arrived.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE)
        (writer.partitionBy(*parts) if parts else writer).parquet(beside)
    moved = _move(spark, beside, table_location(spark, table))
    if any("=" in name for name in moved):
        spark.sql(f"MSCK REPAIR TABLE {table}")
    _mark(spark, ledger)
    drop_path(spark, beside)


def _read(spark: SparkSession, landing: Landing, schema: T.StructType | str, paths: list[str]) -> DataFrame:
    kind = file_type(landing.kind)
    if kind.delimiter is not None and landing.header:
        return read_by_header(spark, paths, landing.kind, landing.delimiter, schema, landing.evolve)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not paths:
        return flatten_structs(spark.createDataFrame([], wanted)) if kind.delimiter is None else spark.createDataFrame([], wanted)
    reader = spark.read.schema(wanted).options(**_parsing(landing))
    literal = [literal_path(p) for p in paths]
    return flatten_structs(reader.json(literal)) if kind.delimiter is None else reader.csv(literal)


def _fitting(arrived: DataFrame, table: str, stamp: str | None, evolve: bool) -> DataFrame:
    """``arrived`` with the table's columns, to which new ones are added first with ``evolve``."""
    spark = arrived.sparkSession
    if not spark.catalog.tableExists(table):
        return arrived
    loaded = [f for f in spark.table(table).schema.fields if f.name != stamp]
    if evolve:
        known = {f.name.lower() for f in loaded}
        new = [f for f in arrived.schema.fields if f.name.lower() not in known]
        if new:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
            loaded = [f for f in spark.table(table).schema.fields if f.name != stamp]
    return _as_loaded(arrived, loaded)


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    target, files = _files(spark, path)
    return files.exists(target)


def _mark(spark: SparkSession, path: str) -> None:
    target, files = _files(spark, path)
    files.create(target, True).close()


def _move(spark: SparkSession, source: str, target: str) -> list[str]:
    """Move the data files below ``source`` to the same places below ``target``; returns these places.

    A file that was moved before is not there any more, so a repeated call moves the rest.
    """
    root, files = _files(spark, source)
    to, _ = _files(spark, target)
    top = files.getFileStatus(root).getPath().toString().rstrip("/") + "/"
    moved = []
    for found in _listed(files, root):
        place = found.toString().removeprefix(top)
        goal = spark._jvm.org.apache.hadoop.fs.Path(to, place)
        files.mkdirs(goal.getParent())
        if not files.rename(found, goal):
            raise OSError(f"{found.toString()} could not be moved to {goal.toString()}")
        moved.append(place)
    return moved


def _listed(files, root) -> Iterator:
    found = files.listFiles(root, True)
    while found.hasNext():
        path = found.next().getPath()
        if not path.getName().startswith(("_", ".")):
            yield path


def _check_log(spark: SparkSession, table: str) -> None:
    if _exists(spark, f"{table_location(spark, table)}/_spark_metadata"):
        raise ValueError(f"{table} was written by a stream with a log of its own, which hides other rows; write it anew first")


def _parsing(landing: Landing) -> dict[str, str]:
    if file_type(landing.kind).delimiter is None:
        return json_options(landing.multi_line)
    return delimited_options(landing.kind, landing.delimiter, landing.header)


def _inferred(spark: SparkSession, landing: Landing) -> T.StructType:
    kind = file_type(landing.kind)
    reader = spark.read.options(**selection(landing.prefix, kind.ending), **_parsing(landing))
    if kind.delimiter is None:
        return reader.json(landing.path).schema
    return reader.option("inferSchema", "true").csv(landing.path).schema


def _as_loaded(arrived: DataFrame, loaded: list[T.StructField]) -> DataFrame:
    known = {f.name.lower() for f in loaded}
    extra = [c for c in arrived.columns if c.lower() not in known]
    if extra:
        raise ValueError(f"files have columns the table lacks: {extra}")
    kinds = {f.name.lower(): f.dataType for f in arrived.schema.fields}
    narrowed = [f.name for f in loaded if not holds(f.dataType, kinds.get(f.name.lower(), f.dataType))]
    if narrowed:
        raise TypeError(f"the table does not hold the files' values of {narrowed}")
    present = {c.lower() for c in arrived.columns}
    return arrived.select(
        *[
            (F.col(f"`{f.name}`") if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in loaded
        ]
    )
