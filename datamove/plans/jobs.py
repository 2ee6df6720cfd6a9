"""Jobs described by control tables: resolving them and running one."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, fields, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from datamove.layout import Layout, Place
from datamove.operators.incremental import merge_upsert
from datamove.operators.lookups import Lookup, resolve_lookups
from datamove.plans.raw import RawLoad, load_raw
from datamove.sinks.publish import JdbcWarehouse, publish_ab, publish_warehouse
from datamove.sources.extract import Source
from datamove.streaming.files_once import Landing, ingest_files_once, replace_with_new_files

# Codes used in control tables.
LAYERS = {"R": "raw", "F": "files", "C": "conformance", "P": "publish"}
EXTRACTS = {"TB": "table", "QY": "query"}


@dataclass(frozen=True)
class Job:
    """One resolved row of the control tables."""

    group_name: str
    run_priority: int
    storage_layer: str
    extract_type: str | None
    obj_schema: str | None
    obj_name: str | None
    target_obj_schema: str | None
    target_obj_name: str | None
    transform_query: str | None
    custom_query: str | None
    delimiter_val: str | None
    inc_header: bool
    is_incremental: bool
    to_validate: bool
    obj_source: str | None
    obj_target: str | None
    source_connection_type: str | None
    target_connection_type: str | None
    source_primary_key: str | None
    target_partition_column: str | None
    source_partitions: int
    target_partitions: int
    pb_flip: str | None = None
    options: Mapping[str, str] | None = None


def _flag(text: str) -> bool:
    if text.strip().lower() not in ("true", "false"):
        raise ValueError(f"expected true or false, not {text!r}")
    return text.strip().lower() == "true"


def _names(text: str) -> tuple[str, ...]:
    return tuple(n.strip() for n in text.split(",") if n.strip())


def _minutes(text: str) -> dt.timedelta:
    return dt.timedelta(minutes=float(text))


# What a row of the options table may set for a raw load and for a file load, and how its text is read.
RAW_OPTIONS: Mapping[str, Callable[[str], Any]] = {
    "dates": _names,
    "unbounded": _names,
    "row_ids": _names,
    "split_by": str,
    "balanced": _flag,
    "overlap": _minutes,
    "latest_only": _flag,
    "normalize": _flag,
    "in_partitions": _flag,
    "spread_hot_keys": _flag,
    "buckets": int,
    "slices": int,
    "broadcast_bytes": int,
}
FILE_OPTIONS: Mapping[str, Callable[[str], Any]] = {"multi_line": _flag, "files_per_batch": int, "evolve": _flag}


def job_options(job: Job, known: Mapping[str, Callable[[str], Any]]) -> dict[str, Any]:
    """The job's options as values; one that its layer does not know is an error."""
    given = job.options or {}
    unknown = sorted(given.keys() - known.keys())
    if unknown:
        raise ValueError(f"unknown options {unknown}, expected some of {sorted(known)}")
    return {name: known[name](text) for name, text in given.items() if text is not None}


@dataclass(frozen=True)
class Outcome:
    """A job that ran, what it returned, and the error that stopped it, if any."""

    job: Job
    error: Exception | None = None
    result: Any = None


def jobs_for_group(control: Mapping[str, DataFrame], group_id: str) -> DataFrame:
    """The valid jobs of a group with connections, custom queries and load properties.

    ``control`` holds the control tables by name.  Source and target connection are two
    required roles of one table; custom queries and load properties may be missing, the
    latter then defaulting to one source partition and automatic target files.  The table
    ``meta_load_options``, where there is one, has a row for each further option of an object: ``option_name`` and
    ``option_value``, a text (see ``RAW_OPTIONS`` and ``FILE_OPTIONS``).
    """
    connections = control["meta_object_connection_map"]
    tables = control["meta_table_map"].where(F.col("logical_group_id") == group_id)
    on_object = {k: k for k in ("logical_group_id", "obj_schema", "obj_name")}
    resolved = resolve_lookups(
        tables,
        [
            Lookup(
                control["meta_logical_map"],
                {"logical_group_id": "logical_group_id"},
                {c: c for c in ("group_name", "obj_source", "obj_target")},
            ),
            Lookup(
                connections, {"obj_source": "obj_connection"}, {"source_connection_type": "connection_type"}
            ),
            Lookup(
                connections, {"obj_target": "obj_connection"}, {"target_connection_type": "connection_type"}
            ),
            Lookup(
                control["meta_object_flip"],
                {c: c for c in ("target_obj_schema", "target_obj_name")},
                {"pb_flip": "pb_flip"},
                required=False,
            ),
            Lookup(control["meta_custom_query"], on_object, {"found_query": "custom_query"}, required=False),
            Lookup(
                control["meta_raw_properties"],
                on_object,
                {
                    c: c
                    for c in ("source_primary_key", "target_partition_column", "source_partitions", "target_partitions")
                },
                required=False,
                defaults={"source_partitions": 1, "target_partitions": 0},
                only_if={
                    "source_primary_key": "source_partition_flag",
                    "target_partition_column": "target_partition_flag",
                },
            ),
        ],
        valid=F.col("is_valid"),
    )
    resolved = _with_options(resolved, control.get("meta_load_options"), on_object)
    return (
        resolved.withColumn("custom_query", F.when(F.col("custom_flag"), F.col("found_query")))
        .select(*[f.name for f in fields(Job)])
        .orderBy("run_priority")
    )


def _with_options(jobs: DataFrame, options: DataFrame | None, on_object: Mapping[str, str]) -> DataFrame:
    if options is None:
        return jobs.withColumn("options", F.lit(None).cast("map<string,string>"))
    named = F.map_from_entries(F.collect_list(F.struct("option_name", "option_value")))
    grouped = options.groupBy(*on_object).agg(named.alias("options"))
    return resolve_lookups(jobs, [Lookup(grouped, on_object, {"options": "options"}, required=False)])


def to_jobs(resolved: DataFrame) -> list[Job]:
    """Jobs in run order; a group has as many as its control table has rows."""
    return [Job(**row.asDict()) for row in resolved.collect()]


def run_job(
    spark: SparkSession,
    job: Job,
    layout: Layout,
    sources: Mapping[str, Source],
    warehouses: Mapping[str, JdbcWarehouse] | None = None,
    schema: T.StructType | str | None = None,
    update_column: str = "update_timestamp",
    request_id: int = 0,
) -> Any:
    """Run one job of any layer.  ``sources`` and ``warehouses`` go by connection name.

    Targets without a warehouse connection are published as tables of the catalog; with one,
    the suffix of the new copy is returned for ``record_flip``.  ``schema`` describes landed
    files.
    """
    if job.storage_layer not in LAYERS:
        raise ValueError(f"unknown storage layer {job.storage_layer!r}, expected one of {sorted(LAYERS)}")
    if job.storage_layer == "R":
        return _raw(spark, job, layout, sources, update_column, request_id)
    if job.storage_layer == "F":
        return _files(spark, job, layout, schema)
    if job.storage_layer == "C":
        return _conformance(spark, job, layout)
    return _publish(spark, job, layout, warehouses or {})


def record_flip(flips: DataFrame, job: Job, suffix: str, column: str = "pb_flip") -> DataFrame:
    """The flip table with the job's target set to ``suffix``, its row added if missing."""
    key = ["target_obj_schema", "target_obj_name"]
    mine = (F.col(key[0]) == job.target_obj_schema) & (F.col(key[1]) == job.target_obj_name)
    row = flips.sparkSession.createDataFrame(
        [(job.target_obj_schema, job.target_obj_name)], ", ".join(f"{k} string" for k in key)
    )
    rest = flips.where(mine).drop(column)
    changed = row.join(rest, key, "left").withColumn(column, F.lit(suffix)).select(*flips.columns)
    return merge_upsert(flips, changed, key)


@dataclass(frozen=True)
class Flips:
    """The published copy of each warehouse target, in a table that outlives the run."""

    spark: SparkSession
    place: Place

    def table(self) -> DataFrame:
        if self.spark.catalog.tableExists(self.place.table):
            return self.spark.table(self.place.table)
        return self.spark.createDataFrame([], "target_obj_schema string, target_obj_name string, pb_flip string")

    def active(self, job: Job) -> str | None:
        mine = (F.col("target_obj_schema") == job.target_obj_schema) & (F.col("target_obj_name") == job.target_obj_name)
        found = self.table().where(mine).select("pb_flip").first()
        return job.pb_flip if found is None else found[0]

    def record(self, job: Job, suffix: str) -> None:
        publish_ab(record_flip(self.table(), job, suffix), self.place)


def run_group(
    control: Mapping[str, DataFrame],
    group_id: str,
    run: Callable[[Job], Any],
    flips: Flips | None = None,
) -> list[Outcome]:
    """Call ``run`` for each job of a group in priority order; a failed one does not stop the rest.

    With ``flips`` a job that publishes to a warehouse sees the copy noted there when it runs,
    not when the group was resolved, and the suffix it returns is noted at once.
    """
    jobs = to_jobs(jobs_for_group(control, group_id))
    if not jobs:
        raise ValueError(f"group {group_id!r} has no valid jobs")
    outcomes = []
    for job in jobs:
        try:
            if flips is not None and job.storage_layer == "P":
                job = replace(job, pb_flip=flips.active(job))
            result = run(job)
            if flips is not None and job.storage_layer == "P" and isinstance(result, str):
                flips.record(job, result)
            outcomes.append(Outcome(job, result=result))
        except Exception as error:  # noqa: BLE001 - reported in the outcome
            outcomes.append(Outcome(job, error))
    return outcomes


def _raw(spark, job, layout, sources, update_column, request_id):
    if job.extract_type not in EXTRACTS:
        raise ValueError(f"unknown extract type {job.extract_type!r}, expected one of {sorted(EXTRACTS)}")
    queried = job.extract_type == "QY"
    query = job.custom_query if queried else None
    settings = dict(
        table=f"{job.obj_schema}.{job.obj_name}",
        target=layout.raw(job.group_name, job.obj_schema, job.obj_name),
        key=job.source_primary_key,
        query=query,
        incremental=job.is_incremental,
        update_column=update_column,
        # Without a query of its own a queried object gets the generated projection.
        normalize=queried and query is None,
        source_partitions=job.source_partitions or 1,
        partition_by=job.target_partition_column,
        files=job.target_partitions or 0,
        audit=job.to_validate,
        request_id=request_id,
    )
    return load_raw(spark, sources[job.obj_source], RawLoad(**settings | job_options(job, RAW_OPTIONS)))


def _files(spark, job, layout, schema):
    place = layout.raw(job.group_name, job.target_obj_schema, job.target_obj_name)
    landing = Landing(
        layout.landing(job.group_name, job.obj_schema),
        job.extract_type,
        prefix=job.obj_name or "",
        schema=schema,
        delimiter=job.delimiter_val,
        header=job.inc_header,
        archive=layout.processed(job.group_name, job.obj_schema),
        **job_options(job, FILE_OPTIONS),
    )
    # Each target keeps its own record of the files it took.
    checkpoint = f"{place.path}_checkpoint"
    if job.is_incremental:
        return ingest_files_once(spark, landing, place.table, place.path, checkpoint)
    return replace_with_new_files(spark, landing, place, checkpoint)


def _conformance(spark, job, layout):
    place = layout.conformance(job.group_name, job.target_obj_name)
    publish_ab(spark.sql(job.transform_query), place, incremental=job.is_incremental, allow_empty=True)
    return spark.table(place.table)


def _publish(spark, job, layout, warehouses):
    # The copy to publish is looked up now, not when the request was made.
    conformed = spark.table(layout.conformance(job.group_name, job.obj_name).table)
    place = layout.published(job.group_name, job.target_obj_name)
    if job.obj_target in warehouses:
        return warehouses[job.obj_target].publish(conformed, place.name, place.view, job.pb_flip, job.transform_query)
    publish_warehouse(conformed, place, job.transform_query)
    return spark.table(place.table)
