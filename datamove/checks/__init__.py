"""Queries over the supplied tables that exercise every operator, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from datamove.checks import audit, files, incremental, jobs, lookups, publish, sources, tables, transforms

Query = Callable[[SparkSession, str], DataFrame]

_AREAS = (sources, incremental, audit, tables, files, transforms, publish, lookups, jobs)


def all_queries() -> dict[str, Query]:
    return {name: query for area in _AREAS for name, query in area.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for area in _AREAS for name, sql in area.ORACLES.items()}
