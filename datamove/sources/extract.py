"""Extracting tables, queries and key ranges from databases and from the lake."""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Driver class per database dialect, rows fetched per round trip, and the
# timestamp format Oracle sessions need when rows are selected by timestamp.
DRIVERS = {
    "MYSQL": "com.mysql.jdbc.Driver",
    "SAP": "com.sap.db.jdbc.Driver",
    "MSSQL": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "POSTGRES": "org.postgresql.Driver",
    "ORACLE": "oracle.jdbc.OracleDriver",
}
FETCH_SIZE = 100_000
ORACLE_TIMESTAMPS = "ALTER SESSION SET NLS_TIMESTAMP_FORMAT = 'YYYY-MM-DD hh24:mi:ss.ff'"


class Bounds(NamedTuple):
    """Smallest and largest key (None when there is none) and the number of rows."""

    lower: Any
    upper: Any
    rows: int


@dataclass(frozen=True)
class JdbcSource:
    """A database.  Connection values never show in its text form."""

    dialect: str
    url: str = field(repr=False)
    user: str = field(repr=False)
    password: str = field(repr=False)
    options: Mapping[str, str] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        if self.dialect not in DRIVERS:
            raise ValueError(f"unknown dialect {self.dialect!r}, expected one of {sorted(DRIVERS)}")

    def connection(self, by_timestamp: bool = False) -> dict[str, str]:
        settings = {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": DRIVERS[self.dialect],
            "fetchsize": str(FETCH_SIZE),
        }
        if by_timestamp and self.dialect == "ORACLE":
            settings["sessionInitStatement"] = ORACLE_TIMESTAMPS
        return settings | dict(self.options)

    def table(self, spark: SparkSession, table: str, by_timestamp: bool = False) -> DataFrame:
        return self._load(spark, by_timestamp, dbtable=table)

    def query(self, spark: SparkSession, sql: str, by_timestamp: bool = False) -> DataFrame:
        return self._load(spark, by_timestamp, query=sql)

    def bounds(self, spark: SparkSession, table: str, key: str) -> DataFrame:
        # Asked of the database, so one row travels instead of the key column.
        return self.query(spark, f"SELECT MIN({key}) AS lo, MAX({key}) AS hi, COUNT(*) AS n FROM {table}")

    def summary(self, spark: SparkSession, table: str, columns: Sequence[str]) -> DataFrame:
        """One row with ``lo0, hi0, n0, lo1, ...``, aggregated by the database."""
        parts = [f"MIN({c}) AS lo{i}, MAX({c}) AS hi{i}, COUNT(DISTINCT {c}) AS n{i}" for i, c in enumerate(columns)]
        return self.query(spark, f"SELECT {', '.join(parts)} FROM {table}")

    def ranges(
        self, spark: SparkSession, table: str, key: str, bounds: Bounds, partitions: int, by_timestamp: bool = False
    ) -> DataFrame:
        if bounds.lower is None:
            return self.table(spark, table, by_timestamp)
        return self._load(
            spark,
            by_timestamp,
            dbtable=table,
            partitionColumn=key,
            lowerBound=str(bounds.lower),
            # The upper bound only sets the stride; rows beyond either bound are still read.
            upperBound=str(bounds.upper + 1 if isinstance(bounds.upper, int) else bounds.upper),
            numPartitions=str(partitions),
        )

    def cuts(self, spark: SparkSession, table: str, key: str, partitions: int) -> list[Any]:
        """Where ranges of equally many rows begin, all but the first; sorted out by the database."""
        parts = f"SELECT {key} AS k, NTILE({partitions}) OVER (ORDER BY {key}) AS part FROM {table} WHERE {key} IS NOT NULL"
        begins = self.query(spark, f"SELECT MIN(k) AS k FROM ({parts}) parts GROUP BY part")
        return sorted({r[0] for r in begins.collect()})[1:]

    def between(self, spark: SparkSession, table: str, key: str, cuts: Sequence[Any], by_timestamp: bool = False) -> DataFrame:
        """One task for each range; rows without a key are in the first."""
        marks = [self.literal(c) for c in cuts]
        if not marks:
            return self.table(spark, table, by_timestamp)
        inner = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(marks, marks[1:])]
        ranges = [f"{key} < {marks[0]} OR {key} IS NULL", *inner, f"{key} >= {marks[-1]}"]
        settings = self.connection(by_timestamp)
        return spark.read.jdbc(settings.pop("url"), table, predicates=ranges, properties=settings)

    def literal(self, value: Any) -> str:
        """A number, date or time as the database reads it in a statement."""
        if isinstance(value, dt.datetime):
            text = f"'{value.isoformat(sep=' ')}'"
            return text if self.dialect == "MSSQL" else f"TIMESTAMP {text}"
        if isinstance(value, dt.date):
            return f"'{value.isoformat()}'" if self.dialect == "MSSQL" else f"DATE '{value.isoformat()}'"
        if isinstance(value, (int, float, decimal.Decimal)):
            return str(value)
        raise TypeError(f"ranges need a number, date or time, not {type(value).__name__}")

    def _load(self, spark: SparkSession, by_timestamp: bool, **options: str) -> DataFrame:
        return spark.read.format("jdbc").options(**self.connection(by_timestamp), **options).load()


@dataclass(frozen=True)
class CatalogSource:
    """Tables of the session's catalog."""

    dialect: str | None = None

    def table(self, spark: SparkSession, table: str, by_timestamp: bool = False) -> DataFrame:
        return spark.table(table)

    def query(self, spark: SparkSession, sql: str, by_timestamp: bool = False) -> DataFrame:
        return spark.sql(sql)

    def bounds(self, spark: SparkSession, table: str, key: str) -> DataFrame:
        return self.table(spark, table).agg(
            F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n")
        )

    def ranges(
        self, spark: SparkSession, table: str, key: str, bounds: Bounds, partitions: int, by_timestamp: bool = False
    ) -> DataFrame:
        # File splits already divide the scan over tasks; asking for key ranges here would
        # read the files once per range or shuffle the table.
        return self.table(spark, table, by_timestamp)


    def cuts(self, spark: SparkSession, table: str, key: str, partitions: int) -> list[Any]:
        if partitions < 2:
            return []
        # A sketch of the key column: its ranks are off by a hundredth of a range at most.
        shares = [F.lit(i / partitions) for i in range(1, partitions)]
        accuracy = F.lit(100 * partitions)
        found = self.table(spark, table).agg(F.percentile_approx(key, F.array(*shares), accuracy).alias("cuts")).first()["cuts"]
        return sorted(set(found or []))

    def between(self, spark: SparkSession, table: str, key: str, cuts: Sequence[Any], by_timestamp: bool = False) -> DataFrame:
        return self.table(spark, table, by_timestamp)


@dataclass(frozen=True)
class ParquetSource(CatalogSource):
    """Parquet tables addressed by path, ``location`` holding a ``{table}`` placeholder."""

    location: str = "{table}"

    def table(self, spark: SparkSession, table: str, by_timestamp: bool = False) -> DataFrame:
        return spark.read.parquet(self.location.format(table=table))


Source = JdbcSource | CatalogSource


def extract_table(spark: SparkSession, source: Source, table: str, by_timestamp: bool = False) -> DataFrame:
    """The whole table."""
    return source.table(spark, table, by_timestamp)


def extract_query(spark: SparkSession, source: Source, sql: str, by_timestamp: bool = False) -> DataFrame:
    """The result of a query evaluated by the source."""
    return source.query(spark, sql, by_timestamp)


def key_bounds(spark: SparkSession, source: Source, table: str, key: str) -> Bounds:
    """Smallest and largest value of a number, date or timestamp, and the row count, in one query."""
    found = source.bounds(spark, table, key)
    moment = isinstance(found.schema["lo"].dataType, (T.DateType, T.TimestampType))
    ends = [F.col(c) if moment else F.col(c).cast("long") for c in ("lo", "hi")]
    row = found.select(*ends, "n").first()
    return Bounds(row[0], row[1], int(row[2]))


def extract_keyrange(
    spark: SparkSession,
    source: Source,
    table: str,
    key: str,
    partitions: int,
    bounds: Bounds | None = None,
    by_timestamp: bool = False,
) -> DataFrame:
    """The whole table, read by parallel tasks that each take one range of a numeric key.

    Rows with a null key belong to the first range.  Where keys are unevenly spread, pass a
    subquery as ``table`` that adds an evenly spread number, and that number as ``key``.
    """
    bounds = bounds or key_bounds(spark, source, table, key)
    return source.ranges(spark, table, key, bounds, partitions, by_timestamp)


def extract_balanced(
    spark: SparkSession, source: Source, table: str, key: str, partitions: int, cuts: Sequence[Any] | None = None, by_timestamp: bool = False
) -> DataFrame:
    """The whole table, read by tasks that each take a range of about equally many rows, however the keys lie.

    ``key`` is a number, date or timestamp; rows without one belong to the first range.  A value that many rows have
    is not divided, so there may be fewer ranges.  A lake table is divided by its files' splits already.
    """
    if partitions < 2:
        return extract_table(spark, source, table, by_timestamp)
    cuts = source.cuts(spark, table, key, partitions) if cuts is None else cuts
    return source.between(spark, table, key, cuts, by_timestamp)


def range_of(key: str, cuts: Sequence[Any]) -> Column:
    """Number of the range (from 0) that a row's key falls in; null keys are in range 0."""
    at = F.lit(0)
    if cuts:
        at = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(key)))
    return F.when(F.col(key).isNull(), 0).otherwise(at).cast("int")


def key_range(key: str, bounds: Bounds, partitions: int) -> Column:
    """Number of the range (from 0) a row's key falls in; null keys are in range 0."""
    if bounds.lower is None:
        return F.lit(0)
    stride = (bounds.upper - bounds.lower) // partitions + 1
    # Whole-number division: keys beyond 2^53 would not survive a double.
    place = F.expr(f"(`{key}` - {bounds.lower}L) div {stride}L")
    within = F.greatest(F.lit(0), F.least(place, F.lit(partitions - 1)))
    return F.when(F.col(key).isNull(), 0).otherwise(within).cast("int")
