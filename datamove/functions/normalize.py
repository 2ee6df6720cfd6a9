"""Type-normalising projection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Earliest date kept, and the type an unbounded number becomes.
EARLIEST_DATE = dt.date(1900, 1, 1)
WHOLE_NUMBER = T.DecimalType(38, 0)
# What Spark's JDBC reader yields for an Oracle NUMBER declared without precision.
ORACLE_UNBOUNDED = T.DecimalType(38, 10)


def normalize_types(
    df: DataFrame,
    dialect: str | None = None,
    unbounded: Iterable[str] = (),
    row_ids: Iterable[str] = (),
    dates: Iterable[str] = (),
) -> DataFrame:
    """Lower-case the names and bring the column types to what the lake stores.

    ``unbounded`` columns (for ``dialect="ORACLE"`` also every number read without a
    precision) become DECIMAL(38,0), ``row_ids`` become strings, ``dates`` lose their time
    of day; dates and timestamps before 1900 become 1900-01-01.  Nulls stay null and the
    column order is kept.  One projection, so filters on untouched columns still reach
    the scan.
    """
    unbounded, row_ids, dates = ({n.lower() for n in names} for names in (unbounded, row_ids, dates))
    lowered = [name.lower() for name in df.columns]
    repeated = sorted({n for n in lowered if lowered.count(n) > 1})
    if repeated:
        raise ValueError(f"column names differ only in case: {repeated}")

    def normal(field: T.StructField) -> Column:
        name = field.name.lower()
        column = df[_quoted(field.name)]
        kind = field.dataType
        if name in unbounded or (dialect == "ORACLE" and kind == ORACLE_UNBOUNDED):
            return column.cast(WHOLE_NUMBER).alias(name)
        if name in row_ids:
            return column.cast("string").alias(name)
        if name in dates:
            column, kind = F.to_date(column), T.DateType()
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            earliest = F.lit(EARLIEST_DATE).cast(kind)
            column = F.when(column < earliest, earliest).otherwise(column)
        return column.alias(name)

    return df.select(*[normal(field) for field in df.schema.fields])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
