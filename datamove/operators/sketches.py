"""Column profiles that are kept for each load and united, so that an increment alone is read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from datamove.operators.audit import profile_from_summary

# Size of the distinct-count sketch: two to this many registers, for a relative error of about 0.8 percent.
REGISTERS = 14

# Size of the quantile sketch, for a rank error of about 1.3 percent.
ITEMS = 200

_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_DIRECT = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def sketch_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row that sums up ``df``: for each column its ends, null count, a distinct-count sketch and, for numbers, a quantile sketch.

    One pass, in which tasks send a sketch each.  Rows of several loads are united by ``unite_sketches``.  Columns go
    by their place: ``lo0, hi0, nulls0, seen0, spread0, lo1, ...``; ``rows`` counts rows.
    """
    names = list(columns) if columns is not None else df.columns
    kinds = {f.name: f.dataType for f in df.schema.fields}
    parts = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(names):
        value, kind = F.col(_quoted(name)), kinds[name]
        ordered = F.to_json(F.struct(value)) if isinstance(kind, (T.MapType, T.VariantType)) else value
        countable = ordered if isinstance(kind, _DIRECT) else F.xxhash64(ordered)
        parts += [
            F.min(ordered).alias(f"lo{i}"),
            F.max(ordered).alias(f"hi{i}"),
            F.sum(F.when(value.isNull(), 1).otherwise(0)).cast("long").alias(f"nulls{i}"),
            F.hll_sketch_agg(F.when(value.isNotNull(), countable), REGISTERS).alias(f"seen{i}"),
        ]
        if isinstance(kind, _NUMBERS):
            number = value.cast("double")
            usable = F.when(~F.isnan(number), number)
            parts.append(F.kll_sketch_agg_double(usable, ITEMS).alias(f"spread{i}"))
    return df.agg(*parts)


def unite_sketches(sketches: DataFrame) -> DataFrame:
    """One row that sums up all loads whose rows ``sketches`` has.

    It says what was loaded: a row that a later load replaced still counts among the values seen.
    """
    parts: list[Column] = [F.sum("rows").alias("rows")]
    for name in sketches.columns:
        if name == "rows":
            continue
        if name.startswith("lo"):
            made = F.min(name)
        elif name.startswith("hi"):
            made = F.max(name)
        elif name.startswith("nulls"):
            made = F.sum(name)
        elif name.startswith("seen"):
            made = F.hll_union_agg(name)
        else:
            made = F.kll_merge_agg_double(name)
        parts.append(made.alias(name))
    return sketches.agg(*parts)


def profile_from_sketches(sketches: DataFrame, columns: Sequence[str], source: str, schema_name: str, table_name: str) -> DataFrame:
    """The column profile of all loads in ``sketches``; ends are exact, distinct counts estimates."""
    united = unite_sketches(sketches)
    summary = united.select(*[c for c in united.columns if c[:2] in ("lo", "hi")], *[F.coalesce(F.hll_sketch_estimate(f"seen{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(columns))])
    return profile_from_summary(summary, columns, source, schema_name, table_name)


def quantiles(sketches: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """``column_name``, ``share`` and ``value`` of the number columns of all loads in ``sketches``; null without values."""
    united = unite_sketches(sketches)
    found = []
    for i, name in enumerate(columns):
        if f"spread{i}" not in united.columns:
            continue
        filled = F.kll_sketch_get_n_double(f"spread{i}") > 0
        for share in shares:
            value = F.when(filled, F.kll_sketch_get_quantile_double(f"spread{i}", F.lit(float(share))))
            found.append(F.struct(F.lit(name).alias("column_name"), F.lit(float(share)).alias("share"), value.alias("value")))
    if not found:
        return united.select(F.lit("").alias("column_name"), F.lit(0.0).alias("share"), F.lit(None).cast("double").alias("value")).limit(0)
    return united.select(F.inline(F.array(*found)))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
