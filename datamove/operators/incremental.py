"""Incremental loading: watermark, changed rows, schema alignment and merge by key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

# Rows of one key, or without a key, that one task takes, and the largest key set worth sending
# to every executor.
TASK_ROWS = 5_000_000
BROADCAST_BYTES = 256 * 1024 * 1024

_PIECE = "__piece"
_PIECES = "__pieces"
_PLACE = "__place"
_TEXT = (T.StringType, T.CharType, T.VarcharType)
_MOMENTS = (T.DateType, T.TimestampType, T.TimestampNTZType)


def high_watermark(df: DataFrame, column: str = "update_timestamp") -> Any:
    """Newest value of ``column`` that is already loaded, or None for an empty table."""
    return df.agg(F.max(column)).first()[0]


def changed_rows(
    df: DataFrame,
    watermark: Any,
    column: str = "update_timestamp",
    overlap: dt.timedelta | None = None,
) -> DataFrame:
    """Rows strictly newer than ``watermark``; everything when there is none yet.

    A literal comparison, so the filter is evaluated by the database or the Parquet scan.
    ``overlap`` moves the watermark back to pick up late rows and ties again; a merge by
    key makes the repetition harmless.
    """
    if watermark is None:
        return df
    if overlap is not None:
        watermark = watermark - overlap
    return df.where(F.col(column) > watermark_literal(watermark, df.schema[column].dataType))


def watermark_literal(watermark: Any, kind: T.DataType) -> Column:
    """A watermark read to the driver, as a literal of the column's type."""
    if isinstance(kind, T.TimestampNTZType):
        # A wall-clock time; a plain literal would read it in the driver's own time zone.
        return F.lit(watermark.isoformat(sep=" ")).cast(kind)
    return F.lit(watermark).cast(kind)


def column_diff(old: DataFrame, new: DataFrame) -> tuple[list[str], list[str], list[str]]:
    """``(added, dropped, merged)`` column names, compared without regard to case."""
    before, after = _lowered(old.columns), _lowered(new.columns)
    added = [c for c in new.columns if c.lower() not in before]
    dropped = [c for c in old.columns if c.lower() not in after]
    return added, dropped, old.columns + added


def align_schemas(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Give both frames the same columns: the old ones in order, then the new ones.

    A column one side lacks is filled with nulls of the other side's type; so is a field of a struct, wherever it
    stands: in a column, in another struct, in the elements of an array or the values of a map. A column or field whose
    type changed must still have a common type (numbers widen, dates become timestamps).
    """
    added, dropped, merged = column_diff(old, new)
    old_types = {f.name.lower(): f.dataType for f in old.schema.fields}
    new_types = {f.name.lower(): f.dataType for f in new.schema.fields}
    drifted = [
        f"{name}: {old_types[name].simpleString()} -> {new_types[name].simpleString()}"
        for name in old_types.keys() & new_types.keys()
        if not _compatible(old_types[name], new_types[name])
    ]
    if drifted:
        raise TypeError(f"column types changed without a common type: {sorted(drifted)}")

    def pick(present: dict[str, T.DataType], absent: dict[str, T.DataType]) -> list[Column]:
        picked = []
        for c in merged:
            own, other = present.get(c.lower()), absent.get(c.lower())
            value = F.lit(None).cast(other) if own is None else F.col(_quoted(c))
            if own is not None and other is not None and _fields_differ(own, other):
                value = _filled(value, own, _union(old_types[c.lower()], new_types[c.lower()]))
            picked.append(value.alias(c))
        return picked

    nested = any(_fields_differ(old_types[n], new_types[n]) for n in old_types.keys() & new_types.keys())
    if added or nested:
        old = old.select(*pick(old_types, new_types))
    return old, new.select(*pick(new_types, old_types))


def _fields_differ(a: T.DataType, b: T.DataType) -> bool:
    """Whether structs at the same place have other fields, or the same in another order."""
    if type(a) is not type(b):
        return False
    if isinstance(a, T.StructType):
        if [f.name.lower() for f in a.fields] != [f.name.lower() for f in b.fields]:
            return True
        return any(_fields_differ(x.dataType, y.dataType) for x, y in zip(a.fields, b.fields))
    if isinstance(a, T.ArrayType):
        return _fields_differ(a.elementType, b.elementType)
    return isinstance(a, T.MapType) and _fields_differ(a.valueType, b.valueType)


def _union(old: T.DataType, new: T.DataType) -> T.DataType:
    """The old type with the fields that only the new one has behind its own, at every depth.

    Other types stay as they are in ``old``: widening is left to the union of the rows.
    """
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        given = {f.name.lower(): f.dataType for f in new.fields}
        fields = [T.StructField(f.name, _union(f.dataType, given.pop(f.name.lower(), f.dataType))) for f in old.fields]
        return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new.fields if f.name.lower() in given])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_union(old.elementType, new.elementType))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(old.keyType, _union(old.valueType, new.valueType))
    return old


def _filled(value: Column, own: T.DataType, wanted: T.DataType) -> Column:
    """``value`` with the fields of ``wanted`` in its order, those of its own type kept; null stays null."""
    if isinstance(own, T.StructType) and isinstance(wanted, T.StructType):
        mine = {f.name.lower(): f for f in own.fields}
        parts = []
        for f in wanted.fields:
            held = mine.get(f.name.lower())
            part = F.lit(None).cast(f.dataType) if held is None else _filled(value.getField(held.name), held.dataType, f.dataType)
            parts.append(part.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(own, T.ArrayType) and isinstance(wanted, T.ArrayType) and _fields_differ(own, wanted):
        return F.transform(value, lambda x: _filled(x, own.elementType, wanted.elementType))
    if isinstance(own, T.MapType) and isinstance(wanted, T.MapType) and _fields_differ(own, wanted):
        return F.transform_values(value, lambda _, x: _filled(x, own.valueType, wanted.valueType))
    return value


def merge_upsert(
    old: DataFrame,
    new: DataFrame,
    key: str | Sequence[str],
    broadcast_keys: bool = False,
    hot_keys: Iterable[Any] = (),
    co_located: bool = False,
    broadcast_limit: int = BROADCAST_BYTES,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Old rows whose key is not in ``new``, plus every row of ``new``.

    Null keys match nothing: old rows without a key are kept, and new ones are added.
    Columns may have come or gone on either side (see ``align_schemas``).

    The increment's keys are reduced to one row each before they meet the old rows, which
    are read once.  Old rows without a key are dealt out over all tasks by a hash of the row.
    ``hot_keys`` (see ``frequent_keys``; values of a single-column key) are candidates: they are counted, and those that own
    more than ``task_rows`` rows are dealt out over as many tasks as that takes.  ``broadcast_keys`` leaves the old rows where they
    are, if the keys are measured to stay below ``broadcast_limit`` bytes.  So does
    ``co_located``, for an old table stored in buckets of the key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    old, new = align_schemas(old, new)
    replaced = new.select(*map(_quoted, keys)).where(_all_present(keys)).distinct()
    if broadcast_keys and fits_broadcast(replaced, keys, broadcast_limit):
        kept = old.join(F.broadcast(replaced), keys, "left_anti")
    elif co_located:
        kept = old.join(replaced, keys, "left_anti")
    else:
        kept = _anti_join_spread(old, replaced, keys, list(hot_keys), task_rows)
    return kept.select(*map(_quoted, old.columns)).unionByName(new)


def latest_per_key(df: DataFrame, key: str | Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """One row per key, the one greatest in ``order_by``; rows without a key are all kept.

    A ranking cut at one row per key: Spark applies the cut inside each task before it
    shuffles, so a key that owns a third of the table sends one row per task instead of all
    of them.  Equal rows in ``order_by`` are told apart by a hash of the row, so the choice
    does not depend on task order.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    parts = list(keys)
    if any(df.schema[_stored_name(df, k)].nullable for k in keys):
        # A row without a key is a group of its own, so one pass does for all.
        alone = F.when(~_all_present(keys), F.monotonically_increasing_id()).otherwise(F.lit(-1).cast("long"))
        df = df.withColumn(_PIECE, alone)
        parts.append(_PIECE)
    ties = row_hash(df.drop(_PIECE)).desc()
    newest_first = Window.partitionBy(*map(_quoted, parts)).orderBy(*[F.desc(_quoted(c)) for c in order], ties)
    latest = df.withColumn(_PLACE, F.row_number().over(newest_first))
    return latest.where(F.col(_PLACE) == 1).drop(_PLACE, _PIECE)


def frequent_keys(df: DataFrame, key: str, share: float | None = None) -> list[Any]:
    """Candidate values of ``key`` that may own more than ``share`` of the rows.

    Without a share, those with more rows than one task takes.  One pass over one column with a
    fixed-size counter table; at most ``1/share`` values come back and every value above the
    share is among them.  The result only steers how rows are spread, never which rows are kept.
    """
    if share is None:
        share = min(0.5, TASK_ROWS / max(1, df.count()))
    found = df.where(F.col(_quoted(key)).isNotNull()).select(F.col(_quoted(key)).alias("value")).stat.freqItems(["value"], share).first()[0]
    return sorted(v for v in found if v is not None)


def key_bytes(key: str | Sequence[str]) -> Column:
    """Aggregate: bytes a hash table of the key columns needs at most, null for no rows."""
    keys = [key] if isinstance(key, str) else list(key)
    # Key and value row, each with two words per column and the bytes of its text, and the
    # table's own entry.
    text = F.lit(0)
    for k in keys:
        text = text + F.coalesce(F.octet_length(F.col(_quoted(k)).cast("string")), F.lit(0))
    return F.sum((F.lit(128 + 32 * len(keys)) + 2 * text).cast("long"))


def fits_broadcast(df: DataFrame, key: str | Sequence[str], limit: int = BROADCAST_BYTES) -> bool:
    """Whether the key columns of ``df`` are proven to stay below ``limit`` bytes in memory."""
    size = df.agg(key_bytes(key)).first()[0]
    return size is None or size <= limit


def touched_partitions(
    old: DataFrame, new: DataFrame, key: str | Sequence[str], partition_by: str, broadcast_keys: bool = False
) -> DataFrame:
    """Distinct partition values the increment reaches: where its rows go and where they were.

    Reads only the key and the partition column of the old table.
    """
    keys = [key] if isinstance(key, str) else list(key)
    replaced = new.select(*map(_quoted, keys)).where(_all_present(keys)).distinct()
    if broadcast_keys and fits_broadcast(replaced, keys):
        replaced = F.broadcast(replaced)
    left = old.select(*map(_quoted, [*keys, partition_by])).join(replaced, keys, "left_semi").select(_quoted(partition_by))
    return left.unionByName(new.select(_quoted(partition_by))).distinct()


def _anti_join_spread(old: DataFrame, replaced: DataFrame, keys: list[str], candidates: list[Any], task_rows: int) -> DataFrame:
    """Anti join on the key and a piece number, which is 0 but for rows to be dealt out."""
    if candidates and len(keys) != 1:
        raise ValueError("hot keys can be named for a single key column only")
    # Rows without a key match nothing, so their pieces need no partner.
    spread = row_hash(old).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
    hot = _hot(old, keys[0], candidates, task_rows) if candidates else None
    if hot is None:
        piece = F.when(~_all_present(keys), spread).otherwise(0)
        replaced = replaced.withColumn(_PIECE, zero(*[F.col(_quoted(k)) for k in keys]))
    else:
        # One row for each key with more rows than a task takes: fewer than the table has tasks.
        pieces = F.coalesce(F.col(_PIECES), F.lit(1))
        old = old.join(hot, keys, "left")
        piece = F.when(~_all_present(keys), spread).otherwise(F.pmod(spread, pieces))
        # A hot key must be met in each of its pieces.
        replaced = replaced.join(hot, keys, "left")
        replaced = replaced.withColumn(_PIECE, F.explode(F.sequence(F.lit(0), pieces - 1))).drop(_PIECES)
    return old.withColumn(_PIECE, piece).join(replaced, [*keys, _PIECE], "left_anti")


def _hot(old: DataFrame, key: str, candidates: list[Any], task_rows: int) -> DataFrame | None:
    """The candidates that own more than ``task_rows`` rows, with the number of pieces each is cut to."""
    spark, kind = old.sparkSession, old.select(_quoted(key)).schema[0]
    asked = F.broadcast(spark.createDataFrame([(c,) for c in candidates], T.StructType([kind])).distinct())
    counted = old.select(_quoted(key)).join(asked, [key], "left_semi").groupBy(_quoted(key)).count()
    found = counted.where(F.col("count") > task_rows).collect()
    if not found:
        return None
    schema = T.StructType([kind, T.StructField(_PIECES, T.IntegerType())])
    return F.broadcast(spark.createDataFrame([(k, -(-n // task_rows)) for k, n in found], schema))


def zero(*columns: Column) -> Column:
    """Zero for every row.  Spark does not know that it is constant, so a join on it still deals rows out by it."""
    return F.pmod(F.xxhash64(*columns), F.lit(1)).cast("int")


def _stored_name(df: DataFrame, name: str) -> str:
    return next((c for c in df.columns if c.lower() == name.lower()), name)


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row; types Spark does not hash enter as JSON text."""

    def hashable(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return all(hashable(f.dataType) for f in kind.fields)
        if isinstance(kind, T.ArrayType):
            return hashable(kind.elementType)
        return not isinstance(kind, (T.MapType, T.VariantType))

    columns = [(F.col(_quoted(f.name)), f.dataType) for f in df.schema.fields]
    return F.xxhash64(*[c if hashable(kind) else F.to_json(F.struct(c)) for c, kind in columns])


def _all_present(keys: list[str]) -> Column:
    present = F.lit(True)
    for k in keys:
        present = present & F.col(_quoted(k)).isNotNull()
    return present


def _compatible(a: T.DataType, b: T.DataType) -> bool:
    """Whether every value of either type keeps its value in a type that holds both."""
    if a == b or isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return True
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        floating = [k for k in (a, b) if type(k) in _EXACT]
        if len(floating) == 1:
            other = b if floating[0] is a else a
            return _whole_digits(other) + getattr(other, "scale", 0) <= _EXACT[type(floating[0])]
        return bool(floating) or _one_holds_both(a, b)
    if type(a) is type(b) and isinstance(a, T.ArrayType):
        return _compatible(a.elementType, b.elementType)
    if type(a) is type(b) and isinstance(a, T.MapType):
        return a.keyType == b.keyType and _compatible(a.valueType, b.valueType)
    if type(a) is type(b) and isinstance(a, T.StructType):
        given = {f.name.lower(): f.dataType for f in b.fields}
        once = len(given) == len(b.fields) and len({f.name.lower() for f in a.fields}) == len(a.fields)
        shared = [(f.dataType, given[f.name.lower()]) for f in a.fields if f.name.lower() in given]
        # Structs without a field in common say nothing of each other.
        return once and (bool(shared) or not a.fields or not b.fields) and all(_compatible(x, y) for x, y in shared)
    return any(isinstance(a, kind) and isinstance(b, kind) for kind in (_TEXT, _MOMENTS))


# Decimal digits a whole number needs, and those a floating-point one holds without rounding.
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_EXACT = {T.FloatType: 7, T.DoubleType: 15}


def _whole_digits(kind: T.DataType) -> int | None:
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale
    return _WHOLE.get(type(kind))


def _one_holds_both(a: T.DataType, b: T.DataType) -> bool:
    whole = max(_whole_digits(a), _whole_digits(b))
    return whole + max(getattr(a, "scale", 0), getattr(b, "scale", 0)) <= 38


def _lowered(names: Iterable[str]) -> set[str]:
    return {n.lower() for n in names}


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
