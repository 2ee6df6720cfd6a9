"""Column profiles and the audit that compares a source with its loaded copy."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from datamove.operators.incremental import row_hash

# Longest text kept for a minimum or maximum, and the audit columns in order.
TEXT_LIMIT = 100
AUDIT_COLUMNS = ["source", "schema_name", "table_name", "column_name", "min", "max", "count"]


def profile_columns(
    df: DataFrame,
    source: str,
    schema_name: str,
    table_name: str,
    columns: Sequence[str] | None = None,
    approximate: bool = False,
    text_limit: int | None = TEXT_LIMIT,
) -> DataFrame:
    """One row per column: smallest and largest value as text, and the distinct count.

    Nulls are not counted.  Each column is read on its own and reduced to its distinct
    values, first inside each task and then across tasks; minimum, maximum and count follow
    from those.  A value that fills a third of the column so travels once per task, and no
    row is multiplied by the number of columns as it is with several distinct counts in one
    aggregate.  ``approximate`` counts with a sketch instead, all columns in one pass.  Give a stored
    table: a view, query or text file is read once for each column, so write it first.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = list(columns) if columns is not None else df.columns
    if approximate:
        values = df.select(*[_comparable(n, kinds[n]).alias(n) for n in names])
        rows = values.agg(*[_summary(n, n, F.approx_count_distinct, text_limit).alias(f"p{i}") for i, n in enumerate(names)])
        profile = rows.select(F.inline(F.array(*rows.columns)))
    else:
        profile = reduce(
            DataFrame.unionByName,
            [
                df.select(_comparable(n, kinds[n]).alias("value")).distinct().agg(_summary("value", n, F.count, text_limit).alias("p"))
                for n in names
            ],
        ).select("p.*")
    return _labelled(profile, source, schema_name, table_name)


def profile_from_summary(
    summary: DataFrame, columns: Sequence[str], source: str, schema_name: str, table_name: str
) -> DataFrame:
    """The profile of a table whose database has aggregated it to one row already.

    ``summary`` holds ``lo0, hi0, n0, lo1, ...`` in the order of ``columns``.  The text is
    made here, so that it looks the same as for a table profiled by Spark.
    """
    parts = [
        F.struct(
            F.lit(name).alias("column_name"),
            _text(F.col(f"lo{i}")).alias("min"),
            _text(F.col(f"hi{i}")).alias("max"),
            F.col(f"n{i}").cast("long").alias("count"),
        )
        for i, name in enumerate(columns)
    ]
    return _labelled(summary.select(F.inline(F.array(*parts))), source, schema_name, table_name)


def reconcile(source: DataFrame, target: DataFrame, request_id: int) -> DataFrame:
    """Profiles of source and target, one after the other, tagged with the request."""
    return source.select(*AUDIT_COLUMNS).union(target.select(*AUDIT_COLUMNS)).withColumn(
        "request_id", F.lit(request_id)
    )


def audit_differences(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source and target profiles side by side per column, with a ``matches`` flag.

    A column only one side has shows nulls for the other and does not match.  Texts match as
    far as the profiles kept them; ``profile_columns`` with ``text_limit=None`` keeps them whole.
    """

    def side(profile: DataFrame, name: str) -> DataFrame:
        return profile.select(
            "column_name", *[F.col(c).alias(f"{name}_{c}") for c in ("min", "max", "count")]
        )

    same = F.lit(True)
    for c in ("min", "max", "count"):
        same = same & F.col(f"source_{c}").eqNullSafe(F.col(f"target_{c}"))
    return side(source, "source").join(side(target, "target"), "column_name", "full").withColumn("matches", same)


# Buckets whose checksums are compared before any row is.
AUDIT_BUCKETS = 4096


def bucket_checksums(df: DataFrame, key: str | Sequence[str], buckets: int = AUDIT_BUCKETS) -> DataFrame:
    """One row a bucket of the key: ``bucket``, ``n``, and two checksums of its rows that no order changes.

    Tasks add up their own rows first, so what moves is a row for each bucket and task.
    """
    return _checked(_hashed(df, _keys(key), buckets), ["bucket"])


def reconcile_rows(source: DataFrame, target: DataFrame, key: str | Sequence[str], buckets: int = AUDIT_BUCKETS) -> DataFrame:
    """The keys whose rows differ between source and target, with ``change``: ``missing``, ``extra`` or ``changed``.

    Both sides are summed up by buckets of the key; only rows of buckets whose sums differ are looked at by key, and
    what meets there is a row for each of their keys.  Columns are compared by name; values of different
    types as text.  A column that one side lacks is null there.  Rows without a key stand for the null key together.
    Repeated rows count: a key that has them in other numbers has changed.
    """
    keys = _keys(key)
    source, target = _comparable_sides(source, target, keys)
    hashed = [_hashed(df, keys, buckets) for df in (source, target)]
    sums = [_checked(h, ["bucket"]) for h in hashed]
    # At most one row for each bucket.
    differ = F.broadcast(_differing(*sums, ["bucket"]).select("bucket"))
    by_key = [_checked(h.join(differ, "bucket", "left_semi"), keys) for h in hashed]
    found = _differing(*by_key, keys)
    change = F.when(F.col("target_n").isNull(), "missing").when(F.col("source_n").isNull(), "extra").otherwise("changed")
    return found.select(*map(_quoted, keys), change.alias("change"))


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _comparable_sides(source: DataFrame, target: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with the same columns in one order, of the same types."""
    kinds = [{f.name.lower(): f.dataType for f in df.schema.fields} for df in (source, target)]
    names = sorted(kinds[0] | kinds[1])
    sides = []
    for df, own, other in ((source, *kinds), (target, *kinds[::-1])):
        picked = []
        for name in names:
            kind = own.get(name, other.get(name))
            value = F.lit(None).cast(kind) if name not in own else F.col(_quoted(name))
            if name in own and name in other and own[name] != other[name]:
                whole = [isinstance(k, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) for k in (own[name], other[name])]
                value = value.cast("long") if all(whole) else value.cast("string")
            picked.append(value.alias(name))
        sides.append(df.select(*picked))
    return sides[0].withColumnsRenamed({k.lower(): k for k in keys}), sides[1].withColumnsRenamed({k.lower(): k for k in keys})


def _hashed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    row, named = row_hash(df), [F.col(_quoted(k)) for k in keys]
    chance = F.xxhash64(*named)
    return df.select(*named, F.pmod(chance, F.lit(buckets)).alias("bucket"), row.alias("__row"), F.xxhash64(row, F.lit(2)).alias("__again"))


def _checked(hashed: DataFrame, by: list[str]) -> DataFrame:
    low = F.col("__again").bitwiseAND(F.lit((1 << 40) - 1)).cast("decimal(20,0)")
    sums = (F.count(F.lit(1)).alias("n"), F.bit_xor("__row").alias("mixed"), F.sum(low).alias("total"))
    return hashed.groupBy(*map(_quoted, by)).agg(*sums)


def _differing(source: DataFrame, target: DataFrame, by: list[str]) -> DataFrame:
    """Rows of sums that are not the same on both sides, null keys meeting each other."""
    a, b = source.alias("a"), target.alias("b")
    same_key, same = F.lit(True), F.lit(True)
    for k in by:
        same_key = same_key & F.col(f"a.{_quoted(k)}").eqNullSafe(F.col(f"b.{_quoted(k)}"))
    for c in ("n", "mixed", "total"):
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    joined = a.join(b, same_key, "full").where(~same)
    named = [F.coalesce(F.col(f"a.{_quoted(k)}"), F.col(f"b.{_quoted(k)}")).alias(k) for k in by]
    return joined.select(*named, F.col("a.n").alias("source_n"), F.col("b.n").alias("target_n"))


def _labelled(profile: DataFrame, source: str, schema_name: str, table_name: str) -> DataFrame:
    return profile.select(
        F.lit(source).alias("source"),
        F.lit(schema_name).alias("schema_name"),
        F.lit(table_name).alias("table_name"),
        "column_name",
        "min",
        "max",
        "count",
    )


def _summary(value: str, name: str, count: Callable[[Column], Column], limit: int | None) -> Column:
    value = F.col(_quoted(value))
    return F.struct(
        F.lit(name).alias("column_name"),
        _text(F.min(value), limit).alias("min"),
        _text(F.max(value), limit).alias("max"),
        count(value).alias("count"),
    )


def _text(extreme: Column, limit: int | None = TEXT_LIMIT) -> Column:
    text = extreme.cast("string")
    return text if limit is None else F.substring(text, 1, limit)


def _comparable(name: str, kind: T.DataType) -> Column:
    # Maps have no order, so their text stands in for them.
    return F.to_json(_quoted(name)) if isinstance(kind, T.MapType) else F.col(_quoted(name))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
