"""Recursive flattening of struct columns."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, functions as F, types as T


def flatten_structs(df: DataFrame) -> DataFrame:
    """Lift struct fields to the top level until no struct column is left.

    Plain columns (scalars, arrays, maps) come first, then the fields of each struct.
    The parent's name is dropped unless the bare field name would occur twice at that
    level; then every field of that name becomes ``parent_field``.  Works on the schema
    alone, so it costs one projection however deep the nesting is.
    """
    while any(isinstance(f.dataType, T.StructType) for f in df.schema.fields):
        plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.StructType)]
        lifted = [
            (f.name, child)
            for f in df.schema.fields
            if isinstance(f.dataType, T.StructType)
            for child in f.dataType.names
        ]
        uses = Counter(n.lower() for n in plain + [child for _, child in lifted])
        names = [c if uses[c.lower()] == 1 else f"{parent}_{c}" for parent, c in lifted]
        clash = [n for n, k in Counter(n.lower() for n in plain + names).items() if k > 1]
        if clash:
            raise ValueError(f"flattened column names are not unique: {sorted(clash)}")
        df = df.select(
            *[F.col(_quoted(n)) for n in plain],
            *[
                F.col(f"{_quoted(parent)}.{_quoted(child)}").alias(name)
                for (parent, child), name in zip(lifted, names)
            ],
        )
    return df


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
