"""Resolving a fact table against required and optional lookup tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from datamove.operators.incremental import row_hash, zero


@dataclass(frozen=True)
class Lookup:
    """One role a lookup table plays for a fact table.

    ``on`` maps fact columns to lookup columns, ``columns`` maps output names to lookup
    columns.  A required lookup drops facts without a match; an optional one keeps them and
    gives the values in ``defaults`` (null where none is named).  ``only_if`` maps an output
    name to a boolean lookup column: the value shows only where that flag is true.
    """

    frame: DataFrame
    on: Mapping[str, str]
    columns: Mapping[str, str]
    required: bool = True
    defaults: Mapping[str, Any] = field(default_factory=dict)
    only_if: Mapping[str, str] = field(default_factory=dict)


def resolve_lookups(
    fact: DataFrame,
    lookups: Iterable[Lookup],
    valid: Column | None = None,
    order_by: Iterable[str] = (),
) -> DataFrame:
    """Join ``fact`` with every lookup in turn; the same table may appear in several roles.

    ``valid`` filters the fact rows before the joins.  Each lookup is cut to the columns it
    contributes and its columns are renamed per role, so nothing is ambiguous, and a later
    lookup may join on what an earlier one added.  No side is forced to be broadcast: the
    optimizer does that below its size threshold and otherwise shuffles on the key,
    splitting hot keys at run time.  Facts without a key of an optional lookup match nothing and are
    dealt out over all tasks by a hash of the row instead of meeting in one.
    """
    resolved = fact if valid is None else fact.where(valid)
    for role, lookup in enumerate(lookups):
        resolved = _join(resolved, lookup, f"__r{role}_")
    order_by = list(order_by)
    return resolved.orderBy(*order_by) if order_by else resolved


def _join(fact: DataFrame, lookup: Lookup, prefix: str) -> DataFrame:
    frame, matched = lookup.frame, f"{prefix}matched"
    keys = [frame[there].alias(f"{prefix}k{i}") for i, there in enumerate(lookup.on.values())]
    values = []
    for out, source in lookup.columns.items():
        value = frame[source]
        if out in lookup.only_if:
            value = F.when(frame[lookup.only_if[out]], value)
        values.append(value.alias(f"{prefix}v_{out}"))
    side = frame.select(*keys, *values)
    columns = fact.columns
    condition = F.lit(True)
    for i, here in enumerate(lookup.on):
        condition = condition & (F.col(here) == F.col(f"{prefix}k{i}"))
    if not lookup.required:
        side = side.withColumn(matched, F.lit(True)).withColumn(f"{prefix}there", zero(*[F.col(f"{prefix}k{i}") for i in range(len(keys))]).cast("long"))
        missing = F.lit(False)
        for here in lookup.on:
            missing = missing | F.col(here).isNull()
        if any(fact.select(here).schema[0].nullable for here in lookup.on):
            fact = fact.withColumn(f"{prefix}here", F.when(missing, row_hash(fact)).otherwise(F.lit(0).cast("long")))
            condition = condition & (F.col(f"{prefix}here") == F.col(f"{prefix}there"))
    joined = fact.join(side, condition, "inner" if lookup.required else "left")

    def output(name: str) -> Column:
        value = F.col(f"{prefix}v_{name}")
        if not lookup.required and lookup.defaults.get(name) is not None:
            value = F.when(F.col(matched), value).otherwise(F.lit(lookup.defaults[name]))
        return value.alias(name)

    return joined.select(*columns, *[output(name) for name in lookup.columns])
