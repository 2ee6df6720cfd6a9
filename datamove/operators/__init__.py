from datamove.operators.audit import (
    audit_differences,
    bucket_checksums,
    profile_columns,
    profile_from_summary,
    reconcile,
    reconcile_rows,
)
from datamove.operators.incremental import (
    align_schemas,
    changed_rows,
    column_diff,
    fits_broadcast,
    frequent_keys,
    high_watermark,
    key_bytes,
    latest_per_key,
    merge_upsert,
    touched_partitions,
    watermark_literal,
)
from datamove.operators.lookups import Lookup, resolve_lookups
from datamove.operators.sketches import profile_from_sketches, quantiles, sketch_columns, unite_sketches

__all__ = [
    "Lookup",
    "align_schemas",
    "audit_differences",
    "bucket_checksums",
    "changed_rows",
    "column_diff",
    "fits_broadcast",
    "frequent_keys",
    "high_watermark",
    "key_bytes",
    "latest_per_key",
    "merge_upsert",
    "profile_columns",
    "profile_from_sketches",
    "profile_from_summary",
    "quantiles",
    "reconcile",
    "reconcile_rows",
    "resolve_lookups",
    "sketch_columns",
    "touched_partitions",
    "unite_sketches",
    "watermark_literal",
]
