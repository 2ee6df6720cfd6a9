from datamove.sinks.publish import (
    JdbcWarehouse,
    active_copy,
    next_copy,
    publish_ab,
    publish_warehouse,
    view_property,
)
from datamove.sinks.tables import (
    ensure_database,
    merge_into_partitions,
    plan_output_files,
    snapshot_copy,
    write_table,
)
from datamove.sinks.transform import run_transform
from datamove.sinks.versions import Slices, current_version, merge_version, publish_version, roll_back

__all__ = [
    "JdbcWarehouse",
    "Slices",
    "active_copy",
    "current_version",
    "ensure_database",
    "merge_into_partitions",
    "merge_version",
    "next_copy",
    "plan_output_files",
    "publish_ab",
    "publish_version",
    "publish_warehouse",
    "roll_back",
    "run_transform",
    "snapshot_copy",
    "view_property",
    "write_table",
]
