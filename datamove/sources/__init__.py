from datamove.sources.extract import (
    CatalogSource,
    JdbcSource,
    ParquetSource,
    extract_balanced,
    extract_keyrange,
    extract_query,
    extract_table,
    key_bounds,
    key_range,
    range_of,
)
from datamove.sources.files import FILE_TYPES, read_delimited, read_json_flat, select_files

__all__ = [
    "CatalogSource",
    "FILE_TYPES",
    "JdbcSource",
    "ParquetSource",
    "extract_balanced",
    "extract_keyrange",
    "extract_query",
    "extract_table",
    "key_bounds",
    "key_range",
    "range_of",
    "read_delimited",
    "read_json_flat",
    "select_files",
]
