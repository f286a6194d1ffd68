"""Readers: raw NDJSON files, the driver's tables, load audit."""

from clickmart.sources.driver_tables import raw_from_tables, raw_json_lines, write_json_lines
from clickmart.sources.raw import (
    empty_raw,
    file_path_column,
    list_files,
    listing_audit,
    load_audit,
    read_raw,
)

__all__ = [
    "raw_from_tables", "raw_json_lines", "write_json_lines",
    "empty_raw", "file_path_column", "list_files", "listing_audit", "load_audit", "read_raw",
]
