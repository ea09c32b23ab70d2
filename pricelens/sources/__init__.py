"""Scans, sinks, mart fan-out and landing helpers."""

from .files import (  # noqa: F401
    FORMATS,
    check_format,
    export_csv,
    load_all_marts,
    load_mart,
    read_table,
    scan_csv,
    scan_json,
    scan_jsonl,
    scan_parquet,
    scan_snapshots,
    write_marts,
    write_table,
)
from .landing import ingest_audit, landing_enrich, write_json_array  # noqa: F401
