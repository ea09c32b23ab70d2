"""Incremental ingestion of landed snapshots (Structured Streaming)."""

from .snapshots import landed_files, start_incremental_clean  # noqa: F401
