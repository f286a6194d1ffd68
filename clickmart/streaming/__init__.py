"""Structured Streaming: exactly-once file ingest and raw -> bronze."""

from clickmart.streaming.ingest import ingest_files, raw_to_base, run_available_now, start_ingest

__all__ = ["ingest_files", "raw_to_base", "run_available_now", "start_ingest"]
