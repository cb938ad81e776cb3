"""Incremental ingestion as a Structured Streaming job."""

from homelake.streaming.incremental import new_records_query, read_new_records

__all__ = ["new_records_query", "read_new_records"]
