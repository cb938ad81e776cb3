"""Readers and writers: run-stamped JSON lines, Parquet tables, catalog tables and pages with embedded JSON."""

from homelake.sources.embedded import drop_keys, extract_embedded_json, unreadable_pages
from homelake.sources.keys import add_keys, compact_keys, known_keys, stored_keys
from homelake.sources.readers import (
    history_ids,
    load_fixture,
    read_entity,
    read_table,
    read_tables,
    run_glob,
    with_run_id,
)
from homelake.sources.seen import add_seen, seen_ids
from homelake.sources.writers import append_run, spread_order, write_table

__all__ = [
    "add_keys", "add_seen", "append_run", "compact_keys", "drop_keys", "extract_embedded_json", "history_ids", "known_keys", "load_fixture", "read_entity",
    "read_table", "read_tables", "run_glob", "seen_ids", "spread_order", "stored_keys", "unreadable_pages", "with_run_id", "write_table",
]
