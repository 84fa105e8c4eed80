"""Sources: Parquet/text/CSV readers and the derived test-fixture views."""

from clickflow.sources.tables import (
    read_events, read_finished_ids, read_ip_ranges, read_json_events, read_pages, read_parts, read_table,
    RAW_DATA_SCHEMA, IP_RANGES_SCHEMA,
)

__all__ = [
    "read_events", "read_finished_ids", "read_ip_ranges", "read_json_events", "read_pages", "read_parts",
    "read_table", "RAW_DATA_SCHEMA", "IP_RANGES_SCHEMA",
]
