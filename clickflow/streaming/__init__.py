"""Structured Streaming: event-driven warehouse load of arriving Parquet parts."""

from clickflow.streaming.load import load_available, load_available_tables, start_part_load, stream_parts

__all__ = ["load_available", "load_available_tables", "start_part_load", "stream_parts"]
