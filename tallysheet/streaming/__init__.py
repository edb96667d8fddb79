"""Structured Streaming form of the incremental load."""

from tallysheet.streaming.incremental_load import compact, read_current, start_upsert_stream

__all__ = ["compact", "read_current", "start_upsert_stream"]
