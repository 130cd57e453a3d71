"""Structured Streaming jobs."""

from ledgerloom.streaming.ingest import ingest_stream
from ledgerloom.streaming.upsert import compact_state, read_state, remove_folded, upsert_stream

__all__ = ["compact_state", "ingest_stream", "read_state", "remove_folded", "upsert_stream"]
