"""Recurring loads with Structured Streaming."""

from leadvault.streaming.loads import (
    corrections_stream, dedupe_stream, fold_upserts, ingest_stream, read_stream, read_upserts, upsert_stream, windowed_counts,
)

__all__ = ["corrections_stream", "dedupe_stream", "fold_upserts", "ingest_stream", "read_stream", "read_upserts", "upsert_stream",
           "windowed_counts"]
