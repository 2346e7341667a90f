"""Incremental feed ingestion with Structured Streaming."""

from .ingest import feed_stream, normalize_stream

__all__ = ["feed_stream", "normalize_stream"]
