"""Incremental ingest on Structured Streaming's file source."""

from tickweave.streaming.ingest import ingest_new

__all__ = ["ingest_new"]
