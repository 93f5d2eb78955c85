"""Micro-batch incremental loading of newly arriving raw files."""

from salesmart.streaming.ingest import raw_stream, start_ingest

__all__ = ["raw_stream", "start_ingest"]
