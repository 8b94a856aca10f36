"""Structured Streaming: incremental file ingest into Bronze."""

from strata.streaming.ingest import ingest_increment

__all__ = ["ingest_increment"]
