"""Incremental ingestion."""

from townsquare.streaming.ingest import ingest_incremental, stream_table

__all__ = ["ingest_incremental", "stream_table"]
