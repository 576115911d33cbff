"""Structured Streaming ingestion of landed pages."""

from statlake.streaming.ingest import ingest_batch, land_pages, start_ingest, write_epoch

__all__ = ["ingest_batch", "land_pages", "start_ingest", "write_epoch"]
