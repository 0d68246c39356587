"""Incremental ingest and deduplication of a continuous feed."""
