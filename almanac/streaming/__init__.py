"""Structured Streaming entry points (request log, incremental ingest)."""
