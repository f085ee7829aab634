"""Structured Streaming variants of ingest and dedup."""
