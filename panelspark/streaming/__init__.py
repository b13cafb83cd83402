"""Structured Streaming forms of the ingest and aggregation jobs."""
