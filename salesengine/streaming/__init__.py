"""Continuous ingest and refresh with Structured Streaming."""
