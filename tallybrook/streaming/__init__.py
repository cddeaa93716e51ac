"""Structured Streaming forms of ingest and load."""
