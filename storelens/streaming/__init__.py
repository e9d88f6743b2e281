"""Continuous ingest on Structured Streaming."""
