"""Compositions of operators: ingest, transform and the full run."""
