"""Incremental file ingest and streaming tables."""
