"""Incremental form of the daily file ingest."""
