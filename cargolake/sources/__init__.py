"""Readers and writers: operational tables, expense sheets, telemetry logs, layer tables."""
