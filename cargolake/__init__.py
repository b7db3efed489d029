"""Spark-native logistics and retail warehouse: ingest, clean, conform, report."""
