"""Parquet and JSON sinks."""
