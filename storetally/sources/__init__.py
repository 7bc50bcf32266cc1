"""Parquet sources with declared schemas."""
