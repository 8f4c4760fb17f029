"""Scans (driver parquet tables, CSV files) and sinks (tables, JSON, models)."""
