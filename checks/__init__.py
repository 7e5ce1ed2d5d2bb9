"""Comparison of the query catalog with DuckDB on the same tables."""
