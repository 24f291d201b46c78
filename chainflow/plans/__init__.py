"""Registered queries: each key maps to a Spark job and its DuckDB oracle."""
