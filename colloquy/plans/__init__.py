"""Registered queries over the driver's test tables, each with a DuckDB oracle."""
