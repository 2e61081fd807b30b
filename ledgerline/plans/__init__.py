"""Queries over the driver's tables, each with its SQL in DuckDB's dialect where SQL can say it."""
