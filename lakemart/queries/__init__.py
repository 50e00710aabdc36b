"""Registered queries (Spark builder + DuckDB oracle), grouped by layer."""
