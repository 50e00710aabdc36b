"""Registry of named queries: each has a Spark builder ``(spark, sf_dir) ->
DataFrame`` and, where the result is expressible in SQL, an independent
DuckDB oracle string. ``__spark_entry__`` exposes both."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: register a query builder under ``name``."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from .queries import marts_q, star_q, reports_q, quality_q, scd2_q, stream_q, features_q, later_q  # noqa: F401
