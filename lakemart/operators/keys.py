"""Surrogate-key strategies.

* ``dense_key``      1..N in business-key order (exact ``row_number``),
                     computed without a single-partition window.
* ``hash_key``       xxhash64(business key, version): no ordering, no
                     shuffle, stable across reruns.
* ``monotonic_key``  ``monotonically_increasing_id``: unique, not dense,
                     depends on partitioning.
* ``uuid_key``       random UUID string per row.
* ``continue_keys``  new rows numbered after the current maximum key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .windows import row_index


def dense_key(df: DataFrame, order, name: str) -> DataFrame:
    return row_index(df, order, name)


def hash_key(df: DataFrame, cols: list[str], name: str) -> DataFrame:
    return df.withColumn(name, F.xxhash64(*[F.col(c) for c in cols]))


def monotonic_key(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.monotonically_increasing_id())


def uuid_key(df: DataFrame, name: str) -> DataFrame:
    """Random UUID per row. A re-run task draws new values, so write the
    keyed table (or checkpoint it) before joining or reusing it; prefer
    ``hash_key`` when keys must be reproducible."""
    return df.withColumn(name, F.expr("uuid()"))


def continue_keys(existing: DataFrame, new_rows: DataFrame, order, name: str,
                  existing_key: str | None = None) -> DataFrame:
    """Number ``new_rows`` max(existing key)+1, +2, ... in ``order``; the
    maximum is a scalar subquery (no driver collect, no join)."""
    start = existing.select(F.coalesce(F.max(existing_key or name), F.lit(0)).cast("long")).scalar()
    indexed = row_index(new_rows, order, "_ck_rn")
    return indexed.withColumn(name, F.col("_ck_rn") + start).drop("_ck_rn")
