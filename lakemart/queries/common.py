"""Shared pieces of the registered queries: the star over the given tables
(with segment thresholds suited to the test data) and SQL snippets for the
oracle strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..oracle import ENGAGED, POWER, mavg, msum, rnd  # noqa: F401
from ..plans.star import Star, star_from_tables
from ..session import configure


def star(spark: SparkSession, sf_dir: str) -> Star:
    configure(spark)
    return star_from_tables(spark, sf_dir, POWER, ENGAGED)


def no_audit(df: DataFrame) -> DataFrame:
    """Drop load-time audit columns (not comparable across engines)."""
    return df.drop(*[c for c in ("created_at", "updated_at", "ingestion_timestamp") if c in df.columns])


# --- SQL snippets for the oracle strings ---------------------------------

def cnt(t: str, col: str = "event_type", alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return f"CAST(SUM(CASE WHEN {p}{col} = '{t}' THEN 1 ELSE 0 END) AS BIGINT)"


def users(t: str, user: str = "user_sk", alias: str = "f") -> str:
    return f"COUNT(DISTINCT CASE WHEN {alias}.event_type = '{t}' THEN {alias}.{user} END)"


def rate(a: str, b: str, scale: str = "100.0", digits: int = 2) -> str:
    return f"CAST(ROUND(CAST(CAST({a} AS DOUBLE) * {scale} / NULLIF(CAST({b} AS DOUBLE), 0) AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def rev(alias: str = "f") -> str:
    return msum(f"CASE WHEN {alias}.event_type = 'purchase' THEN {alias}.revenue ELSE 0 END")


def aov(alias: str = "f") -> str:
    return mavg(f"CASE WHEN {alias}.event_type = 'purchase' THEN {alias}.revenue END")


def qty(alias: str = "f") -> str:
    return f"CAST(SUM(CASE WHEN {alias}.event_type = 'purchase' THEN {alias}.quantity ELSE 0 END) AS BIGINT)"


def type_counts(alias: str = "f") -> str:
    return f"""COUNT(*) AS total_events,
    {cnt('view', alias=alias)} AS total_views,
    {cnt('cart', alias=alias)} AS total_carts,
    {cnt('remove_from_cart', alias=alias)} AS total_removes,
    {cnt('purchase', alias=alias)} AS total_purchases"""


RATES = f"""{rate('total_carts', 'total_views')} AS view_to_cart_rate,
    {rate('total_purchases', 'total_carts')} AS cart_to_purchase_rate,
    {rate('total_purchases', 'total_views')} AS view_to_purchase_rate,
    {rate('total_revenue', 'total_views', '1.0')} AS revenue_per_view"""

USER_DISTINCTS = f"""COUNT(DISTINCT f.user_sk) AS unique_users_interacted,
    {users('view')} AS unique_viewers,
    {users('cart')} AS unique_carts,
    {users('purchase')} AS unique_purchasers"""

TIMING = """MIN(f.event_time) AS first_event_date,
    MAX(f.event_time) AS last_event_date,
    COUNT(DISTINCT f.date_sk) AS days_active"""
