"""Bronze and silver layer queries: enriched bronze, partition report,
calendar, categories, products, users, fact, surrogate keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle
from ..operators.io import partition_stats
from ..operators.keys import continue_keys, dense_key
from ..registry import register
from .common import msum, no_audit, rnd, star

BRONZE_COLS = ["event_id", "event_time", "event_type", "product_id", "category_id", "category_code",
               "brand", "price", "user_id", "user_session", "source_file", "event_date"]


@register("bronze_enriched", oracle.with_star(
    "SELECT event_id, event_time, event_type, product_id, category_id, category_code, brand, price, "
    "user_id, user_session, 'events.parquet' AS source_file, event_date FROM bronze"))
def q_bronze_enriched(spark, sf_dir):
    return star(spark, sf_dir).bronze.select(*BRONZE_COLS)


@register("bronze_partition_stats", oracle.with_star(f"""
SELECT COUNT(*) AS partitions, MIN(event_date) AS first_partition, MAX(event_date) AS last_partition,
       MIN(n) AS min_rows, MAX(n) AS max_rows, {rnd('AVG(n)')} AS avg_rows,
       CAST(SUM(n) AS BIGINT) AS total_rows
FROM (SELECT event_date, COUNT(*) AS n FROM bronze GROUP BY event_date)"""))
def q_bronze_partition_stats(spark, sf_dir):
    return partition_stats(star(spark, sf_dir).bronze, "event_date")


@register("dim_date", oracle.with_star("SELECT * FROM dim_date"))
def q_dim_date(spark, sf_dir):
    return star(spark, sf_dir).dates


@register("dim_categories", oracle.with_star("SELECT * FROM dim_categories"))
def q_dim_categories(spark, sf_dir):
    return no_audit(star(spark, sf_dir).categories)


@register("dim_products_initial", oracle.with_star("SELECT * FROM dim_products"))
def q_dim_products(spark, sf_dir):
    return no_audit(star(spark, sf_dir).products)


@register("dim_users_initial", oracle.with_star("SELECT * FROM dim_users"))
def q_dim_users(spark, sf_dir):
    return no_audit(star(spark, sf_dir).users)


@register("fact_events", oracle.with_star("SELECT * FROM fact"))
def q_fact_events(spark, sf_dir):
    return no_audit(star(spark, sf_dir).fact)


@register("surrogate_keys", oracle.with_star("""
SELECT product_id, event_date,
       row_number() OVER (ORDER BY product_id, event_date) AS dense_sk,
       (SELECT MAX(product_sk) FROM dim_products)
         + row_number() OVER (ORDER BY product_id, event_date) AS continued_sk
FROM (SELECT DISTINCT product_id, event_date FROM bronze)"""))
def q_surrogate_keys(spark, sf_dir):
    """Dense keys over (product, day) pairs, and the same rows numbered after
    the current product key maximum (continuation of an existing key)."""
    s = star(spark, sf_dir)
    pairs = s.bronze.select("product_id", "event_date").distinct()
    dense = dense_key(pairs, ["product_id", "event_date"], "dense_sk")
    cont = continue_keys(s.products, dense, ["product_id", "event_date"], "continued_sk", "product_sk")
    return cont.select("product_id", "event_date", "dense_sk", "continued_sk")


@register("category_depth_distribution", oracle.with_star(
    "SELECT category_depth, COUNT(*) AS categories FROM dim_categories GROUP BY category_depth"))
def q_category_depth(spark, sf_dir):
    return (star(spark, sf_dir).categories.groupBy("category_depth")
            .agg(F.count(F.lit(1)).alias("categories")))


@register("segment_breakdown", oracle.with_star(f"""
SELECT user_segment, COUNT(*) AS user_count, {rnd('AVG(total_events)')} AS avg_events,
       {rnd('AVG(purchase_count)')} AS avg_purchases
FROM dim_users GROUP BY user_segment"""))
def q_segment_breakdown(spark, sf_dir):
    from ..functions.columns import round_half_up
    return (star(spark, sf_dir).users.groupBy("user_segment").agg(
        F.count(F.lit(1)).alias("user_count"),
        round_half_up(F.avg("total_events")).alias("avg_events"),
        round_half_up(F.avg("purchase_count")).alias("avg_purchases")))


@register("fact_revenue_by_type", oracle.with_star(f"""
SELECT event_type, COUNT(*) AS event_count, {msum('revenue')} AS total_revenue
FROM fact GROUP BY event_type"""))
def q_fact_revenue_by_type(spark, sf_dir):
    from ..functions.columns import money_sum
    return (star(spark, sf_dir).fact.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        money_sum("revenue").alias("total_revenue")))


@register("scd2_version_summary", oracle.with_star("""
SELECT 'products' AS dimension, COUNT(*) AS total_rows,
       COUNT(*) FILTER (WHERE is_current_version) AS current_versions,
       COUNT(*) FILTER (WHERE NOT is_current_version) AS historical_versions FROM dim_products
UNION ALL
SELECT 'users', COUNT(*), COUNT(*) FILTER (WHERE is_current_version),
       COUNT(*) FILTER (WHERE NOT is_current_version) FROM dim_users"""))
def q_scd2_version_summary(spark, sf_dir):
    from ..operators.quality import version_summary
    s = star(spark, sf_dir)
    return version_summary(s.products, "products").unionByName(version_summary(s.users, "users"))

