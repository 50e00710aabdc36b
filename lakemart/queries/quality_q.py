"""Data-quality queries: mart row counts, null checks, range checks,
mart-vs-fact reconciliation, foreign-key resolution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import count_of, money_sum, total_sum
from ..operators import quality as Q
from ..plans import marts
from ..registry import register
from .common import cnt, msum, rnd, star
from .marts_q import MART_CTES, SESSION_SQL, cohort_ctes, mart_sql, session_ctes


BUILDERS = {
    "gold_daily_metrics": lambda s: marts.gold_daily(s.fact, s.dates, s.users),
    "gold_user_metrics": lambda s: marts.gold_user(s.fact, s.users),
    "gold_product_performance": lambda s: marts.gold_product(s.fact, s.products, s.categories),
    "gold_category_performance": lambda s: marts.gold_category(s.fact, s.categories),
    "gold_brand_performance": lambda s: marts.gold_brand(s.fact, s.products, s.categories),
    "gold_funnel_metrics": lambda s: marts.gold_funnel(s.fact, s.products, s.categories, s.dates),
    "gold_session_metrics": lambda s: marts.gold_session(s.fact, s.dates),
    "gold_cohort_analysis": lambda s: marts.gold_cohort(s.fact),
}


def _marts(spark, sf, names=tuple(BUILDERS)) -> dict[str, DataFrame]:
    s = star(spark, sf)
    return {n: BUILDERS[n](s) for n in names}


def _mart(spark, sf, name: str) -> DataFrame:
    return _marts(spark, sf, [name])[name]


ALL_MART_CTES = (MART_CTES + ",\n" + session_ctes(1800) + f",\ngold_session AS ({SESSION_SQL})," + cohort_ctes())
SQL_NAMES = {"gold_daily_metrics": "gold_daily", "gold_user_metrics": "gold_user",
             "gold_product_performance": "gold_product", "gold_category_performance": "gold_category",
             "gold_brand_performance": "gold_brand", "gold_funnel_metrics": "gold_funnel",
             "gold_session_metrics": "gold_session", "gold_cohort_analysis": "gold_cohort"}


def all_marts_sql(body: str) -> str:
    from .. import oracle
    return oracle.with_star(body, ALL_MART_CTES)


@register("mart_row_counts", all_marts_sql("\nUNION ALL\n".join(
    f"SELECT '{k}' AS table_name, COUNT(*) AS row_count FROM {v}" for k, v in SQL_NAMES.items())))
def q_mart_row_counts(spark, sf):
    return Q.row_counts(_marts(spark, sf))


NULL_COLS = {
    "gold_daily_metrics": ["daily_active_users", "total_revenue", "avg_order_value", "view_to_cart_rate", "overall_conversion_rate"],
    "gold_user_metrics": ["lifetime_revenue", "recency_days", "first_event_date"],
    "gold_product_performance": ["total_revenue", "view_to_purchase_rate", "brand"],
    "gold_category_performance": ["total_revenue", "category_l1"],
    "gold_brand_performance": ["total_revenue", "brand"],
}


@register("mart_null_checks", all_marts_sql("\nUNION ALL\n".join(
    f"SELECT '{m}' AS table_name, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"{rnd(f'COUNT(*) FILTER (WHERE {c} IS NULL) * 100.0 / COUNT(*)')} AS null_pct FROM {SQL_NAMES[m]}"
    for m, cols in NULL_COLS.items() for c in cols)))
def q_mart_null_checks(spark, sf):
    ms = _marts(spark, sf, NULL_COLS)
    parts = [Q.null_profile(ms[m], cols).select(F.lit(m).alias("table_name"), "*")
             for m, cols in NULL_COLS.items()]
    return reduce(DataFrame.unionByName, parts)


RANGE_COLS = {
    "gold_daily_metrics": ["daily_active_users", "total_revenue", "overall_conversion_rate"],
    "gold_user_metrics": ["total_events", "lifetime_revenue", "days_active"],
    "gold_product_performance": ["total_views", "total_revenue", "view_to_purchase_rate"],
    "gold_category_performance": ["total_views", "total_revenue", "view_to_purchase_rate"],
    "gold_brand_performance": ["total_views", "revenue_market_share", "view_to_purchase_rate"],
}


@register("mart_range_checks", all_marts_sql("\nUNION ALL\n".join(
    f"SELECT '{m}' AS table_name, '{c}' AS column_name, MIN(CAST({c} AS DOUBLE)) AS min_value, "
    f"MAX(CAST({c} AS DOUBLE)) AS max_value, {rnd(f'AVG(CAST({c} AS DOUBLE))')} AS avg_value FROM {SQL_NAMES[m]}"
    for m, cols in RANGE_COLS.items() for c in cols)))
def q_mart_range_checks(spark, sf):
    ms = _marts(spark, sf, RANGE_COLS)
    return reduce(DataFrame.unionByName, [Q.range_profile(ms[m], cols).select(F.lit(m).alias("table_name"), "*") for m, cols in RANGE_COLS.items()])


@register("market_share_total", mart_sql(
    f"SELECT {msum('revenue_market_share')} AS total_market_share, COUNT(*) AS brands FROM gold_brand"))
def q_market_share_total(spark, sf):
    b = _mart(spark, sf, "gold_brand_performance")
    return b.agg(money_sum("revenue_market_share").alias("total_market_share"),
                 F.count(F.lit(1)).alias("brands"))


# --- reconciliation: mart totals vs fact totals (UNION ALL) ---------------

def _fact_totals(fact: DataFrame, distinct_col: str, distinct_name: str) -> DataFrame:
    return fact.agg(F.count_distinct(distinct_col).alias(distinct_name),
                    F.count(F.lit(1)).alias("total_events"),
                    count_of("view").alias("total_views"),
                    count_of("purchase").alias("total_purchases"),
                    money_sum("revenue").alias("total_revenue"))


def _mart_totals(mart: DataFrame, distinct_col: str, distinct_name: str,
                 revenue: str = "total_revenue") -> DataFrame:
    return mart.agg(F.count_distinct(distinct_col).alias(distinct_name),
                    F.sum("total_events").cast("long").alias("total_events"),
                    F.sum("total_views").cast("long").alias("total_views"),
                    F.sum("total_purchases").cast("long").alias("total_purchases"),
                    total_sum(revenue).alias("total_revenue"))


def _recon_sql(mart: str, key: str, name: str, fact_from: str, fact_key: str,
               revenue: str = "total_revenue") -> str:
    names = [name, "total_events", "total_views", "total_purchases", "total_revenue"]
    same = " AND ".join(f"MIN({c}) OVER () IS NOT DISTINCT FROM MAX({c}) OVER ()" for c in names)
    return f"""
SELECT *, {same} AS matches FROM (
SELECT 'Gold Table' AS source, COUNT(DISTINCT {key}) AS {name}, CAST(SUM(total_events) AS BIGINT) AS total_events,
       CAST(SUM(total_views) AS BIGINT) AS total_views, CAST(SUM(total_purchases) AS BIGINT) AS total_purchases, {msum(revenue)} AS total_revenue
FROM {mart}
UNION ALL
SELECT 'Fact Table', COUNT(DISTINCT {fact_key}), COUNT(*), {cnt('view', alias='f')}, {cnt('purchase', alias='f')},
       {msum('f.revenue')}
FROM {fact_from})"""


def _reconcile(mart: DataFrame, fact: DataFrame, mart_key: str, fact_key: str, name: str,
               revenue: str = "total_revenue") -> DataFrame:
    return Q.reconcile(_mart_totals(mart, mart_key, name, revenue), _fact_totals(fact, fact_key, name))


@register("reconcile_daily", all_marts_sql(
    _recon_sql("gold_daily", "date_key", "distinct_days", "fact f", "f.date_sk")))
def q_reconcile_daily(spark, sf):
    s = star(spark, sf)
    return _reconcile(_mart(spark, sf, "gold_daily_metrics"), s.fact, "date_key", "date_sk", "distinct_days")


@register("reconcile_user", all_marts_sql(_recon_sql(
    "gold_user", "user_sk", "distinct_users",
    "fact f JOIN dim_users u ON f.user_sk = u.user_sk WHERE u.is_current_version", "f.user_sk",
    "lifetime_revenue")))
def q_reconcile_user(spark, sf):
    s = star(spark, sf)
    f = s.fact.join(s.users.filter("is_current_version").select("user_sk"), "user_sk")
    return _reconcile(_mart(spark, sf, "gold_user_metrics"), f, "user_sk", "user_sk", "distinct_users",
                      "lifetime_revenue")


@register("reconcile_product", all_marts_sql(_recon_sql(
    "gold_product", "product_sk", "distinct_products",
    "fact f JOIN dim_products p ON f.product_sk = p.product_sk WHERE p.is_current_version", "f.product_sk")))
def q_reconcile_product(spark, sf):
    s = star(spark, sf)
    f = s.fact.join(s.products.filter("is_current_version").select("product_sk"), "product_sk")
    return _reconcile(_mart(spark, sf, "gold_product_performance"), f, "product_sk", "product_sk",
                      "distinct_products")


@register("reconcile_category", all_marts_sql(
    _recon_sql("gold_category", "category_sk", "distinct_categories", "fact f", "f.category_sk")))
def q_reconcile_category(spark, sf):
    s = star(spark, sf)
    return _reconcile(_mart(spark, sf, "gold_category_performance"), s.fact, "category_sk", "category_sk",
                      "distinct_categories")


@register("reconcile_brand", all_marts_sql(_recon_sql(
    "gold_brand", "brand", "distinct_brands",
    "fact f JOIN dim_products p ON f.product_sk = p.product_sk WHERE p.is_current_version", "p.brand")))
def q_reconcile_brand(spark, sf):
    s = star(spark, sf)
    f = s.fact.join(s.products.filter("is_current_version").select("product_sk", "brand"), "product_sk")
    return _reconcile(_mart(spark, sf, "gold_brand_performance"), f, "brand", "brand", "distinct_brands")


@register("fk_resolution", mart_sql("""
SELECT COUNT(*) AS total_events, COUNT(*) FILTER (WHERE date_sk <> -1) AS valid_date_sk,
       COUNT(*) FILTER (WHERE user_sk <> -1) AS valid_user_sk,
       COUNT(*) FILTER (WHERE product_sk <> -1) AS valid_product_sk,
       COUNT(*) FILTER (WHERE category_sk <> -1) AS valid_category_sk
FROM fact"""))
def q_fk_resolution(spark, sf):
    return Q.fk_resolution(star(spark, sf).fact, ["date_sk", "user_sk", "product_sk", "category_sk"])
