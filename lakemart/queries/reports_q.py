"""Report queries (exploration, star-schema samples, mart reads,
dashboard data) with their oracle SQL. Thresholds are scaled to the test
data (same numbers in both engines); see README."""

from __future__ import annotations

from .. import oracle
from ..plans import marts, reports as R
from ..registry import register
from ..sources.events import events_from_orders
from .common import cnt, mavg, msum, rate, rnd, star
from .marts_q import SESSION_SQL, cohort_ctes, mart_sql, session_ctes

DAY = "2024-01-15"
YEAR = 2024
PRODUCT_MIN_VIEWS, PRODUCT_MIN_RATE = 20, 3.0
CATEGORY_MIN_VIEWS, CATEGORY_MIN_RATE = 30, 1.0
BRAND_MIN_VIEWS, BRAND_MIN_RATE = 60, 1.5
FUNNEL_MIN_VIEWERS = 2
COHORT_SINCE = "1997-01-01"
COHORT_MONTHS = ["1995-01-01", "1995-06-01", "1996-01-01", "1997-01-01"]


def bronze_sql(body: str) -> str:
    return oracle.with_star(body)


# --- exploration -------------------------------------------------------------

@register("event_total_count", bronze_sql("SELECT COUNT(*) AS total_events FROM bronze"))
def q_event_total_count(spark, sf):
    return R.event_total_count(star(spark, sf).bronze)


@register("event_type_distribution", bronze_sql(f"""
SELECT event_type, event_count, {rnd('event_count * 100.0 / SUM(event_count) OVER ()')} AS percentage
FROM (SELECT event_type, COUNT(*) AS event_count FROM bronze GROUP BY event_type)"""))
def q_event_type_distribution(spark, sf):
    return R.event_type_distribution(star(spark, sf).bronze)


@register("bronze_day_breakdown", bronze_sql(f"""
SELECT event_date, event_type, COUNT(*) AS event_count FROM bronze
WHERE event_date = DATE '{DAY}' GROUP BY event_date, event_type"""))
def q_bronze_day_breakdown(spark, sf):
    return R.day_breakdown(star(spark, sf).bronze, DAY)


@register("events_per_day", bronze_sql(
    "SELECT CAST(event_time AS DATE) AS date, COUNT(*) AS events FROM bronze GROUP BY 1"))
def q_events_per_day(spark, sf):
    return R.events_per_day(star(spark, sf).bronze)


@register("time_range", bronze_sql("""
SELECT MIN(event_time) AS earliest_event, MAX(event_time) AS latest_event,
       CAST(floor((epoch_us(MAX(event_time)) - epoch_us(MIN(event_time))) / 86400000000.0) AS BIGINT)
         AS duration_days
FROM bronze"""))
def q_time_range(spark, sf):
    return R.time_range(star(spark, sf).bronze)


NULL_PROFILE_SQL = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"{rnd(f'COUNT(*) FILTER (WHERE {c} IS NULL) * 100.0 / COUNT(*)')} AS null_pct FROM bronze"
    for c in R.RAW_COLUMNS)


@register("null_profile", bronze_sql(NULL_PROFILE_SQL))
def q_null_profile(spark, sf):
    from ..operators.quality import null_profile
    return null_profile(star(spark, sf).bronze, R.RAW_COLUMNS)


@register("session_duplicate_ratio", bronze_sql(f"""
SELECT COUNT(DISTINCT user_session) AS unique_sessions, COUNT(*) AS total_rows,
       {rnd('(COUNT(*) - COUNT(DISTINCT user_session)) * 100.0 / COUNT(*)')} AS duplicate_ratio
FROM bronze"""))
def q_session_duplicate_ratio(spark, sf):
    return R.session_duplicate_ratio(star(spark, sf).bronze)


def _dn(c):
    return f"CAST(COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT)"


@register("cardinalities", bronze_sql(f"""
SELECT {_dn('product_id')} AS unique_products, {_dn('category_id')} AS unique_categories,
       {_dn('brand')} AS unique_brands, {_dn('user_id')} AS unique_users,
       {_dn('user_session')} AS unique_sessions FROM bronze"""))
def q_cardinalities(spark, sf):
    return R.cardinalities(star(spark, sf).bronze)


@register("top_categories", bronze_sql("""
SELECT category_code, COUNT(*) AS count FROM bronze WHERE category_code IS NOT NULL
GROUP BY category_code ORDER BY count DESC, category_code LIMIT 10"""))
def q_top_categories(spark, sf):
    return R.top_values(star(spark, sf).bronze, "category_code")


@register("top_brands", bronze_sql("""
SELECT brand, COUNT(*) AS count FROM bronze WHERE brand IS NOT NULL
GROUP BY brand ORDER BY count DESC, brand LIMIT 10"""))
def q_top_brands(spark, sf):
    return R.top_values(star(spark, sf).bronze, "brand")


@register("events_per_user_stats", bronze_sql(f"""
SELECT MIN(n) AS min_events, MAX(n) AS max_events, {rnd('AVG(n)')} AS avg_events,
       {rnd('quantile_cont(n, 0.5)', 6)} AS median_events
FROM (SELECT user_id, COUNT(*) AS n FROM bronze GROUP BY user_id)"""))
def q_events_per_user_stats(spark, sf):
    return R.events_per_user_stats(star(spark, sf).bronze)


@register("user_level_funnel", bronze_sql(f"""
SELECT *, {rate('users_carted', 'users_viewed')} AS cart_pct_of_viewers,
       {rate('users_purchased', 'users_viewed')} AS purchase_pct_of_viewers
FROM (SELECT COUNT(DISTINCT CASE WHEN event_type = 'view' THEN user_id END) AS users_viewed,
             COUNT(DISTINCT CASE WHEN event_type = 'cart' THEN user_id END) AS users_carted,
             COUNT(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS users_purchased
      FROM bronze)"""))
def q_user_level_funnel(spark, sf):
    return R.user_level_funnel(star(spark, sf).bronze)


@register("price_statistics", bronze_sql(f"""
SELECT MIN(price) AS min_price, MAX(price) AS max_price, {mavg('price', 6)} AS avg_price,
       {rnd('quantile_cont(price, 0.5)', 6)} AS median_price, {rnd('quantile_cont(price, 0.95)', 6)} AS p95_price
FROM bronze"""))
def q_price_statistics(spark, sf):
    return R.price_statistics(star(spark, sf).bronze)


@register("purchase_revenue_summary", bronze_sql(f"""
SELECT {msum('price')} AS total_revenue, COUNT(*) AS total_purchases,
       {mavg('price')} AS avg_order_value
FROM bronze WHERE event_type = 'purchase'"""))
def q_purchase_revenue_summary(spark, sf):
    return R.purchase_revenue_summary(star(spark, sf).bronze)


# --- star-schema sample queries ----------------------------------------------

@register("monthly_revenue_by_brand", bronze_sql(f"""
SELECT d.year, d.month_name, p.brand, {msum('f.revenue')} AS total_revenue, COUNT(*) AS purchases
FROM fact f JOIN dim_date d ON f.date_sk = d.date_key JOIN dim_products p ON f.product_sk = p.product_sk
WHERE f.event_type = 'purchase' AND d.year = {YEAR}
GROUP BY d.year, d.month_name, d.month, p.brand"""))
def q_monthly_revenue_by_brand(spark, sf):
    s = star(spark, sf)
    return R.monthly_revenue_by_brand(s.fact, s.dates, s.products, YEAR)


@register("monthly_buyers_by_brand", bronze_sql(f"""
SELECT d.year, d.month_name, p.brand, COUNT(DISTINCT f.user_sk) AS unique_buyers, {msum('f.revenue')} AS total_revenue,
       COUNT(*) AS total_purchases
FROM fact f JOIN dim_date d ON f.date_sk = d.date_key JOIN dim_products p ON f.product_sk = p.product_sk
WHERE f.event_type = 'purchase' AND d.year = {YEAR}
GROUP BY d.year, d.month_name, d.month, p.brand"""))
def q_monthly_buyers_by_brand(spark, sf):
    s = star(spark, sf)
    return R.monthly_buyers_by_brand(s.fact, s.dates, s.products, YEAR)


@register("segment_behavior", bronze_sql(f"""
SELECT u.user_segment, COUNT(DISTINCT f.user_sk) AS users_count, COUNT(*) AS total_events,
       {mavg('f.price_at_event')} AS avg_product_price, {cnt('purchase', alias='f')} AS purchases, {msum('f.revenue')} AS total_revenue
FROM fact f JOIN dim_users u ON f.user_sk = u.user_sk GROUP BY u.user_segment"""))
def q_segment_behavior(spark, sf):
    s = star(spark, sf)
    return R.segment_behavior(s.fact, s.users)


@register("category_by_weekday_all", bronze_sql(f"""
SELECT d.day_of_week, d.is_weekend, c.category_l1, COUNT(*) AS events, {cnt('purchase', alias='f')} AS purchases,
       {msum('f.revenue')} AS revenue
FROM fact f JOIN dim_date d ON f.date_sk = d.date_key JOIN dim_categories c ON f.category_sk = c.category_sk
WHERE c.category_l1 IS NOT NULL GROUP BY d.day_of_week, d.is_weekend, c.category_l1"""))
def q_category_by_weekday_all(spark, sf):
    s = star(spark, sf)
    return R.category_by_weekday_all(s.fact, s.dates, s.categories)


@register("user_segment_performance", bronze_sql(f"""
SELECT u.user_segment, COUNT(DISTINCT f.user_sk) AS unique_users, {cnt('purchase', alias='f')} AS purchases,
       {msum('f.revenue')} AS total_revenue
FROM fact f JOIN dim_users u ON f.user_sk = u.user_sk GROUP BY u.user_segment"""))
def q_user_segment_performance(spark, sf):
    s = star(spark, sf)
    return R.user_segment_performance(s.fact, s.users)


@register("category_by_weekday", bronze_sql(f"""
SELECT d.day_name, c.category_l1, COUNT(*) AS events, {cnt('purchase', alias='f')} AS purchases,
       {msum('f.revenue')} AS revenue
FROM fact f JOIN dim_date d ON f.date_sk = d.date_key JOIN dim_categories c ON f.category_sk = c.category_sk
WHERE f.event_type = 'purchase' GROUP BY d.day_name, c.category_l1"""))
def q_category_by_weekday(spark, sf):
    s = star(spark, sf)
    return R.category_by_weekday(s.fact, s.dates, s.categories)


@register("month_segment_revenue", bronze_sql(f"""
SELECT d.month_name, u.user_segment, {msum('f.revenue')} AS revenue
FROM fact f JOIN dim_date d ON f.date_sk = d.date_key JOIN dim_users u ON f.user_sk = u.user_sk
WHERE f.event_type = 'purchase' GROUP BY d.month_name, u.user_segment"""))
def q_month_segment_revenue(spark, sf):
    s = star(spark, sf)
    return R.month_segment_revenue(s.fact, s.dates, s.users)


# --- daily mart reads ----------------------------------------------------------

@register("revenue_trend", mart_sql(f"""
SELECT year, month_name, CAST(SUM(total_purchases) AS BIGINT) AS purchases,
       {msum('total_revenue')} AS revenue, {mavg('avg_order_value')} AS avg_aov,
       {rnd('AVG(overall_conversion_rate)')} AS avg_conversion
FROM gold_daily GROUP BY year, month, month_name"""))
def q_revenue_trend(spark, sf):
    s = star(spark, sf)
    return R.revenue_trend(marts.gold_daily(s.fact, s.dates, s.users))


@register("recent_daily_kpis", mart_sql("""
SELECT * FROM gold_daily WHERE full_date >= (SELECT MAX(full_date) FROM gold_daily) - INTERVAL 7 DAY"""))
def q_recent_daily_kpis(spark, sf):
    s = star(spark, sf)
    return R.recent_daily_kpis(marts.gold_daily(s.fact, s.dates, s.users).drop("created_at"))


@register("weekend_vs_weekday", mart_sql(f"""
SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type, COUNT(*) AS days,
       {rnd('AVG(daily_active_users)', 0)} AS avg_dau, {rnd('AVG(total_purchases)', 0)} AS avg_purchases,
       {mavg('total_revenue')} AS avg_revenue, {rnd('AVG(overall_conversion_rate)')} AS avg_conversion_rate
FROM gold_daily GROUP BY is_weekend"""))
def q_weekend_vs_weekday(spark, sf):
    s = star(spark, sf)
    return R.weekend_vs_weekday(marts.gold_daily(s.fact, s.dates, s.users))


# --- user mart reads -----------------------------------------------------------

@register("top_users_by_ltv", mart_sql("""
SELECT user_id, user_segment, total_events, total_purchases, lifetime_revenue, recency_days,
       frequency_purchases, days_active
FROM gold_user ORDER BY lifetime_revenue DESC, user_id LIMIT 20"""))
def q_top_users_by_ltv(spark, sf):
    s = star(spark, sf)
    return R.top_users_by_ltv(marts.gold_user(s.fact, s.users))


@register("user_segment_distribution", mart_sql(f"""
SELECT user_segment, COUNT(*) AS user_count, {rnd('AVG(total_purchases)')} AS avg_purchases,
       {mavg('lifetime_revenue')} AS avg_ltv, {rnd('AVG(days_active)')} AS avg_days_active,
       {rnd('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER ()')} AS pct_of_users
FROM gold_user GROUP BY user_segment"""))
def q_user_segment_distribution(spark, sf):
    s = star(spark, sf)
    return R.user_segment_distribution(marts.gold_user(s.fact, s.users))


@register("rfm_segments", mart_sql(f"""
SELECT CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_segment,
  COUNT(*) AS user_count, {rnd('AVG(recency_days)', 1)} AS avg_recency,
  {rnd('AVG(frequency_purchases)', 1)} AS avg_frequency, {mavg('lifetime_revenue')} AS avg_monetary
FROM scores WHERE r_score >= 4 AND f_score >= 4 AND m_score >= 4
GROUP BY 1 ORDER BY user_count DESC, rfm_segment LIMIT 10""", """scores AS (
  SELECT user_id, recency_days, frequency_purchases, lifetime_revenue,
    6 - NTILE(5) OVER (ORDER BY recency_days, user_id) AS r_score,
    NTILE(5) OVER (ORDER BY frequency_purchases, user_id) AS f_score,
    NTILE(5) OVER (ORDER BY lifetime_revenue, user_id) AS m_score
  FROM gold_user WHERE total_purchases > 0)"""))
def q_rfm_segments(spark, sf):
    s = star(spark, sf)
    return R.rfm_segments(marts.gold_user(s.fact, s.users))


@register("ltv_tiers", mart_sql(f"""
SELECT CASE WHEN lifetime_revenue = 0 THEN '0. Never Purchased'
            WHEN lifetime_revenue < 100 THEN '1. Low Value ($0-$100)'
            WHEN lifetime_revenue < 500 THEN '2. Medium Value ($100-$500)'
            WHEN lifetime_revenue < 1000 THEN '3. High Value ($500-$1K)'
            ELSE '4. VIP ($1K+)' END AS ltv_tier,
  COUNT(*) AS users, {rnd('AVG(total_purchases)', 1)} AS avg_purchases, {mavg('lifetime_revenue')} AS avg_ltv,
  {rnd('AVG(days_active)', 1)} AS avg_days_active, {rnd('AVG(personal_conversion_rate)')} AS avg_conversion_rate
FROM gold_user GROUP BY 1"""))
def q_ltv_tiers(spark, sf):
    s = star(spark, sf)
    return R.ltv_tiers(marts.gold_user(s.fact, s.users))


# --- product / category / brand mart reads ----------------------------------

@register("top_products", mart_sql("""
SELECT product_id, brand, category_l1, total_views, total_purchases, total_revenue,
       view_to_purchase_rate, rank_in_category_by_revenue
FROM gold_product ORDER BY total_revenue DESC, product_id LIMIT 20"""))
def q_top_products(spark, sf):
    s = star(spark, sf)
    return R.top_products(marts.gold_product(s.fact, s.products, s.categories))


@register("category_distribution", mart_sql(f"""
SELECT category_l1, COUNT(*) AS product_count, CAST(SUM(total_views) AS BIGINT) AS total_views,
       CAST(SUM(total_purchases) AS BIGINT) AS total_purchases, {msum('total_revenue')} AS total_revenue,
       {rnd('AVG(view_to_purchase_rate)')} AS avg_conversion
FROM gold_product GROUP BY category_l1"""))
def q_category_distribution(spark, sf):
    s = star(spark, sf)
    return R.category_distribution(marts.gold_product(s.fact, s.products, s.categories))


@register("top_products_by_category", mart_sql("""
SELECT * FROM (
  SELECT category_l1, product_id, brand, total_revenue, total_purchases, view_to_purchase_rate,
         CAST(ROW_NUMBER() OVER (PARTITION BY category_l1 ORDER BY total_revenue DESC, product_id) AS INTEGER) AS rn
  FROM gold_product WHERE total_revenue > 0) WHERE rn <= 5"""))
def q_top_products_by_category(spark, sf):
    s = star(spark, sf)
    return R.top_products_by_category(marts.gold_product(s.fact, s.products, s.categories))


@register("high_converting_products", mart_sql(f"""
SELECT product_id, brand, category_l1, total_views, total_purchases, view_to_purchase_rate, total_revenue,
       revenue_per_view
FROM gold_product WHERE total_views >= {PRODUCT_MIN_VIEWS} AND view_to_purchase_rate >= {PRODUCT_MIN_RATE}
ORDER BY revenue_per_view DESC, product_id LIMIT 20"""))
def q_high_converting_products(spark, sf):
    s = star(spark, sf)
    return R.high_converting_products(marts.gold_product(s.fact, s.products, s.categories),
                                      PRODUCT_MIN_VIEWS, PRODUCT_MIN_RATE)


@register("top_categories_by_revenue", mart_sql("""
SELECT category_l1, category_l2, category_l3, unique_products, total_views, total_purchases, total_revenue,
       view_to_purchase_rate, overall_rank_by_revenue
FROM gold_category ORDER BY total_revenue DESC, category_sk LIMIT 20"""))
def q_top_categories_by_revenue(spark, sf):
    s = star(spark, sf)
    return R.top_categories_by_revenue(marts.gold_category(s.fact, s.categories))


@register("category_l1_rollup", mart_sql(f"""
SELECT category_l1, COUNT(*) AS subcategory_count, CAST(SUM(unique_products) AS BIGINT) AS total_products,
       CAST(SUM(total_views) AS BIGINT) AS total_views, CAST(SUM(total_purchases) AS BIGINT) AS total_purchases,
       {msum('total_revenue')} AS total_revenue, {rnd('AVG(view_to_purchase_rate)')} AS avg_conversion
FROM gold_category GROUP BY category_l1"""))
def q_category_l1_rollup(spark, sf):
    s = star(spark, sf)
    return R.category_l1_rollup(marts.gold_category(s.fact, s.categories))


@register("category_rollup_levels", oracle.with_star(f"""
SELECT c.category_l1, c.category_l2, c.category_l3,
       CAST(GROUPING(c.category_l1, c.category_l2, c.category_l3) AS BIGINT) AS level,
       COUNT(*) AS total_events, {cnt('purchase', alias='f')} AS total_purchases,
       {msum('f.revenue')} AS total_revenue, COUNT(DISTINCT f.user_sk) AS unique_users
FROM fact f JOIN dim_categories c ON f.category_sk = c.category_sk
GROUP BY ROLLUP (c.category_l1, c.category_l2, c.category_l3)"""))
def q_category_rollup_levels(spark, sf):
    s = star(spark, sf)
    return R.category_rollup_levels(s.fact, s.categories)


@register("top_subcategories_by_l1", mart_sql("""
SELECT * FROM (
  SELECT category_l1, category_l2, category_l3, total_revenue, total_purchases, view_to_purchase_rate,
         CAST(ROW_NUMBER() OVER (PARTITION BY category_l1 ORDER BY total_revenue DESC, category_sk) AS INTEGER) AS rn
  FROM gold_category WHERE category_l2 IS NOT NULL) WHERE rn <= 3"""))
def q_top_subcategories_by_l1(spark, sf):
    s = star(spark, sf)
    return R.top_subcategories_by_l1(marts.gold_category(s.fact, s.categories))


@register("high_converting_categories", mart_sql(f"""
SELECT category_l1, category_l2, category_l3, total_views, total_purchases, view_to_purchase_rate,
       total_revenue, revenue_per_view
FROM gold_category WHERE total_views >= {CATEGORY_MIN_VIEWS} AND view_to_purchase_rate >= {CATEGORY_MIN_RATE}
ORDER BY view_to_purchase_rate DESC, category_sk LIMIT 20"""))
def q_high_converting_categories(spark, sf):
    s = star(spark, sf)
    return R.high_converting_categories(marts.gold_category(s.fact, s.categories),
                                        CATEGORY_MIN_VIEWS, CATEGORY_MIN_RATE)


@register("top_brands_by_revenue", mart_sql("""
SELECT brand, unique_products, categories_l1_count, total_views, total_purchases, total_revenue,
       view_to_purchase_rate, revenue_market_share, rank_by_revenue
FROM gold_brand ORDER BY total_revenue DESC, brand LIMIT 20"""))
def q_top_brands_by_revenue(spark, sf):
    s = star(spark, sf)
    return R.top_brands_by_revenue(marts.gold_brand(s.fact, s.products, s.categories))


@register("multi_category_brands", mart_sql("""
SELECT brand, categories_l1_count, unique_products, total_revenue, view_to_purchase_rate,
       revenue_market_share
FROM gold_brand WHERE categories_l1_count >= 2 ORDER BY total_revenue DESC, brand LIMIT 20"""))
def q_multi_category_brands(spark, sf):
    s = star(spark, sf)
    return R.multi_category_brands(marts.gold_brand(s.fact, s.products, s.categories))


@register("high_performing_brands", mart_sql(f"""
SELECT brand, unique_products, total_views, total_purchases, view_to_purchase_rate, total_revenue,
       revenue_per_view, revenue_market_share
FROM gold_brand WHERE total_views >= {BRAND_MIN_VIEWS} AND view_to_purchase_rate >= {BRAND_MIN_RATE}
ORDER BY revenue_per_view DESC, brand LIMIT 20"""))
def q_high_performing_brands(spark, sf):
    s = star(spark, sf)
    return R.high_performing_brands(marts.gold_brand(s.fact, s.products, s.categories),
                                    BRAND_MIN_VIEWS, BRAND_MIN_RATE)


# --- funnel / session / cohort mart reads -------------------------------------

@register("recent_funnel", mart_sql("""
SELECT full_date, category_l1, category_l2, users_viewed, users_carted, users_purchased,
       view_to_cart_user_rate, cart_to_purchase_user_rate, overall_conversion_user_rate,
       cart_abandonment_rate, total_revenue
FROM gold_funnel ORDER BY full_date DESC, total_revenue DESC, category_l1, category_l2 NULLS FIRST LIMIT 20"""))
def q_recent_funnel(spark, sf):
    s = star(spark, sf)
    return R.recent_funnel(marts.gold_funnel(s.fact, s.products, s.categories, s.dates))


@register("funnel_by_l1", mart_sql(f"""
SELECT category_l1, total_users_viewed, total_users_carted, total_users_purchased,
  {rate('total_users_carted', 'total_users_viewed')} AS avg_view_to_cart_rate,
  {rate('total_users_purchased', 'total_users_carted')} AS avg_cart_to_purchase_rate,
  {rate('total_users_purchased', 'total_users_viewed')} AS avg_overall_conversion, total_revenue
FROM (SELECT category_l1, CAST(SUM(users_viewed) AS BIGINT) AS total_users_viewed,
        CAST(SUM(users_carted) AS BIGINT) AS total_users_carted,
        CAST(SUM(users_purchased) AS BIGINT) AS total_users_purchased,
        {msum('total_revenue')} AS total_revenue
      FROM gold_funnel GROUP BY category_l1)"""))
def q_funnel_by_l1(spark, sf):
    s = star(spark, sf)
    return R.funnel_by_l1(marts.gold_funnel(s.fact, s.products, s.categories, s.dates))


@register("worst_funnels", mart_sql(f"""
SELECT full_date, category_l1, category_l2, users_viewed, users_carted, users_purchased,
       cart_abandonment_rate, purchase_abandonment_rate, overall_conversion_user_rate, total_revenue
FROM gold_funnel WHERE users_viewed >= {FUNNEL_MIN_VIEWERS}
ORDER BY cart_abandonment_rate DESC NULLS LAST, purchase_abandonment_rate DESC NULLS LAST, full_date,
         category_l1, category_l2 NULLS FIRST LIMIT 20"""))
def q_worst_funnels(spark, sf):
    s = star(spark, sf)
    return R.worst_funnels(marts.gold_funnel(s.fact, s.products, s.categories, s.dates), FUNNEL_MIN_VIEWERS)


SESSION_MART = f"gold_session AS ({SESSION_SQL})"


@register("recent_sessions", oracle.with_star("""
SELECT full_date, total_sessions, unique_users_with_sessions, avg_session_duration_minutes,
       avg_events_per_session, pct_sessions_with_cart, pct_sessions_with_purchase, total_session_revenue,
       avg_revenue_per_converting_session
FROM gold_session ORDER BY full_date DESC LIMIT 20""", session_ctes(1800) + ",\n" + SESSION_MART))
def q_recent_sessions(spark, sf):
    s = star(spark, sf)
    return R.recent_sessions(marts.gold_session(s.fact, s.dates))


@register("session_engagement_mix", oracle.with_star(f"""
SELECT full_date, total_sessions, single_event_sessions, low_engagement_sessions, medium_engagement_sessions,
       high_engagement_sessions, {rate('single_event_sessions', 'total_sessions')} AS pct_single_event,
       {rate('high_engagement_sessions', 'total_sessions')} AS pct_high_engagement
FROM gold_session ORDER BY full_date DESC LIMIT 20""", session_ctes(7200) + ",\n" + SESSION_MART))
def q_session_engagement_mix(spark, sf):
    s = star(spark, sf)
    return R.session_engagement_mix(marts.gold_session(s.fact, s.dates, 7200))


ORDER_EVENTS_CTE = """order_events AS (
  SELECT o.o_custkey AS user_id, CAST(o.o_orderdate AS TIMESTAMP) AS event_time, 'purchase' AS event_type,
         l.l_extendedprice * (1 - l.l_discount) AS revenue
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def cohort_orders_sql(body: str) -> str:
    return f"WITH {ORDER_EVENTS_CTE},{cohort_ctes('order_events', 'user_id')}\n{body}"


def _cohort_orders(spark, sf):
    from ..session import configure
    configure(spark)
    return marts.gold_cohort(events_from_orders(spark, sf), user="user_id").drop("created_at")


@register("gold_cohort_orders", cohort_orders_sql("SELECT * FROM gold_cohort"))
def q_gold_cohort_orders(spark, sf):
    """Cohort mart over the order star (7 years of monthly cohorts)."""
    return _cohort_orders(spark, sf)


@register("recent_cohorts", cohort_orders_sql(f"""
SELECT cohort_month, periods_since_cohort, activity_month, total_cohort_users, active_users, retention_rate,
       period_revenue, cumulative_revenue, ltv_to_date
FROM gold_cohort WHERE cohort_month >= TIMESTAMP '{COHORT_SINCE}'
ORDER BY cohort_month DESC, periods_since_cohort LIMIT 30"""))
def q_recent_cohorts(spark, sf):
    return R.recent_cohorts(_cohort_orders(spark, sf), COHORT_SINCE)


@register("retention_curve", cohort_orders_sql(f"""
SELECT cohort_month, periods_since_cohort, total_cohort_users, active_users, retention_rate,
       cumulative_revenue, ltv_to_date
FROM gold_cohort WHERE cohort_month IN ({", ".join(f"TIMESTAMP '{m}'" for m in COHORT_MONTHS)})
  AND periods_since_cohort <= 6"""))
def q_retention_curve(spark, sf):
    return R.retention_curve(_cohort_orders(spark, sf), COHORT_MONTHS)


@register("best_cohorts_m3", cohort_orders_sql("""
SELECT cohort_month, total_cohort_users, retention_rate AS month_3_retention, ltv_to_date AS month_3_ltv,
       cumulative_revenue AS total_revenue_month_3
FROM gold_cohort WHERE periods_since_cohort = 3 ORDER BY month_3_ltv DESC, cohort_month LIMIT 20"""))
def q_best_cohorts_m3(spark, sf):
    return R.best_cohorts(_cohort_orders(spark, sf))


# --- dashboard data ----------------------------------------------------------

@register("dash_daily_metrics", mart_sql("""
SELECT full_date, daily_active_users, total_events, total_purchases, CAST(total_revenue AS DOUBLE) AS total_revenue,
       CAST(avg_order_value AS DOUBLE) AS avg_order_value,
       CAST(overall_conversion_rate AS DOUBLE) AS overall_conversion_rate
FROM gold_daily ORDER BY full_date DESC LIMIT 30"""))
def q_dash_daily_metrics(spark, sf):
    s = star(spark, sf)
    return R.dash_daily_metrics(marts.gold_daily(s.fact, s.dates, s.users))


@register("dash_top_products", mart_sql("""
SELECT brand AS product_name, CAST(total_revenue AS DOUBLE) AS total_revenue, total_quantity_sold,
       total_purchases
FROM gold_product WHERE brand IS NOT NULL ORDER BY total_revenue DESC, product_id LIMIT 10"""))
def q_dash_top_products(spark, sf):
    s = star(spark, sf)
    return R.dash_top_products(marts.gold_product(s.fact, s.products, s.categories))


@register("dash_category_performance", mart_sql("""
SELECT category_l1 AS category_name, CAST(total_revenue AS DOUBLE) AS total_revenue, total_purchases,
       CAST(avg_revenue_per_purchase AS DOUBLE) AS avg_order_value
FROM gold_category WHERE category_l1 IS NOT NULL"""))
def q_dash_category_performance(spark, sf):
    s = star(spark, sf)
    return R.dash_category_performance(marts.gold_category(s.fact, s.categories))


@register("dash_summary_kpis", mart_sql(f"""
SELECT {msum('total_revenue')} AS total_revenue, CAST(SUM(total_purchases) AS BIGINT) AS total_purchases,
       {mavg('avg_order_value', 6)} AS avg_order_value, CAST(MAX(daily_active_users) AS BIGINT) AS peak_dau
FROM gold_daily"""))
def q_dash_summary_kpis(spark, sf):
    s = star(spark, sf)
    return R.dash_summary_kpis(marts.gold_daily(s.fact, s.dates, s.users))


@register("dash_funnel", mart_sql(f"""
SELECT 1 AS stage_order, 'Views' AS stage, v AS count, {rate('v', 'v', digits=1)} AS pct_of_views FROM t
UNION ALL SELECT 2, 'Add to Cart', c, {rate('c', 'v', digits=1)} FROM t
UNION ALL SELECT 3, 'Purchase', p, {rate('p', 'v', digits=1)} FROM t""", """t AS (
  SELECT CAST(SUM(total_views) AS BIGINT) AS v, CAST(SUM(total_carts) AS BIGINT) AS c,
         CAST(SUM(total_purchases) AS BIGINT) AS p
  FROM (SELECT * FROM gold_daily ORDER BY full_date DESC LIMIT 30))"""))
def q_dash_funnel(spark, sf):
    s = star(spark, sf)
    return R.dash_funnel(marts.gold_daily(s.fact, s.dates, s.users))

