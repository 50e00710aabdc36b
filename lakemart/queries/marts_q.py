"""Gold marts: registered queries and their oracle SQL.

The mart SQL bodies are also reused as CTEs by the report queries."""

from __future__ import annotations

from .. import oracle
from ..plans import marts
from ..registry import register
from .common import (mavg, msum, RATES, TIMING, USER_DISTINCTS, aov, cnt, no_audit, qty, rate, rev, star,
                     type_counts, users)

DAILY_SQL = f"""
  SELECT d.date_key, d.full_date, d.year, d.quarter, d.month, d.month_name, d.day_of_month,
    d.day_name, d.day_of_week, d.is_weekend,
    COUNT(DISTINCT f.user_sk) AS daily_active_users,
    {type_counts()},
    {msum('f.revenue')} AS total_revenue,
    {aov()} AS avg_order_value,
    {qty()} AS total_quantity_sold,
    {rate(cnt('cart', alias='f'), cnt('view', alias='f'))} AS view_to_cart_rate,
    {rate(cnt('purchase', alias='f'), cnt('cart', alias='f'))} AS cart_to_purchase_rate,
    {rate(cnt('purchase', alias='f'), cnt('view', alias='f'))} AS overall_conversion_rate,
    COUNT(DISTINCT f.product_sk) AS unique_products_viewed,
    COUNT(DISTINCT CASE WHEN f.event_type = 'purchase' THEN f.product_sk END) AS unique_products_sold,
    COUNT(DISTINCT f.category_sk) AS unique_categories_active,
    COUNT(DISTINCT CASE WHEN u.user_segment = 'power_user' THEN f.user_sk END) AS dau_power_users,
    COUNT(DISTINCT CASE WHEN u.user_segment = 'engaged' THEN f.user_sk END) AS dau_engaged,
    COUNT(DISTINCT CASE WHEN u.user_segment = 'casual' THEN f.user_sk END) AS dau_casual
  FROM fact f
  JOIN dim_date d ON f.date_sk = d.date_key
  JOIN dim_users u ON f.user_sk = u.user_sk
  GROUP BY d.date_key, d.full_date, d.year, d.quarter, d.month, d.month_name, d.day_of_month,
    d.day_name, d.day_of_week, d.is_weekend"""

USER_SQL = f"""
  SELECT u.user_sk, u.user_id, u.user_segment,
    {type_counts()},
    {msum('f.revenue')} AS lifetime_revenue,
    {aov()} AS avg_order_value,
    {qty()} AS total_quantity_purchased,
    MIN(f.event_time) AS first_event_date,
    MAX(f.event_time) AS last_event_date,
    CAST(datediff('day', CAST(MIN(f.event_time) AS DATE), CAST(MAX(f.event_time) AS DATE)) AS INTEGER) AS days_between_first_last,
    COUNT(DISTINCT f.date_sk) AS days_active,
    CAST(datediff('day', MAX(CAST(f.event_time AS DATE)), (SELECT MAX(event_date) FROM fact)) AS INTEGER) AS recency_days,
    {cnt('purchase', alias='f')} AS frequency_purchases,
    {rate(cnt('purchase', alias='f'), cnt('view', alias='f'))} AS personal_conversion_rate,
    COUNT(DISTINCT f.product_sk) AS unique_products_viewed,
    COUNT(DISTINCT CASE WHEN f.event_type = 'purchase' THEN f.product_sk END) AS unique_products_purchased,
    COUNT(DISTINCT f.category_sk) AS unique_categories_browsed
  FROM fact f JOIN dim_users u ON f.user_sk = u.user_sk
  WHERE u.is_current_version
  GROUP BY u.user_sk, u.user_id, u.user_segment"""

PRODUCT_SQL = f"""
  SELECT *, {RATES},
    CAST(DENSE_RANK() OVER (PARTITION BY category_l1 ORDER BY total_revenue DESC) AS INTEGER) AS rank_in_category_by_revenue,
    CAST(DENSE_RANK() OVER (PARTITION BY category_l1 ORDER BY total_purchases DESC) AS INTEGER) AS rank_in_category_by_purchases
  FROM (
    SELECT p.product_sk, p.product_id, p.brand, c.category_full_path AS category_code,
      c.category_l1, c.category_l2,
      {type_counts()},
      {rev()} AS total_revenue,
      {aov()} AS avg_revenue_per_purchase,
      {qty()} AS total_quantity_sold,
      {USER_DISTINCTS},
      {TIMING},
      MAX(p.price) AS current_price, MIN(p.price) AS min_price_seen, MAX(p.price) AS max_price_seen
    FROM fact f
    JOIN dim_products p ON f.product_sk = p.product_sk
    JOIN dim_categories c ON f.category_sk = c.category_sk
    WHERE p.is_current_version
    GROUP BY p.product_sk, p.product_id, p.brand, c.category_full_path, c.category_l1, c.category_l2)"""

CATEGORY_SQL = f"""
  SELECT *, {RATES},
    CAST(ROUND(CAST(total_revenue * 100.0 / NULLIF(SUM(total_revenue) OVER (PARTITION BY category_l1), 0) AS DECIMAL(38,10)), 2) AS DOUBLE)
      AS revenue_share_within_l1,
    CAST(DENSE_RANK() OVER (ORDER BY total_revenue DESC) AS INTEGER) AS overall_rank_by_revenue,
    CAST(DENSE_RANK() OVER (PARTITION BY category_l1 ORDER BY total_revenue DESC) AS INTEGER) AS rank_within_l1_by_revenue
  FROM (
    SELECT c.category_sk, c.category_l1, c.category_l2, c.category_l3, c.category_full_path,
      c.category_depth,
      {type_counts()},
      {rev()} AS total_revenue,
      {aov()} AS avg_revenue_per_purchase,
      {qty()} AS total_quantity_sold,
      COUNT(DISTINCT f.product_sk) AS unique_products,
      COUNT(DISTINCT CASE WHEN f.event_type = 'purchase' THEN f.product_sk END) AS products_purchased,
      {USER_DISTINCTS},
      {TIMING}
    FROM fact f JOIN dim_categories c ON f.category_sk = c.category_sk
    GROUP BY c.category_sk, c.category_l1, c.category_l2, c.category_l3, c.category_full_path,
      c.category_depth)"""

BRAND_SQL = f"""
  SELECT *, {RATES},
    CAST(ROUND(CAST(total_revenue * 100.0 / NULLIF(SUM(total_revenue) OVER (), 0) AS DECIMAL(38,10)), 2) AS DOUBLE) AS revenue_market_share,
    CAST(DENSE_RANK() OVER (ORDER BY total_revenue DESC) AS INTEGER) AS rank_by_revenue,
    CAST(DENSE_RANK() OVER (ORDER BY unique_products DESC) AS INTEGER) AS rank_by_product_count
  FROM (
    SELECT p.brand,
      {type_counts()},
      {rev()} AS total_revenue,
      {aov()} AS avg_revenue_per_purchase,
      {qty()} AS total_quantity_sold,
      COUNT(DISTINCT f.product_sk) AS unique_products,
      COUNT(DISTINCT CASE WHEN f.event_type = 'purchase' THEN f.product_sk END) AS products_purchased,
      COUNT(DISTINCT c.category_l1) AS categories_l1_count,
      COUNT(DISTINCT c.category_sk) AS total_categories,
      {USER_DISTINCTS},
      {TIMING},
      MIN(p.price) AS min_price, MAX(p.price) AS max_price, {mavg('p.price')} AS avg_price
    FROM fact f
    JOIN dim_products p ON f.product_sk = p.product_sk
    JOIN dim_categories c ON f.category_sk = c.category_sk
    WHERE p.is_current_version
    GROUP BY p.brand)"""

FUNNEL_SQL = f"""
  SELECT *,
    {rate('users_carted', 'users_viewed')} AS view_to_cart_user_rate,
    {rate('users_purchased', 'users_carted')} AS cart_to_purchase_user_rate,
    {rate('users_purchased', 'users_viewed')} AS overall_conversion_user_rate,
    {rate('total_carts', 'total_views')} AS view_to_cart_event_rate,
    {rate('total_purchases', 'total_carts')} AS cart_to_purchase_event_rate,
    {rate('total_purchases', 'total_views')} AS overall_conversion_event_rate,
    users_viewed - users_carted AS users_dropped_at_cart,
    users_carted - users_purchased AS users_dropped_at_purchase,
    {rate('users_viewed - users_carted', 'users_viewed')} AS cart_abandonment_rate,
    {rate('users_carted - users_purchased', 'users_carted')} AS purchase_abandonment_rate,
    {rate('total_removes', 'total_carts')} AS cart_removal_rate,
    {rate('total_revenue', 'users_viewed', '1.0')} AS revenue_per_viewer,
    {rate('total_revenue', 'users_purchased', '1.0')} AS revenue_per_purchaser
  FROM (
    SELECT f.date_sk, d.full_date, c.category_l1, c.category_l2,
      {users('view')} AS users_viewed,
      {users('cart')} AS users_carted,
      {users('purchase')} AS users_purchased,
      {cnt('view', alias='f')} AS total_views,
      {cnt('cart', alias='f')} AS total_carts,
      {cnt('remove_from_cart', alias='f')} AS total_removes,
      {cnt('purchase', alias='f')} AS total_purchases,
      {rev()} AS total_revenue,
      COUNT(DISTINCT f.product_sk) AS unique_products_in_funnel
    FROM fact f
    JOIN dim_products p ON f.product_sk = p.product_sk
    JOIN dim_categories c ON f.category_sk = c.category_sk
    JOIN dim_date d ON f.date_sk = d.date_key
    WHERE p.is_current_version
    GROUP BY f.date_sk, d.full_date, c.category_l1, c.category_l2)"""


def session_ctes(gap_s: int = 1800) -> str:
    """Brute-force sessionization: lag over each user's whole history."""
    return f"""
sess_lag AS (
  SELECT *, epoch(date_trunc('second', event_time))
           - LAG(epoch(date_trunc('second', event_time))) OVER (PARTITION BY user_sk ORDER BY event_time) AS gap
  FROM fact
),
sess_num AS (
  SELECT *, SUM(CASE WHEN gap IS NULL OR gap > {gap_s} THEN 1 ELSE 0 END)
           OVER (PARTITION BY user_sk ORDER BY event_time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           AS session_number
  FROM sess_lag
),
session_agg AS (
  SELECT user_sk, CAST(session_number AS BIGINT) AS session_number, date_sk,
    MIN(event_time) AS session_start, MAX(event_time) AS session_end,
    (epoch(date_trunc('second', MAX(event_time))) - epoch(date_trunc('second', MIN(event_time)))) / 60.0
      AS session_duration_minutes,
    COUNT(*) AS total_events_in_session,
    {cnt('view')} AS views_in_session,
    {cnt('cart')} AS carts_in_session,
    {cnt('purchase')} AS purchases_in_session,
    MAX(CASE WHEN event_type = 'cart' THEN 1 ELSE 0 END) AS had_cart_action,
    MAX(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS had_purchase,
    {msum("CASE WHEN event_type = 'purchase' THEN revenue ELSE 0 END")} AS session_revenue,
    COUNT(DISTINCT product_sk) AS unique_products_in_session,
    COUNT(DISTINCT category_sk) AS unique_categories_in_session
  FROM sess_num GROUP BY user_sk, session_number, date_sk
)"""


SESSION_SQL = f"""
  SELECT sa.date_sk, d.full_date,
    COUNT(*) AS total_sessions,
    COUNT(DISTINCT sa.user_sk) AS unique_users_with_sessions,
    CAST(ROUND(CAST(AVG(sa.session_duration_minutes) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_session_duration_minutes,
    CAST(ROUND(CAST(quantile_cont(sa.session_duration_minutes, 0.5) AS DECIMAL(38,10)), 2) AS DOUBLE) AS median_session_duration_minutes,
    MAX(sa.session_duration_minutes) AS max_session_duration_minutes,
    CAST(ROUND(CAST(AVG(sa.total_events_in_session) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_events_per_session,
    CAST(ROUND(CAST(AVG(sa.views_in_session) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_views_per_session,
    CAST(ROUND(CAST(AVG(sa.unique_products_in_session) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_products_per_session,
    CAST(SUM(sa.had_cart_action) AS BIGINT) AS sessions_with_cart,
    CAST(SUM(sa.had_purchase) AS BIGINT) AS sessions_with_purchase,
    {rate('SUM(sa.had_cart_action)', 'COUNT(*)')} AS pct_sessions_with_cart,
    {rate('SUM(sa.had_purchase)', 'COUNT(*)')} AS pct_sessions_with_purchase,
    {msum('sa.session_revenue')} AS total_session_revenue,
    {mavg('CASE WHEN sa.had_purchase = 1 THEN sa.session_revenue END')} AS avg_revenue_per_converting_session,
    CAST(SUM(CASE WHEN sa.total_events_in_session = 1 THEN 1 ELSE 0 END) AS BIGINT) AS single_event_sessions,
    CAST(SUM(CASE WHEN sa.total_events_in_session BETWEEN 2 AND 5 THEN 1 ELSE 0 END) AS BIGINT) AS low_engagement_sessions,
    CAST(SUM(CASE WHEN sa.total_events_in_session BETWEEN 6 AND 15 THEN 1 ELSE 0 END) AS BIGINT) AS medium_engagement_sessions,
    CAST(SUM(CASE WHEN sa.total_events_in_session > 15 THEN 1 ELSE 0 END) AS BIGINT) AS high_engagement_sessions
  FROM session_agg sa JOIN dim_date d ON sa.date_sk = d.date_key
  GROUP BY sa.date_sk, d.full_date"""


def cohort_ctes(source: str = "fact", user: str = "user_sk") -> str:
    return f"""
ufa AS (
  SELECT {user} AS cu, date_trunc('month', MIN(event_time)) AS cohort_month
  FROM {source} GROUP BY {user}
),
uma AS (
  SELECT f.{user} AS cu, ufa.cohort_month, date_trunc('month', f.event_time) AS activity_month,
    COUNT(DISTINCT CASE WHEN f.event_type = 'view' THEN f.event_time END) AS views,
    COUNT(DISTINCT CASE WHEN f.event_type = 'cart' THEN f.event_time END) AS carts,
    COUNT(DISTINCT CASE WHEN f.event_type = 'purchase' THEN f.event_time END) AS purchases,
    {msum("CASE WHEN f.event_type = 'purchase' THEN f.revenue ELSE 0 END")} AS revenue
  FROM {source} f JOIN ufa ON f.{user} = ufa.cu
  GROUP BY f.{user}, ufa.cohort_month, date_trunc('month', f.event_time)
),
cm AS (
  SELECT cohort_month, CAST(datediff('month', cohort_month, activity_month) AS INTEGER) AS periods_since_cohort,
    activity_month,
    COUNT(DISTINCT cu) AS cohort_size, COUNT(DISTINCT cu) AS active_users,
    CAST(SUM(views) AS BIGINT) AS total_views, CAST(SUM(carts) AS BIGINT) AS total_carts,
    CAST(SUM(purchases) AS BIGINT) AS total_purchases,
    {msum('revenue')} AS period_revenue,
    CAST(ROUND(CAST(AVG(views) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_views_per_user,
    {mavg('revenue')} AS avg_revenue_per_user
  FROM uma GROUP BY cohort_month, datediff('month', cohort_month, activity_month), activity_month
),
csb AS (SELECT cohort_month, COUNT(DISTINCT cu) AS total_cohort_users FROM ufa GROUP BY cohort_month),
gold_cohort AS (
  SELECT cm.*, csb.total_cohort_users,
    {rate('cm.active_users', 'csb.total_cohort_users')} AS retention_rate,
    CAST(ROUND(SUM(CAST(cm.period_revenue AS DECIMAL(18,6))) OVER (PARTITION BY cm.cohort_month
          ORDER BY cm.periods_since_cohort ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS DOUBLE)
      AS cumulative_revenue,
    CAST(ROUND(CAST(SUM(CAST(cm.period_revenue AS DECIMAL(18,6))) OVER (PARTITION BY cm.cohort_month
          ORDER BY cm.periods_since_cohort ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
          / csb.total_cohort_users AS DECIMAL(38,8)), 2) AS DOUBLE) AS ltv_to_date
  FROM cm JOIN csb ON cm.cohort_month = csb.cohort_month
)"""


MART_CTES = ",\n".join([
    f"gold_daily AS ({DAILY_SQL})",
    f"gold_user AS ({USER_SQL})",
    f"gold_product AS ({PRODUCT_SQL})",
    f"gold_category AS ({CATEGORY_SQL})",
    f"gold_brand AS ({BRAND_SQL})",
    f"gold_funnel AS ({FUNNEL_SQL})",
])


def mart_sql(body: str, extra: str = "") -> str:
    ctes = MART_CTES + (",\n" + extra if extra else "")
    return oracle.with_star(body, ctes)


@register("gold_daily_metrics", mart_sql("SELECT * FROM gold_daily"))
def q_gold_daily(spark, sf_dir):
    s = star(spark, sf_dir)
    return no_audit(marts.gold_daily(s.fact, s.dates, s.users))


@register("gold_user_metrics", mart_sql("SELECT * FROM gold_user"))
def q_gold_user(spark, sf_dir):
    s = star(spark, sf_dir)
    return no_audit(marts.gold_user(s.fact, s.users))


@register("gold_product_performance", mart_sql("SELECT * FROM gold_product"))
def q_gold_product(spark, sf_dir):
    s = star(spark, sf_dir)
    return no_audit(marts.gold_product(s.fact, s.products, s.categories))


@register("gold_category_performance", mart_sql("SELECT * FROM gold_category"))
def q_gold_category(spark, sf_dir):
    s = star(spark, sf_dir)
    return no_audit(marts.gold_category(s.fact, s.categories))


@register("gold_brand_performance", mart_sql("SELECT * FROM gold_brand"))
def q_gold_brand(spark, sf_dir):
    s = star(spark, sf_dir)
    return no_audit(marts.gold_brand(s.fact, s.products, s.categories))


@register("gold_funnel_metrics", mart_sql("SELECT * FROM gold_funnel"))
def q_gold_funnel(spark, sf_dir):
    s = star(spark, sf_dir)
    return no_audit(marts.gold_funnel(s.fact, s.products, s.categories, s.dates))


@register("gold_session_metrics", oracle.with_star(SESSION_SQL, session_ctes(1800)))
def q_gold_session(spark, sf_dir):
    s = star(spark, sf_dir)
    return no_audit(marts.gold_session(s.fact, s.dates, 1800))


@register("gold_session_metrics_2h_gap", oracle.with_star(SESSION_SQL, session_ctes(7200)))
def q_gold_session_2h(spark, sf_dir):
    """Same mart with a 2-hour gap, so multi-event sessions occur."""
    s = star(spark, sf_dir)
    return no_audit(marts.gold_session(s.fact, s.dates, 7200))


@register("sessionize", oracle.with_star(
    "SELECT user_sk, event_id, CAST(session_number AS BIGINT) AS session_number FROM sess_num",
    session_ctes(7200)))
def q_sessionize(spark, sf_dir):
    from ..operators.windows import sessionize
    s = star(spark, sf_dir)
    return sessionize(s.fact.select("user_sk", "event_id", "event_time"), "user_sk", "event_time",
                      7200).select("user_sk", "event_id", "session_number")


@register("gold_cohort_analysis", oracle.with_star("SELECT * FROM gold_cohort", cohort_ctes()))
def q_gold_cohort(spark, sf_dir):
    s = star(spark, sf_dir)
    return no_audit(marts.gold_cohort(s.fact))
