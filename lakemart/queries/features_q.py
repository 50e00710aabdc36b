"""Tier-2 feature queries with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle
from ..operators.windows import sessionize
from ..plans import features as X, session_state as SS, snapshots
from ..registry import register
from .common import mavg, msum, rate, rnd, star
from .marts_q import session_ctes

TOD_SQL = ("CASE WHEN h < 5 THEN 'night' WHEN h < 12 THEN 'morning' WHEN h < 17 THEN 'afternoon' "
           "WHEN h < 21 THEN 'evening' ELSE 'night' END")


@register("fact_time_features", oracle.with_star(f"""
SELECT event_id, event_time, event_type, user_sk, user_session, product_sk, h AS hour_of_day,
       dow AS day_of_week, dow IN (6, 7) AS is_weekend,
       h >= 9 AND h < 17 AND dow NOT IN (6, 7) AS is_business_hours,
       {TOD_SQL} AS time_of_day,
       row_number() OVER (PARTITION BY user_session ORDER BY event_time, event_id) AS event_number_in_session,
       row_number() OVER (PARTITION BY user_session ORDER BY event_time, event_id) = 1 AS is_first_event_in_session
FROM (SELECT *, CAST(hour(event_time) AS INTEGER) AS h, CAST(isodow(event_time) AS INTEGER) AS dow FROM fact)"""))
def q_fact_time_features(spark, sf):
    return X.fact_time_features(star(spark, sf).fact)


@register("fact_sessions", oracle.with_star(f"""
SELECT *, CASE WHEN total_events > 1 THEN {rnd('session_duration_seconds / (total_events - 1)')} END
            AS avg_time_between_events_sec,
       total_purchases > 0 AS did_purchase, total_carts > 0 AS did_add_to_cart,
       CASE WHEN total_purchases > 0 THEN 'purchase' WHEN total_carts > 0 THEN 'cart' ELSE 'view_only' END
         AS funnel_stage,
       total_events = 1 AS is_bounce_session, isodow(session_date) IN (6, 7) AS is_weekend,
       {TOD_SQL.replace('h <', 'hour(session_start_time) <')} AS session_time_of_day
FROM (
  SELECT user_session AS session_id, MIN(user_sk) AS user_sk, MIN(event_date) AS session_date,
    MIN(event_time) AS session_start_time, MAX(event_time) AS session_end_time,
    CAST(epoch(date_trunc('second', MAX(event_time))) - epoch(date_trunc('second', MIN(event_time))) AS BIGINT)
      AS session_duration_seconds,
    COUNT(*) AS total_events,
    CAST(SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS total_views,
    CAST(SUM(CASE WHEN event_type = 'cart' THEN 1 ELSE 0 END) AS BIGINT) AS total_carts,
    CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS total_purchases,
    CAST(SUM(CASE WHEN event_type = 'remove_from_cart' THEN 1 ELSE 0 END) AS BIGINT) AS total_removals,
    COUNT(DISTINCT CASE WHEN event_type = 'view' THEN product_sk END) AS unique_products_viewed,
    COUNT(DISTINCT CASE WHEN event_type = 'view' THEN category_sk END) AS unique_categories_viewed,
    {msum("CASE WHEN event_type = 'purchase' THEN revenue ELSE 0 END")} AS session_revenue
  FROM fact GROUP BY user_session)"""))
def q_fact_sessions(spark, sf):
    return X.fact_sessions(star(spark, sf).fact)


@register("category_parents", oracle.with_star("""
SELECT c.category_sk, c.category_l1, c.category_l2, c.category_l3, c.category_full_path, c.category_depth,
       p.category_sk AS parent_category_sk
FROM dim_categories c LEFT JOIN dim_categories p ON p.category_full_path =
  CASE WHEN c.category_depth = 3 THEN c.category_l1 || '.' || c.category_l2
       WHEN c.category_depth = 2 THEN c.category_l1 END"""))
def q_category_parents(spark, sf):
    return X.category_parents(star(spark, sf).categories)


@register("user_lifecycle_segment", oracle.with_star(f"""
SELECT * EXCLUDE (d), CAST(datediff('day', first_event_date, d) AS INTEGER) AS days_since_first,
       CAST(datediff('day', last_event_date, d) AS INTEGER) AS days_since_last,
       CASE WHEN datediff('day', last_event_date, d) > {X.CHURN_DAYS} THEN 'churned'
            WHEN datediff('day', last_event_date, d) > {X.AT_RISK_DAYS} THEN 'at_risk'
            WHEN datediff('day', first_event_date, d) < {X.NEW_MAX_DAYS}
                 AND total_lifetime_sessions < {X.NEW_MAX_SESSIONS} THEN 'new'
            WHEN total_lifetime_sessions >= {X.LOYAL_MIN_SESSIONS}
                 AND datediff('day', first_event_date, d) >= {X.LOYAL_MIN_TENURE_DAYS} THEN 'loyal'
            ELSE 'active' END AS customer_segment
FROM (SELECT user_sk, MIN(event_date) AS first_event_date, MAX(event_date) AS last_event_date,
             COUNT(DISTINCT user_session) AS total_lifetime_sessions, COUNT(*) AS total_lifetime_events,
             {msum('revenue')} AS total_lifetime_revenue,
             CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS total_lifetime_purchases,
             (SELECT MAX(event_date) FROM fact) AS d
      FROM fact GROUP BY user_sk)"""))
def q_user_lifecycle(spark, sf):
    return X.user_lifecycle(star(spark, sf).fact)


def _fav_sql(src: str, col: str, out: str) -> str:
    return f"""(SELECT user_sk, {col} AS {out} FROM (
  SELECT user_sk, {col}, row_number() OVER (PARTITION BY user_sk ORDER BY n DESC, {col}) AS r
  FROM (SELECT user_sk, {col}, COUNT(*) AS n FROM {src} WHERE {col} IS NOT NULL GROUP BY 1, 2)) WHERE r = 1)"""


@register("user_favorites", oracle.with_star(f"""
SELECT coalesce(a.user_sk, b.user_sk) AS user_sk, a.favorite_category_l1, b.favorite_brand
FROM {_fav_sql('fx', 'category_l1', 'favorite_category_l1')} a
FULL OUTER JOIN {_fav_sql('fx', 'brand', 'favorite_brand')} b ON a.user_sk = b.user_sk""", """fx AS (
  SELECT f.user_sk, c.category_l1, p.brand FROM fact f
  LEFT JOIN dim_categories c ON f.category_sk = c.category_sk
  LEFT JOIN dim_products p ON f.product_sk = p.product_sk)"""))
def q_user_favorites(spark, sf):
    s = star(spark, sf)
    return X.user_favorites(s.fact, s.products, s.categories)


def _age(lo: int, hi: int) -> str:
    return f"datediff('day', event_date, (SELECT MAX(event_date) FROM fact)) BETWEEN {lo} AND {hi - 1}"


@register("user_behavior_features", oracle.with_star(f"""
SELECT a.user_sk, recency_days, events_last_7d, events_last_14d, events_last_30d, sessions_last_7d,
  sessions_last_30d, revenue_last_7d, revenue_last_30d, purchases_last_30d,
  {rate('purchases_last_30d', 'sessions_last_30d', '1.0')} AS conversion_rate_30d, avg_order_value_30d,
  weekend_events * 2 > events AS is_weekend_shopper,
  {rate('events_last_7d', 'events_prior_7d', '1.0')} AS trend_events_7d_vs_prior_7d,
  h.favorite_shopping_hour, dw.preferred_day_of_week
FROM (
  SELECT user_sk, CAST(datediff('day', MAX(event_date), (SELECT MAX(event_date) FROM fact)) AS INTEGER) AS recency_days,
    CAST(SUM(CASE WHEN {_age(0, 7)} THEN 1 ELSE 0 END) AS BIGINT) AS events_last_7d,
    CAST(SUM(CASE WHEN {_age(0, 14)} THEN 1 ELSE 0 END) AS BIGINT) AS events_last_14d,
    CAST(SUM(CASE WHEN {_age(0, 30)} THEN 1 ELSE 0 END) AS BIGINT) AS events_last_30d,
    CAST(SUM(CASE WHEN {_age(7, 14)} THEN 1 ELSE 0 END) AS BIGINT) AS events_prior_7d,
    COUNT(DISTINCT CASE WHEN {_age(0, 7)} THEN user_session END) AS sessions_last_7d,
    COUNT(DISTINCT CASE WHEN {_age(0, 30)} THEN user_session END) AS sessions_last_30d,
    {msum(f"CASE WHEN {_age(0, 7)} AND event_type = 'purchase' THEN revenue ELSE 0 END")} AS revenue_last_7d,
    {msum(f"CASE WHEN {_age(0, 30)} AND event_type = 'purchase' THEN revenue ELSE 0 END")} AS revenue_last_30d,
    CAST(SUM(CASE WHEN {_age(0, 30)} AND event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases_last_30d,
    {mavg(f"CASE WHEN {_age(0, 30)} AND event_type = 'purchase' THEN revenue END")} AS avg_order_value_30d,
    SUM(CASE WHEN isodow(event_time) IN (6, 7) THEN 1 ELSE 0 END) AS weekend_events, COUNT(*) AS events
  FROM fact GROUP BY user_sk) a
LEFT JOIN {_fav_sql('fh', 'hh', 'favorite_shopping_hour')} h ON a.user_sk = h.user_sk
LEFT JOIN {_fav_sql('fh', 'dd', 'preferred_day_of_week')} dw ON a.user_sk = dw.user_sk""",
    "fh AS (SELECT user_sk, CAST(hour(event_time) AS INTEGER) AS hh, strftime(event_time, '%A') AS dd FROM fact)"))
def q_user_behavior_features(spark, sf):
    return X.user_behavior_features(star(spark, sf).fact)


@register("product_features", oracle.with_star(f"""
SELECT product_sk, total_views_lifetime, total_cart_adds_lifetime, total_purchases_lifetime,
  total_revenue_lifetime, views_last_7d, views_last_30d, purchases_last_7d, purchases_last_30d,
  revenue_last_7d, revenue_last_30d,
  {rate('total_cart_adds_lifetime', 'total_views_lifetime')} AS view_to_cart_rate_lifetime,
  {rate('total_purchases_lifetime', 'total_cart_adds_lifetime')} AS cart_to_purchase_rate_lifetime,
  {rate('total_purchases_lifetime', 'total_views_lifetime')} AS view_to_purchase_rate_lifetime,
  avg_price_sold_at, min_price_seen, max_price_seen, last_known_price, days_since_last_view,
  days_since_last_purchase, views_last_30d > 0 AS is_active_product,
  {rate('views_last_7d', 'views_prior_7d', '1.0')} AS trend_views_7d_vs_prior_7d,
  coalesce({rate('views_last_7d', 'views_prior_7d', '1.0')} > 1, FALSE) AS is_trending
FROM (
  SELECT product_sk,
    CAST(SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS total_views_lifetime,
    CAST(SUM(CASE WHEN event_type = 'cart' THEN 1 ELSE 0 END) AS BIGINT) AS total_cart_adds_lifetime,
    CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS total_purchases_lifetime,
    {msum("CASE WHEN event_type = 'purchase' THEN revenue ELSE 0 END")} AS total_revenue_lifetime,
    CAST(SUM(CASE WHEN event_type = 'view' AND {_age(0, 7)} THEN 1 ELSE 0 END) AS BIGINT) AS views_last_7d,
    CAST(SUM(CASE WHEN event_type = 'view' AND {_age(0, 30)} THEN 1 ELSE 0 END) AS BIGINT) AS views_last_30d,
    CAST(SUM(CASE WHEN event_type = 'view' AND {_age(7, 14)} THEN 1 ELSE 0 END) AS BIGINT) AS views_prior_7d,
    CAST(SUM(CASE WHEN event_type = 'purchase' AND {_age(0, 7)} THEN 1 ELSE 0 END) AS BIGINT) AS purchases_last_7d,
    CAST(SUM(CASE WHEN event_type = 'purchase' AND {_age(0, 30)} THEN 1 ELSE 0 END) AS BIGINT) AS purchases_last_30d,
    {msum(f"CASE WHEN event_type = 'purchase' AND {_age(0, 7)} THEN revenue ELSE 0 END")} AS revenue_last_7d,
    {msum(f"CASE WHEN event_type = 'purchase' AND {_age(0, 30)} THEN revenue ELSE 0 END")} AS revenue_last_30d,
    {mavg("CASE WHEN event_type = 'purchase' THEN price_at_event END")} AS avg_price_sold_at,
    MIN(price_at_event) AS min_price_seen, MAX(price_at_event) AS max_price_seen,
    first(price_at_event ORDER BY event_time DESC, event_id DESC) AS last_known_price,
    CAST(datediff('day', MAX(CASE WHEN event_type = 'view' THEN event_date END), (SELECT MAX(event_date) FROM fact))
      AS INTEGER) AS days_since_last_view,
    CAST(datediff('day', MAX(CASE WHEN event_type = 'purchase' THEN event_date END), (SELECT MAX(event_date) FROM fact))
      AS INTEGER) AS days_since_last_purchase
  FROM fact WHERE product_sk <> -1 GROUP BY product_sk)"""))
def q_product_features(spark, sf):
    return X.product_features(star(spark, sf).fact)


@register("incremental_sessions", oracle.with_star("""
SELECT user_sk, event_id, event_time, CAST(session_number AS BIGINT) AS session_number
FROM sess_num WHERE event_date = (SELECT MAX(event_date) FROM fact)""", session_ctes(1800)))
def q_incremental_sessions(spark, sf):
    """Sessions of the last day's events, continuing the numbering of the
    already sessionized earlier days (only that day's users are touched)."""
    f = star(spark, sf).fact.select("user_sk", "event_id", "event_time", "event_date")
    last_day = f.select(F.max("event_date")).scalar()
    old = f.filter(F.col("event_date") < last_day)
    new = f.filter(F.col("event_date") == last_day)
    history = sessionize(old, "user_sk", "event_time", 1800)
    return X.incremental_sessions(history, new)


LATE_CTES = """
lf AS (SELECT user_sk, event_id, event_time, event_type = 'purchase' AS late FROM fact),
ln0 AS (SELECT *, CASE WHEN lag(event_time) OVER w IS NULL
               OR date_diff('second', date_trunc('second', lag(event_time) OVER w), date_trunc('second', event_time)) > 1800 THEN 1 ELSE 0 END AS st
        FROM lf WHERE NOT late WINDOW w AS (PARTITION BY user_sk ORDER BY event_time, event_id)),
lold AS (SELECT event_id, SUM(st) OVER (PARTITION BY user_sk ORDER BY event_time, event_id) AS sn FROM ln0),
la0 AS (SELECT *, CASE WHEN lag(event_time) OVER w IS NULL
               OR date_diff('second', date_trunc('second', lag(event_time) OVER w), date_trunc('second', event_time)) > 1800 THEN 1 ELSE 0 END AS st
        FROM lf WINDOW w AS (PARTITION BY user_sk ORDER BY event_time, event_id)),
lall AS (SELECT user_sk, event_id, event_time, late, SUM(st) OVER (PARTITION BY user_sk ORDER BY event_time, event_id) AS sn FROM la0)"""


@register("incremental_sessions_late", oracle.with_star("""
SELECT user_sk, event_id, event_time, CAST(a.sn AS BIGINT) AS session_number
FROM lall a LEFT JOIN lold o USING (event_id) WHERE late OR a.sn <> o.sn""", LATE_CTES))
def q_incremental_sessions_late(spark, sf):
    """All purchases arrive after everything else was sessionized: their
    numbers, and the earlier rows whose numbers they change, equal those of
    a full sessionization."""
    f = star(spark, sf).fact.select("user_sk", "event_id", "event_time", "event_type")
    late = F.col("event_type") == "purchase"
    return X.incremental_sessions(sessionize(f.filter(~late), "user_sk", "event_time", 1800), f.filter(late))


@register("incremental_sessions_state", oracle.with_star("""
SELECT user_sk, event_id, event_time, CAST(a.sn AS BIGINT) AS session_number
FROM lall a LEFT JOIN lold o USING (event_id) WHERE late OR a.sn <> o.sn""", LATE_CTES))
def q_incremental_sessions_state(spark, sf):
    """The same late purchases, numbered against the table of sessions; the
    history is read only for the rows whose number changes."""
    f = star(spark, sf).fact.select("user_sk", "event_id", "event_time", "event_date", "event_type")
    late = F.col("event_type") == "purchase"
    history, state = SS.start_state(f.filter(~late))
    load = SS.load_sessions(state, f.filter(late))
    moved = SS.renumber(history, load.moves)
    return load.events.unionByName(moved).select("user_sk", "event_id", "event_time", "session_number")


def _ago(lo: int, hi: int) -> str:
    return f"f.age BETWEEN {lo} AND {hi - 1}"


def _paid(lo: int, hi: int) -> str:
    return msum(f"CASE WHEN {_ago(lo, hi)} AND f.event_type = 'purchase' THEN f.revenue ELSE 0 END")


@register("user_daily_features", oracle.with_star(f"""
SELECT a.user_sk, a.feature_date, recency_days, events_last_7d, events_last_14d, events_last_30d, sessions_last_7d, sessions_last_30d,
  revenue_last_7d, revenue_last_30d, purchases_last_30d, avg_order_value_30d, h.v AS favorite_shopping_hour, w.v AS preferred_day_of_week,
  weekend * 2 > events AS is_weekend_shopper,
  {rate('events_last_30d', 'sessions_last_30d', '1.0')} AS avg_events_per_session_30d,
  {rate('purchases_last_30d', 'sessions_last_30d', '1.0')} AS conversion_rate_30d,
  {rate('events_last_7d', 'events_prior', '1.0')} AS trend_events_7d_vs_prior_7d,
  {rate('revenue_last_30d', 'revenue_prior', '1.0')} AS trend_revenue_30d_vs_prior_30d
FROM (
  SELECT user_sk, feature_date, CAST(MIN(age) AS INTEGER) AS recency_days, COUNT(*) AS events,
    COUNT(CASE WHEN isodow(f.event_time) IN (6, 7) THEN 1 END) AS weekend,
    COUNT(CASE WHEN {_ago(0, 7)} THEN 1 END) AS events_last_7d, COUNT(CASE WHEN {_ago(0, 14)} THEN 1 END) AS events_last_14d,
    COUNT(CASE WHEN {_ago(0, 30)} THEN 1 END) AS events_last_30d, COUNT(CASE WHEN {_ago(7, 14)} THEN 1 END) AS events_prior,
    COUNT(DISTINCT CASE WHEN {_ago(0, 7)} THEN user_session END) AS sessions_last_7d,
    COUNT(DISTINCT CASE WHEN {_ago(0, 30)} THEN user_session END) AS sessions_last_30d,
    {_paid(0, 7)} AS revenue_last_7d, {_paid(0, 30)} AS revenue_last_30d, {_paid(30, 60)} AS revenue_prior,
    COUNT(CASE WHEN {_ago(0, 30)} AND f.event_type = 'purchase' THEN 1 END) AS purchases_last_30d,
    {mavg(f"CASE WHEN {_ago(0, 30)} AND f.event_type = 'purchase' THEN f.revenue END")} AS avg_order_value_30d
  FROM seen f GROUP BY 1, 2) a
JOIN (SELECT user_sk, feature_date, v FROM (SELECT user_sk, feature_date, CAST(hour(event_time) AS INTEGER) AS v,
        row_number() OVER (PARTITION BY user_sk, feature_date ORDER BY COUNT(*) DESC, hour(event_time)) AS r FROM seen GROUP BY 1, 2, hour(event_time)) WHERE r = 1) h
  ON a.user_sk = h.user_sk AND a.feature_date = h.feature_date
JOIN (SELECT user_sk, feature_date, v FROM (SELECT user_sk, feature_date, strftime(event_time, '%A') AS v,
        row_number() OVER (PARTITION BY user_sk, feature_date ORDER BY COUNT(*) DESC, strftime(event_time, '%A')) AS r FROM seen GROUP BY 1, 2, 3) WHERE r = 1) w
  ON a.user_sk = w.user_sk AND a.feature_date = w.feature_date""", """
grid AS (SELECT user_sk, CAST(unnest(generate_series(CAST(MIN(event_date) AS TIMESTAMP), (SELECT CAST(MAX(event_date) AS TIMESTAMP) FROM fact), INTERVAL 1 DAY)) AS DATE) AS feature_date
         FROM fact GROUP BY user_sk),
seen AS (SELECT f.*, g.feature_date, datediff('day', f.event_date, g.feature_date) AS age
         FROM fact f JOIN grid g ON f.user_sk = g.user_sk AND f.event_date <= g.feature_date)"""))
def q_user_daily_features(spark, sf):
    return snapshots.user_daily_features(star(spark, sf).fact)


@register("sessionize_null_keys", oracle.with_star("""
SELECT user_sk, event_id, event_time, CASE WHEN user_sk IS NOT NULL AND event_time IS NOT NULL THEN CAST(SUM(st) OVER (
         PARTITION BY user_sk, event_time IS NULL ORDER BY event_time, event_id) AS BIGINT) END AS session_number
FROM (SELECT *, CASE WHEN lag(event_time) OVER w IS NULL
             OR date_diff('second', date_trunc('second', lag(event_time) OVER w), date_trunc('second', event_time)) > 1800 THEN 1 ELSE 0 END AS st
      FROM nullf WINDOW w AS (PARTITION BY user_sk, event_time IS NULL ORDER BY event_time, event_id))""", """
nullf AS (SELECT CASE WHEN event_type <> 'remove_from_cart' THEN user_sk END AS user_sk, event_id,
                 CASE WHEN event_type <> 'cart' THEN event_time END AS event_time FROM fact)"""))
def q_sessionize_null_keys(spark, sf):
    """Events without a user or a time are kept, with a NULL session."""
    f = star(spark, sf).fact
    n = f.select(F.when(F.col("event_type") != "remove_from_cart", F.col("user_sk")).alias("user_sk"), "event_id",
                 F.when(F.col("event_type") != "cart", F.col("event_time")).alias("event_time"))
    return sessionize(n, "user_sk", "event_time", 1800)


@register("fact_time_features_null_session", oracle.with_star("""
SELECT event_id, user_session, CASE WHEN user_session IS NOT NULL THEN
         row_number() OVER (PARTITION BY user_session ORDER BY event_time, event_id) END AS event_number_in_session,
       user_session IS NOT NULL AND row_number() OVER (PARTITION BY user_session ORDER BY event_time, event_id) = 1 AS is_first_event_in_session
FROM (SELECT * REPLACE (CASE WHEN event_type <> 'cart' THEN user_session END AS user_session) FROM fact)"""))
def q_fact_time_features_null_session(spark, sf):
    """Events without a session are kept, without a position."""
    f = star(spark, sf).fact
    n = f.withColumn("user_session", F.when(F.col("event_type") != "cart", F.col("user_session")))
    return X.fact_time_features(n).select("event_id", "user_session", "event_number_in_session", "is_first_event_in_session")


@register("sessionless_events", oracle.with_star("""
SELECT event_date, COUNT(*) AS events, COUNT(DISTINCT user_sk) AS users FROM fact WHERE event_type = 'cart' GROUP BY event_date"""))
def q_sessionless_events(spark, sf):
    """With the carts' session ids missing: what ``fact_sessions`` leaves out."""
    f = star(spark, sf).fact
    return X.sessionless_events(f.withColumn("user_session", F.when(F.col("event_type") != "cart", F.col("user_session"))))


@register("dim_date_fiscal", oracle.with_star("""
SELECT *, CAST(year + CASE WHEN month >= 7 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
       CAST(floor(((month - 7 + 12) % 12) / 3) + 1 AS INTEGER) AS fiscal_quarter,
       CAST(((month - 7 + 12) % 12) + 1 AS INTEGER) AS fiscal_month
FROM dim_date"""))
def q_dim_date_fiscal(spark, sf):
    return X.dim_date_fiscal(star(spark, sf).dates, 7)
