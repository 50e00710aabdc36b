"""Independent DuckDB SQL for every registered query (the correctness
oracle). The star schema is rebuilt here from the raw views with plain SQL
(window ``row_number`` keys, ``lag`` sessions, ...), so a Spark result that
matches it was not derived from the same code.
"""

from __future__ import annotations

POWER = 72     # segment thresholds suited to the test data (see README)
ENGAGED = 62


def star_ctes(power: int = POWER, engaged: int = ENGAGED) -> str:
    """CTEs: bronze, dim_date, dim_categories, dim_products, dim_users, fact."""
    return f"""
bronze AS (
  SELECT e.event_id,
         CAST(e.ts AS TIMESTAMP) AS event_time,
         CASE e.event_type WHEN 'click' THEN 'cart' WHEN 'error' THEN 'remove_from_cart'
              ELSE e.event_type END AS event_type,
         e.k AS product_id,
         e.k % 25 AS category_id,
         CASE WHEN p.p_type IS NULL THEN NULL
              WHEN e.k % 5 = 0 THEN NULL
              WHEN e.k % 5 = 1 THEN lower(p.p_type)
              WHEN e.k % 5 = 2 THEN lower(p.p_type) || '.' || lower(split_part(p.p_name, ' ', 2))
              ELSE lower(p.p_type) || '.' || lower(split_part(p.p_name, ' ', 2)) || '.'
                   || lower(split_part(p.p_name, ' ', 1)) END AS category_code,
         CASE WHEN e.k % 7 = 0 THEN NULL WHEN e.k % 11 = 0 THEN '  '
              ELSE ' ' || p.p_brand END AS brand,
         CASE WHEN e.event_id % 97 = 0 THEN NULL WHEN e.event_id % 89 = 0 THEN -e.value
              ELSE e.value END AS price,
         e.user_id,
         CAST(e.user_id AS VARCHAR) || '-' || CAST(CAST(e.ts AS DATE) AS VARCHAR) AS user_session,
         CAST(e.ts AS DATE) AS event_date
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) e
  LEFT JOIN part p ON p.p_partkey = e.k
),
cal_days AS (
  SELECT CAST(d AS DATE) AS d FROM (
    SELECT unnest(generate_series(CAST((SELECT min(event_date) FROM bronze) AS TIMESTAMP),
                                  CAST((SELECT max(event_date) FROM bronze) AS TIMESTAMP) + INTERVAL 365 DAY,
                                  INTERVAL 1 DAY)) AS d)
),
dim_date AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key,
         d AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
         CAST(strftime(d, '%U') AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
         CAST(isodow(d) AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
         isodow(d) IN (6, 7) AS is_weekend, day(d) = 1 AS is_month_start,
         day(d + INTERVAL 1 DAY) = 1 AS is_month_end,
         month(d) IN (1, 4, 7, 10) AND day(d) = 1 AS is_quarter_start,
         month(d) IN (3, 6, 9, 12) AND day(d + INTERVAL 1 DAY) = 1 AS is_quarter_end
  FROM cal_days
),
cat_parts AS (
  SELECT category_code, string_split(category_code, '.') AS parts
  FROM (SELECT DISTINCT category_code FROM bronze)
),
dim_categories AS (
  SELECT row_number() OVER (ORDER BY category_full_path) AS category_sk, * FROM (
    SELECT coalesce(parts[1], 'unknown') AS category_l1,
           CASE WHEN len(parts) >= 2 THEN parts[2] END AS category_l2,
           CASE WHEN len(parts) >= 3 THEN parts[3] END AS category_l3,
           coalesce(category_code, 'unknown') AS category_full_path,
           CASE WHEN len(parts) >= 3 THEN 3 WHEN len(parts) >= 2 THEN 2
                WHEN len(parts) >= 1 THEN 1 ELSE 0 END AS category_depth
    FROM cat_parts)
),
latest_product AS (
  SELECT product_id, price, brand, category_code FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id
                                 ORDER BY event_time DESC, event_id DESC) AS rn
    FROM bronze WHERE product_id IS NOT NULL) WHERE rn = 1
),
dim_products AS (
  SELECT row_number() OVER (ORDER BY l.product_id) AS product_sk, l.product_id,
         CASE WHEN l.brand IS NULL THEN 'unknown' WHEN trim(l.brand) = '' THEN 'unknown'
              ELSE lower(trim(l.brand)) END AS brand,
         CASE WHEN l.price IS NULL THEN 0.0 WHEN l.price < 0 THEN 0.0 ELSE l.price END AS price,
         coalesce(c.category_sk, -1) AS category_sk, l.category_code,
         (SELECT min(event_date) FROM bronze) AS effective_from,
         DATE '9999-12-31' AS effective_to, TRUE AS is_current_version, 1 AS version_number
  FROM latest_product l LEFT JOIN dim_categories c ON l.category_code = c.category_full_path
),
user_act AS (
  SELECT user_id, count(*) AS total_events, count(DISTINCT event_type) AS event_types_count,
         min(event_date) AS first_seen_date, max(event_date) AS last_seen_date,
         count(DISTINCT event_date) AS active_days,
         CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchase_count,
         CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS view_count,
         CAST(sum(CASE WHEN event_type = 'cart' THEN 1 ELSE 0 END) AS BIGINT) AS cart_count
  FROM bronze WHERE user_id IS NOT NULL GROUP BY user_id
),
dim_users AS (
  SELECT row_number() OVER (ORDER BY user_id) AS user_sk, user_id,
         CASE WHEN total_events >= {power} THEN 'power_user'
              WHEN total_events >= {engaged} THEN 'engaged' ELSE 'casual' END AS user_segment,
         total_events, event_types_count, first_seen_date, last_seen_date, active_days,
         CAST(ROUND(CAST(total_events / (datediff('day', first_seen_date, last_seen_date) + 1) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_events_per_day,
         purchase_count, view_count, cart_count,
         first_seen_date AS effective_from, DATE '9999-12-31' AS effective_to,
         TRUE AS is_current_version, 1 AS version_number
  FROM user_act
),
fact AS (
  SELECT b.event_id, b.event_time, b.event_date, b.event_type,
         coalesce(d.date_key, -1) AS date_sk, coalesce(u.user_sk, -1) AS user_sk,
         coalesce(p.product_sk, -1) AS product_sk, coalesce(p.category_sk, -1) AS category_sk,
         p.price AS price_at_event,
         CASE WHEN b.event_type IN ('cart', 'purchase') THEN 1 ELSE 0 END AS quantity,
         CASE WHEN b.event_type = 'purchase' THEN p.price * 1 ELSE 0.0 END AS revenue,
         1 AS event_count, b.user_session
  FROM bronze b
  LEFT JOIN dim_date d ON b.event_date = d.full_date
  LEFT JOIN dim_users u ON b.user_id = u.user_id AND u.is_current_version
  LEFT JOIN dim_products p ON b.product_id = p.product_id
       AND b.event_date >= p.effective_from AND b.event_date < p.effective_to
)"""


def rnd(x: str, digits: int = 2) -> str:
    """Round half away from zero on the decimal value, as Spark's ``round``
    does (DuckDB rounds the binary double, so 32.675 would give 32.67)."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def msum(x: str, digits: int = 2) -> str:
    """Exact decimal money sum, rounded, as DOUBLE (matches ``money_sum``)."""
    return f"CAST(ROUND(SUM(CAST({x} AS DECIMAL(18,6))), {digits}) AS DOUBLE)"


def mavg(x: str, digits: int = 2) -> str:
    """Money average: DuckDB returns the exact decimal sum / count as a
    DOUBLE; rounding through DECIMAL(38,8) removes that one division error."""
    return f"CAST(ROUND(CAST(AVG(CAST({x} AS DECIMAL(18,6))) AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def with_star(body: str, extra_ctes: str = "", power: int = POWER, engaged: int = ENGAGED) -> str:
    ctes = star_ctes(power, engaged)
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"
