"""SCD2 queries: change detection, apply, history, snapshot diff, versions
rebuilt from the event history, the point-in-time join that uses them,
and the invariant checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .. import oracle
from ..functions.columns import SEGMENT_ENGAGED_MIN, SEGMENT_POWER_MIN
from ..operators.io import snapshot_diff
from ..operators.joins import point_in_time
from ..operators.quality import scd2_invariants
from ..plans import reports, scd2
from ..registry import register
from .common import no_audit, rnd, star

DIM_COLS = ("product_sk, product_id, brand, price, category_sk, category_code, effective_from, "
            "effective_to, is_current_version, version_number")

SCD2_CTES = f"""
snap AS (
  SELECT product_id,
    CASE WHEN product_id % 10 = 0 THEN {rnd('price * 0.8')}
         WHEN product_id % 10 = 1 THEN {rnd('price * 1.1')} ELSE price END AS price,
    CASE WHEN product_id % 10 = 2 THEN brand || '_updated' ELSE brand END AS brand,
    category_sk, category_code
  FROM dim_products WHERE is_current_version
  UNION ALL
  SELECT product_id + 1000, price, brand, category_sk, category_code
  FROM dim_products WHERE is_current_version AND product_id % 10 = 3
),
det AS (
  SELECT s.product_id, s.price AS new_price, s.brand AS new_brand, s.category_sk AS new_category_sk,
    d.price AS old_price, d.brand AS old_brand, d.category_sk AS old_category_sk,
    d.product_sk AS old_sk, d.version_number AS old_version,
    CASE WHEN d.product_sk IS NULL THEN 'new'
         WHEN s.price IS DISTINCT FROM d.price OR s.brand IS DISTINCT FROM d.brand
              OR s.category_sk IS DISTINCT FROM d.category_sk THEN 'changed'
         ELSE 'unchanged' END AS change_type
  FROM snap s LEFT JOIN (SELECT * FROM dim_products WHERE is_current_version) d ON s.product_id = d.product_id
),
applied AS (
  SELECT {DIM_COLS} FROM dim_products WHERE NOT is_current_version
  UNION ALL
  SELECT d.product_sk, d.product_id, d.brand, d.price, d.category_sk, d.category_code, d.effective_from,
         d.effective_to, d.is_current_version, d.version_number
  FROM dim_products d LEFT JOIN det k ON d.product_id = k.product_id
  WHERE d.is_current_version AND (k.change_type IS NULL OR k.change_type <> 'changed')
  UNION ALL
  SELECT d.product_sk, d.product_id, d.brand, d.price, d.category_sk, d.category_code, d.effective_from,
         (SELECT MAX(event_date) FROM bronze), FALSE, d.version_number
  FROM dim_products d JOIN det k ON d.product_id = k.product_id
  WHERE d.is_current_version AND k.change_type = 'changed'
  UNION ALL
  SELECT (SELECT MAX(product_sk) FROM dim_products) + row_number() OVER (ORDER BY k.product_id),
         k.product_id, k.new_brand, k.new_price, k.new_category_sk, s.category_code,
         (SELECT MAX(event_date) FROM bronze), DATE '9999-12-31', TRUE,
         CAST(coalesce(k.old_version, 0) + 1 AS INTEGER)
  FROM det k JOIN snap s ON k.product_id = s.product_id WHERE k.change_type IN ('changed', 'new')
)"""

HISTORY_CTES = f"""
pday AS (
  SELECT product_id, event_date AS day, price, brand, category_code FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id, event_date ORDER BY event_time DESC, event_id DESC) AS rn
    FROM bronze WHERE product_id IS NOT NULL) WHERE rn = 1
),
pclean AS (
  SELECT p.product_id, p.day,
    CASE WHEN p.price IS NULL THEN 0.0 WHEN p.price < 0 THEN 0.0 ELSE p.price END AS price,
    CASE WHEN p.brand IS NULL THEN 'unknown' WHEN trim(p.brand) = '' THEN 'unknown' ELSE lower(trim(p.brand)) END AS brand,
    coalesce(c.category_sk, -1) AS category_sk, p.category_code
  FROM pday p LEFT JOIN dim_categories c ON p.category_code = c.category_full_path
),
pflag AS (
  SELECT *, CASE WHEN LAG(day) OVER w IS NULL OR price IS DISTINCT FROM LAG(price) OVER w
                   OR brand IS DISTINCT FROM LAG(brand) OVER w OR category_sk IS DISTINCT FROM LAG(category_sk) OVER w
                   OR category_code IS DISTINCT FROM LAG(category_code) OVER w THEN 1 ELSE 0 END AS st
  FROM pclean WINDOW w AS (PARTITION BY product_id ORDER BY day)
),
pnum AS (
  SELECT *, SUM(st) OVER (PARTITION BY product_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS vn
  FROM pflag
),
hist_products AS (
  SELECT row_number() OVER (ORDER BY product_id, vn) AS product_sk, product_id, brand, price, category_sk,
    category_code, day AS effective_from,
    coalesce(LEAD(day) OVER (PARTITION BY product_id ORDER BY vn), DATE '9999-12-31') AS effective_to,
    LEAD(day) OVER (PARTITION BY product_id ORDER BY vn) IS NULL AS is_current_version,
    CAST(vn AS INTEGER) AS version_number
  FROM pnum WHERE st = 1
),
uday AS (SELECT user_id, event_date AS day, COUNT(*) AS n FROM bronze WHERE user_id IS NOT NULL GROUP BY 1, 2),
useg AS (
  SELECT *, CASE WHEN events_to_date >= {SEGMENT_POWER_MIN} THEN 'power_user'
                 WHEN events_to_date >= {SEGMENT_ENGAGED_MIN} THEN 'engaged' ELSE 'casual' END AS user_segment
  FROM (SELECT *, CAST(SUM(n) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                        AS BIGINT) AS events_to_date FROM uday)
),
uflag AS (
  SELECT *, CASE WHEN LAG(day) OVER w IS NULL OR user_segment IS DISTINCT FROM LAG(user_segment) OVER w
                 THEN 1 ELSE 0 END AS st
  FROM useg WINDOW w AS (PARTITION BY user_id ORDER BY day)
),
unum AS (
  SELECT *, SUM(st) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS vn
  FROM uflag
),
hist_users AS (
  SELECT row_number() OVER (ORDER BY user_id, vn) AS user_sk, user_id, user_segment,
    events_to_date AS events_at_start, day AS effective_from,
    coalesce(LEAD(day) OVER (PARTITION BY user_id ORDER BY vn), DATE '9999-12-31') AS effective_to,
    LEAD(day) OVER (PARTITION BY user_id ORDER BY vn) IS NULL AS is_current_version,
    CAST(vn AS INTEGER) AS version_number
  FROM unum WHERE st = 1
),
pit AS (
  SELECT b.event_id, b.event_type, b.product_id, b.event_date, coalesce(p.product_sk, -1) AS product_sk,
         p.version_number, p.price AS price_at_event
  FROM bronze b LEFT JOIN hist_products p ON b.product_id = p.product_id
       AND b.event_date >= p.effective_from AND b.event_date < p.effective_to
)"""


def scd2_sql(body: str) -> str:
    return oracle.with_star(body, SCD2_CTES + ",\n" + HISTORY_CTES)


def _applied(spark, sf):
    s = star(spark, sf)
    as_of = s.bronze.select(F.max("event_date")).scalar()
    snap = scd2.snapshot_from_dim(s.products)
    return s, snap, scd2.scd2_apply(s.products, snap, "product_id", scd2.PRODUCT_TRACKED, as_of,
                                    carry=["category_code"])


def _hist_products(spark, sf) -> DataFrame:
    s = star(spark, sf)
    return scd2.products_from_history(s.bronze, s.categories)


@register("scd2_detect_changes", scd2_sql("SELECT * FROM det"))
def q_scd2_detect(spark, sf):
    s = star(spark, sf)
    return scd2.scd2_detect(s.products, scd2.snapshot_from_dim(s.products), "product_id",
                            scd2.PRODUCT_TRACKED).drop("old_from")


@register("scd2_apply", scd2_sql("SELECT * FROM applied"))
def q_scd2_apply(spark, sf):
    return no_audit(_applied(spark, sf)[2])


@register("scd2_apply_duplicate_snapshot", scd2_sql("SELECT * FROM applied"))
def q_scd2_apply_duplicate_snapshot(spark, sf):
    """Every key twice in the snapshot, the second time at a lower price:
    the greater values of a key count, so the result is that of the clean
    snapshot."""
    s = star(spark, sf)
    as_of = s.bronze.select(F.max("event_date")).scalar()
    snap = scd2.snapshot_from_dim(s.products)
    twice = snap.unionByName(snap.withColumn("price", F.col("price") - 1.0))
    return no_audit(scd2.scd2_apply(s.products, twice, "product_id", scd2.PRODUCT_TRACKED, as_of, carry=["category_code"]))


@register("scd2_apply_same_day", scd2_sql("""
SELECT * REPLACE (CASE WHEN is_current_version AND effective_from = (SELECT MAX(event_date) FROM bronze)
                       THEN price + 1 ELSE price END AS price) FROM applied"""))
def q_scd2_apply_same_day(spark, sf):
    """A corrected snapshot on the same day replaces the versions that began
    that day in place."""
    s, _, applied = _applied(spark, sf)
    as_of = s.bronze.select(F.max("event_date")).scalar()
    again = (applied.filter(F.col("is_current_version") & (F.col("effective_from") == as_of))
             .select("product_id", (F.col("price") + 1).alias("price"), "brand", "category_sk", "category_code"))
    return no_audit(scd2.scd2_apply(applied, again, "product_id", scd2.PRODUCT_TRACKED, as_of, carry=["category_code"]))


@register("scd2_history", scd2_sql("""
SELECT * FROM applied WHERE product_id IN (SELECT product_id FROM applied GROUP BY product_id HAVING COUNT(*) > 1)"""))
def q_scd2_history(spark, sf):
    return no_audit(scd2.scd2_history(_applied(spark, sf)[2], "product_id"))


@register("snapshot_diff", scd2_sql("""
SELECT coalesce(o.product_id, n.product_id) AS product_id,
  CASE WHEN o.product_id IS NULL THEN 'added' WHEN n.product_id IS NULL THEN 'removed' ELSE 'changed' END AS change,
  o.price AS old_price, n.price AS new_price, o.brand AS old_brand, n.brand AS new_brand,
  o.category_sk AS old_category_sk, n.category_sk AS new_category_sk
FROM (SELECT * FROM dim_products WHERE is_current_version) o
FULL OUTER JOIN (SELECT * FROM applied WHERE is_current_version) n ON o.product_id = n.product_id
WHERE o.product_id IS NULL OR n.product_id IS NULL OR o.price IS DISTINCT FROM n.price
   OR o.brand IS DISTINCT FROM n.brand OR o.category_sk IS DISTINCT FROM n.category_sk"""))
def q_snapshot_diff(spark, sf):
    s, _, applied = _applied(spark, sf)
    cur = F.col("is_current_version")
    return snapshot_diff(s.products.filter(cur), applied.filter(cur), ["product_id"],
                         scd2.PRODUCT_TRACKED)


@register("scd2_products_from_history", scd2_sql("SELECT * FROM hist_products"))
def q_scd2_products_from_history(spark, sf):
    return no_audit(_hist_products(spark, sf))


@register("scd2_users_from_history", scd2_sql("SELECT * FROM hist_users"))
def q_scd2_users_from_history(spark, sf):
    s = star(spark, sf)
    return no_audit(scd2.users_from_history(s.bronze))


def _pit(spark, sf) -> DataFrame:
    s = star(spark, sf)
    ev = s.bronze.select("event_id", "event_type", "product_id", "event_date")
    return point_in_time(ev, _hist_products(spark, sf), "product_id", "event_date",
                         {"product_sk": "product_sk", "version_number": "version_number",
                          "price": "price_at_event"}, unknown={"product_sk": -1})


@register("point_in_time_join", scd2_sql("SELECT * FROM pit"))
def q_point_in_time_join(spark, sf):
    return _pit(spark, sf)


@register("product_history_purchases", scd2_sql("""
SELECT p.product_id, p.brand, p.price, p.effective_from, COUNT(*) AS purchases
FROM pit f JOIN hist_products p ON f.product_sk = p.product_sk
WHERE f.event_type = 'purchase' GROUP BY ALL"""))
def q_product_history_purchases(spark, sf):
    return reports.product_history_purchases(_pit(spark, sf), _hist_products(spark, sf))


def _inv_sql(table: str, key: str, name: str) -> str:
    return f"""
SELECT '{name}' AS dimension, COUNT(*) AS keys,
  COUNT(*) FILTER (WHERE cur <> 1) AS keys_without_one_current,
  CAST(SUM(bad) AS BIGINT) AS empty_intervals, CAST(SUM(gap) AS BIGINT) AS gaps_or_overlaps,
  CAST(SUM(ver) AS BIGINT) AS version_breaks
FROM (
  SELECT {key}, COUNT(*) FILTER (WHERE is_current_version) AS cur,
    COUNT(*) FILTER (WHERE effective_from >= effective_to) AS bad,
    COUNT(*) FILTER (WHERE prev_to IS NOT NULL AND prev_to <> effective_from) AS gap,
    COUNT(*) FILTER (WHERE prev_ver IS NOT NULL AND version_number <> prev_ver + 1) AS ver
  FROM (SELECT *, LAG(effective_to) OVER (PARTITION BY {key} ORDER BY effective_from) AS prev_to,
               LAG(version_number) OVER (PARTITION BY {key} ORDER BY effective_from) AS prev_ver
        FROM {table})
  GROUP BY {key})"""


@register("scd2_invariants", scd2_sql(
    _inv_sql("applied", "product_id", "products_applied") + "\nUNION ALL\n"
    + _inv_sql("hist_products", "product_id", "products_history") + "\nUNION ALL\n"
    + _inv_sql("hist_users", "user_id", "users_history")))
def q_scd2_invariants(spark, sf):
    s = star(spark, sf)
    parts = [
        scd2_invariants(_applied(spark, sf)[2], "product_id").select(F.lit("products_applied").alias("dimension"), "*"),
        scd2_invariants(_hist_products(spark, sf), "product_id").select(F.lit("products_history").alias("dimension"), "*"),
        scd2_invariants(scd2.users_from_history(s.bronze), "user_id").select(F.lit("users_history").alias("dimension"), "*"),
    ]
    return reduce(DataFrame.unionByName, parts)


@register("point_in_time_users", scd2_sql("""
SELECT b.event_id, b.user_id, b.event_date, coalesce(u.user_sk, -1) AS user_sk, u.user_segment,
       u.version_number
FROM bronze b LEFT JOIN hist_users u ON b.user_id = u.user_id
     AND b.event_date >= u.effective_from AND b.event_date < u.effective_to"""))
def q_point_in_time_users(spark, sf):
    """Each event with the user's segment version valid on the event date
    (segment evolution from the running event count)."""
    s = star(spark, sf)
    ev = s.bronze.select("event_id", "user_id", "event_date")
    return point_in_time(ev, scd2.users_from_history(s.bronze), "user_id", "event_date",
                         {"user_sk": "user_sk", "user_segment": "user_segment",
                          "version_number": "version_number"}, unknown={"user_sk": -1})
