"""Later loads: every fifth day of a month arrives after all others. The
tables that the late days leave must equal those rebuilt from all events
(the oracle knows nothing of loads)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import SEGMENT_ENGAGED_MIN, SEGMENT_POWER_MIN
from ..operators.io import rows_of_days
from ..operators.joins import lookup
from ..plans import increment, marts, scd2, star as S
from ..registry import register
from .common import no_audit, star
from .marts_q import CATEGORY_SQL
from .scd2_q import scd2_sql

LATE_EVERY = 5

HIST_FACT = """
hist_fact AS (
  SELECT b.event_id, b.event_time, b.event_date, b.event_type, coalesce(d.date_key, -1) AS date_sk, coalesce(u.user_sk, -1) AS user_sk,
         coalesce(p.product_sk, -1) AS product_sk, coalesce(p.category_sk, -1) AS category_sk, p.price AS price_at_event,
         CASE WHEN b.event_type IN ('cart', 'purchase') THEN 1 ELSE 0 END AS quantity,
         CASE WHEN b.event_type = 'purchase' THEN p.price * 1 ELSE 0.0 END AS revenue,
         p.product_id, p.effective_from, p.version_number
  FROM bronze b LEFT JOIN dim_date d ON b.event_date = d.full_date
  LEFT JOIN dim_users u ON b.user_id = u.user_id
  LEFT JOIN hist_products p ON b.product_id = p.product_id AND b.event_date >= p.effective_from AND b.event_date < p.effective_to
)"""


def _parts(spark, sf):
    """Star, the early part of bronze and the late part."""
    s = star(spark, sf)
    late = F.dayofmonth("event_date") % LATE_EVERY == 0
    return s, s.bronze.filter(~late), s.bronze.filter(late)


def _products(s, early: DataFrame, late: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Product versions before and after the late days."""
    old = scd2.products_from_history(early, s.categories)
    return old, increment.splice_products(old, increment.product_days(s.bronze), late, s.categories)


@register("scd2_apply_late", scd2_sql("SELECT * EXCLUDE (product_sk) FROM hist_products"))
def q_scd2_apply_late(spark, sf):
    s, early, late = _parts(spark, sf)
    return no_audit(_products(s, early, late)[1]).drop("product_sk")


@register("scd2_users_late", scd2_sql("SELECT * EXCLUDE (user_sk) FROM hist_users"))
def q_scd2_users_late(spark, sf):
    s, early, late = _parts(spark, sf)
    new = increment.splice_users(scd2.users_from_history(early), increment.user_days(s.bronze), late, SEGMENT_POWER_MIN, SEGMENT_ENGAGED_MIN)
    return no_audit(new).drop("user_sk")


def _maintained(spark, sf) -> tuple:
    """The fact of the early days, with the days rewritten that the late
    load touches: its own and those where a product resolves anew."""
    s, early, late = _parts(spark, sf)
    old, new = _products(s, early, late)
    days = increment.product_days(s.bronze)
    again = late.select("event_date").unionByName(increment.changed_days(old, new, days, late)).distinct()
    before = S.fact_events(early, s.dates, s.users, old)
    written = S.fact_events(rows_of_days(s.bronze, again), s.dates, s.users, new)
    kept = before.join(F.broadcast(again), "event_date", "left_anti")
    return s, new, kept.select(*written.columns).unionByName(written)


@register("maintained_fact", scd2_sql(f"""
SELECT event_id, event_time, event_date, event_type, date_sk, user_sk, category_sk, price_at_event, quantity, revenue,
       product_id, effective_from, version_number FROM (WITH {HIST_FACT} SELECT * FROM hist_fact)"""))
def q_maintained_fact(spark, sf):
    _, new, fact = _maintained(spark, sf)
    versions = new.select("product_sk", "product_id", "effective_from", "version_number")
    return fact.join(versions, "product_sk", "left").select(
        "event_id", "event_time", "event_date", "event_type", "date_sk", "user_sk", "category_sk", "price_at_event", "quantity", "revenue",
        "product_id", "effective_from", "version_number")


@register("maintained_gold_category", scd2_sql(
    f"SELECT * FROM (WITH {HIST_FACT} {CATEGORY_SQL.replace('FROM fact f', 'FROM hist_fact f')})"))
def q_maintained_gold_category(spark, sf):
    """The category mart added up from the cells of early and late days."""
    s, _, fact = _maintained(spark, sf)
    return no_audit(marts.gold_category(marts.reduce_cells(fact), s.categories))


@register("categories_late", scd2_sql("SELECT category_full_path, category_l1, category_l2, category_l3, category_depth FROM dim_categories"))
def q_categories_late(spark, sf):
    """Paths that only late days have are added, none is renumbered."""
    _, early, late = _parts(spark, sf)
    known = S.dim_categories(early)
    both = increment.add_categories(known, late)
    moved = lookup(both.withColumnRenamed("category_sk", "now"), known, "category_full_path", "category_full_path", "category_sk", out="was", unknown=0)
    stable = F.when(F.col("was").isin(0) | (F.col("was") == F.col("now")), F.col("category_full_path"))
    return moved.select(stable.alias("category_full_path"), "category_l1", "category_l2", "category_l3", "category_depth")
