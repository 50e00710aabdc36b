"""Event-time window metrics. The same functions run on a streaming frame
(watermark + stateful aggregation) and on a batch frame (the batch twin),
with the same results:

* by default distinct counts are exact through two levels of aggregation
  ((window, value) first, then the window, where values are rows). On a
  stream such chained aggregations run in append mode: a window comes out
  once the watermark passes it; state is one row per value per open window;
* ``sketch=True`` counts with HLL++ (relative error ``rsd``, default 5%,
  ~0.4 KB per group) on streams and batches alike, in any output mode and
  with state that does not grow with a window's users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import money, money_avg, money_sum, ratio_avg, safe_rate
from ..operators.windows import sessionize

WATERMARK = "10 minutes"
TUMBLE = "5 minutes"
SLIDE_SIZE = "10 minutes"
SESSION_GAP_S = 1800


def _watermarked(df: DataFrame, delay: str | None) -> DataFrame:
    return df.withWatermark("event_time", delay) if delay else df


def tumbling(df: DataFrame, size: str = TUMBLE, delay: str | None = WATERMARK, rsd: float = 0.05,
             sketch: bool = False) -> DataFrame:
    """Per tumbling window x event type: events, distinct users and
    products, revenue, average price. Exact: one chained aggregation per
    distinct measure, joined on window and type."""
    d = _watermarked(df, delay)
    w, keys = F.window("event_time", size).alias("w"), ["w", "event_type"]
    if sketch:
        agg = d.groupBy(w, "event_type").agg(
            F.count(F.lit(1)).alias("event_count"),
            F.approx_count_distinct("user_id", rsd).alias("unique_users"),
            F.approx_count_distinct("product_id", rsd).alias("unique_products"),
            money_sum("revenue").alias("total_revenue"),
            money_avg("price").alias("avg_price"))
    else:
        per_user = d.groupBy(w, "event_type", "user_id").agg(
            F.count(F.lit(1)).alias("n"), F.sum(money("revenue")).alias("r"), F.sum(money("price")).alias("p"), F.count("price").alias("pn"))
        users = per_user.groupBy(*keys).agg(
            F.sum("n").cast("long").alias("event_count"), F.count("user_id").alias("unique_users"),
            F.round(F.sum("r"), 2).cast("double").alias("total_revenue"), ratio_avg(F.sum("p"), F.sum("pn")).alias("avg_price"))
        per_product = d.groupBy(w, "event_type", "product_id").agg(F.count(F.lit(1)).alias("n"))
        products = per_product.groupBy(*keys).agg(F.count("product_id").alias("unique_products"))
        agg = users.join(products, keys)
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "event_type", "event_count", "unique_users", "unique_products", "total_revenue",
                      "avg_price")


def sliding(df: DataFrame, size: str = SLIDE_SIZE, slide: str = TUMBLE,
            delay: str | None = WATERMARK) -> DataFrame:
    """Per sliding window x event type: events and average revenue."""
    d = _watermarked(df, delay)
    agg = d.groupBy(F.window("event_time", size, slide).alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        money_avg("revenue").alias("avg_revenue_10min"))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "event_type", "event_count", "avg_revenue_10min")


def funnel(df: DataFrame, size: str = TUMBLE, delay: str | None = WATERMARK, rsd: float = 0.05,
           sketch: bool = False) -> DataFrame:
    """Per tumbling window: views, carts, purchases, active users, revenue
    and the two step rates (NULL when the denominator is 0)."""
    d = _watermarked(df, delay)

    def n(t):
        return F.sum(F.when(F.col("event_type") == t, 1).otherwise(0)).cast("long")

    w = F.window("event_time", size).alias("w")
    if not sketch:
        per_user = d.groupBy(w, "user_id").agg(
            n("view").alias("views"), n("cart").alias("carts"), n("purchase").alias("purchases"),
            F.sum(money("revenue")).alias("_rev"))
        agg = per_user.groupBy("w").agg(
            F.sum("views").cast("long").alias("views"), F.sum("carts").cast("long").alias("carts"),
            F.sum("purchases").cast("long").alias("purchases"),
            F.count("user_id").alias("active_users"),
            F.round(F.sum("_rev"), 2).cast("double").alias("revenue"))
    else:
        agg = d.groupBy(w).agg(
            n("view").alias("views"), n("cart").alias("carts"), n("purchase").alias("purchases"),
            F.approx_count_distinct("user_id", rsd).alias("active_users"),
            money_sum("revenue").alias("revenue"))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "views", "carts", "purchases", "active_users", "revenue",
                      safe_rate("carts", "views").alias("view_to_cart_rate"),
                      safe_rate("purchases", "carts").alias("cart_to_purchase_rate"))


def session_windows(df: DataFrame, gap_s: int = SESSION_GAP_S, user: str = "user_id",
                    delay: str | None = WATERMARK) -> DataFrame:
    """Per user session (a gap longer than ``gap_s`` starts a new one; the
    session ends ``gap_s`` after its last event): start, end, events.

    Streams use ``session_window`` (append / complete output modes). Batch
    frames use the bucketed ``sessionize`` with microsecond gaps, which
    gives the same sessions without funnelling a hot user into one task."""
    if df.isStreaming:
        d = _watermarked(df, delay)
        agg = d.groupBy(user, F.session_window("event_time", f"{gap_s} seconds").alias("s")).agg(
            F.count(F.lit(1)).alias("events"))
        return agg.select(user, F.col("s.start").alias("session_start"),
                          F.col("s.end").alias("session_end"), "events")
    s = sessionize(df.select(user, "event_time"), user, "event_time", gap_s, unit="us")
    return (s.groupBy(user, "session_number").agg(
        F.min("event_time").alias("session_start"),
        (F.max("event_time") + F.expr(f"INTERVAL {gap_s} SECONDS")).alias("session_end"),
        F.count(F.lit(1)).alias("events")).drop("session_number"))


def dedupe_events(df: DataFrame, key: str = "event_id", delay: str = WATERMARK) -> DataFrame:
    """Drop repeated deliveries of the same event. On a stream the state
    per key lives only until the watermark passes it."""
    if df.isStreaming:
        return df.withWatermark("event_time", delay).dropDuplicatesWithinWatermark([key])
    return df.dropDuplicates([key])
