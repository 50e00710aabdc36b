"""Streaming batch twins: the window / parse / session logic of the
stream jobs run as batch queries over the same event messages, so each
has a SQL oracle. The stream jobs themselves are exercised in tests
(availableNow triggers on file sources)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle
from ..registry import register
from ..sources.stream import stream_events_from_bronze
from ..streaming import parse_events, tag_events, windows as W
from .common import mavg, msum, rate, star

STREAM_EVENTS_CTE = """sev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(user_id AS BIGINT) AS user_id,
         CAST(product_id AS BIGINT) AS product_id, CAST(category_id AS BIGINT) AS category_id,
         event_time, price,
         CAST(CASE WHEN event_type IN ('cart', 'purchase') THEN 1 ELSE 0 END AS INTEGER) AS quantity,
         CASE WHEN event_type = 'purchase' THEN price * 1 ELSE 0.0 END AS revenue
  FROM bronze)"""


def stream_sql(body: str, extra: str = "") -> str:
    return oracle.with_star(body, STREAM_EVENTS_CTE + ("," + extra if extra else ""))


def parsed_events(spark, sf):
    """Bronze -> JSON messages -> parsed stream events (good rows)."""
    good, _ = parse_events(stream_events_from_bronze(star(spark, sf).bronze))
    return good


@register("json_parse_events", stream_sql("SELECT * FROM sev"))
def q_json_parse_events(spark, sf):
    return parsed_events(spark, sf)


@register("json_parse_wide_ids", stream_sql("""
SELECT * REPLACE (user_id + 5000000000 AS user_id, product_id + 5000000000 AS product_id, category_id + 5000000000 AS category_id) FROM sev"""))
def q_json_parse_wide_ids(spark, sf):
    """Ids beyond 32 bits are valid."""
    b = star(spark, sf).bronze
    for c in ("user_id", "product_id", "category_id"):
        b = b.withColumn(c, F.col(c) + 5_000_000_000)
    good, _ = parse_events(stream_events_from_bronze(b))
    return good


@register("tumbling_metrics", stream_sql(f"""
SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end, event_type,
       COUNT(*) AS event_count, COUNT(DISTINCT user_id) AS unique_users,
       COUNT(DISTINCT product_id) AS unique_products, {msum('revenue')} AS total_revenue,
       {mavg('price')} AS avg_price
FROM sev GROUP BY 1, 2, 3"""))
def q_tumbling_metrics(spark, sf):
    return W.tumbling(parsed_events(spark, sf))


@register("sliding_metrics", stream_sql(f"""
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, event_type, COUNT(*) AS event_count,
       {mavg('revenue')} AS avg_revenue_10min
FROM (SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start, * FROM sev
      UNION ALL
      SELECT time_bucket(INTERVAL 5 MINUTE, event_time) - INTERVAL 5 MINUTE AS window_start, * FROM sev)
GROUP BY 1, 2, 3"""))
def q_sliding_metrics(spark, sf):
    return W.sliding(parsed_events(spark, sf))


FUNNEL_SQL = f"""
SELECT window_start, window_end, views, carts, purchases, active_users, revenue,
       {rate('carts', 'views')} AS view_to_cart_rate, {rate('purchases', 'carts')} AS cart_to_purchase_rate
FROM (SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
             time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end,
             CAST(SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS views,
             CAST(SUM(CASE WHEN event_type = 'cart' THEN 1 ELSE 0 END) AS BIGINT) AS carts,
             CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
             COUNT(DISTINCT user_id) AS active_users, {msum('revenue')} AS revenue
      FROM sev GROUP BY 1, 2)"""


@register("stream_funnel", stream_sql(FUNNEL_SQL))
def q_stream_funnel(spark, sf):
    return W.funnel(parsed_events(spark, sf))


@register("session_windows", stream_sql("""
SELECT user_id, MIN(event_time) AS session_start, MAX(event_time) + INTERVAL 1800 SECOND AS session_end,
       COUNT(*) AS events
FROM (SELECT *, SUM(CASE WHEN gap IS NULL OR gap > 1800000000 THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY event_time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sn
      FROM (SELECT *, epoch_us(event_time) - LAG(epoch_us(event_time)) OVER (PARTITION BY user_id ORDER BY event_time)
                      AS gap FROM sev))
GROUP BY user_id, sn"""))
def q_session_windows(spark, sf):
    return W.session_windows(parsed_events(spark, sf))


@register("stream_bronze_summary", stream_sql("""
SELECT event_type, COUNT(*) AS event_count, COUNT(DISTINCT user_id) AS unique_users,
       MIN(event_time) AS first_event, MAX(event_time) AS last_event
FROM sev GROUP BY event_type"""))
def q_stream_bronze_summary(spark, sf):
    ev = parsed_events(spark, sf)
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"),
                                        F.count_distinct("user_id").alias("unique_users"),
                                        F.min("event_time").alias("first_event"),
                                        F.max("event_time").alias("last_event"))


@register("stream_recent_events", stream_sql("""
SELECT event_id, event_type, user_id, product_id, event_time, price, revenue
FROM sev ORDER BY event_time DESC, event_id LIMIT 20"""))
def q_stream_recent_events(spark, sf):
    ev = parsed_events(spark, sf)
    return (ev.select("event_id", "event_type", "user_id", "product_id", "event_time", "price", "revenue")
            .orderBy(F.desc("event_time"), F.asc("event_id")).limit(20))


@register("stream_latest_windows", stream_sql(f"SELECT * FROM ({FUNNEL_SQL}) ORDER BY window_start DESC LIMIT 20"))
def q_stream_latest_windows(spark, sf):
    return W.funnel(parsed_events(spark, sf)).orderBy(F.desc("window_start")).limit(20)


CORRUPT_MOD = 101   # every 101st message is truncated to exercise bad-row routing


@register("stream_bronze_quality", stream_sql(f"""
SELECT COUNT(*) AS total_messages,
       COUNT(*) FILTER (WHERE event_id % {CORRUPT_MOD} = 0) AS bad_messages,
       COUNT(*) FILTER (WHERE event_id % {CORRUPT_MOD} <> 0) AS good_events,
       COUNT(*) FILTER (WHERE event_id % {CORRUPT_MOD} <> 0 AND price IS NULL) AS null_price,
       COUNT(*) FILTER (WHERE event_id % {CORRUPT_MOD} <> 0)
         - COUNT(DISTINCT CASE WHEN event_id % {CORRUPT_MOD} <> 0 THEN event_id END) AS duplicate_event_ids
FROM bronze"""))
def q_stream_bronze_quality(spark, sf):
    """Stream bronze checks: messages, quarantined (malformed) messages,
    good events, NULL prices, duplicate event ids."""
    raw = stream_events_from_bronze(star(spark, sf).bronze, corrupt_mod=CORRUPT_MOD)
    t = tag_events(raw)
    good = ~F.col("is_bad")
    return t.agg(
        F.count(F.lit(1)).alias("total_messages"),
        F.count_if(F.col("is_bad")).alias("bad_messages"),
        F.count_if(good).alias("good_events"),
        F.count_if(good & F.col("data.price").isNull()).alias("null_price"),
        (F.count_if(good) - F.count_distinct(F.when(good, F.col("data.event_id")))).alias("duplicate_event_ids"))


@register("schema_contract_check", stream_sql(f"""
SELECT COUNT(*) AS total_rows,
       COUNT(*) FILTER (WHERE event_id % {CORRUPT_MOD} <> 0) AS conforming_rows,
       COUNT(*) FILTER (WHERE event_id % {CORRUPT_MOD} = 0) AS quarantined_rows
FROM bronze"""))
def q_schema_contract_check(spark, sf):
    """Every message (malformed ones included) projected onto the stream
    bronze contract; rows breaking a NOT NULL column are quarantined."""
    from ..schemas import STREAM_BRONZE, conform
    from ..streaming import with_stream_metadata
    raw = stream_events_from_bronze(star(spark, sf).bronze, corrupt_mod=CORRUPT_MOD)
    rows = with_stream_metadata(tag_events(raw).select("data.*", F.col("_ts").alias("_t"))
                                .withColumn("event_time", F.col("_t")).drop("_t"))
    good, bad = conform(rows, STREAM_BRONZE)
    g = good.select(F.lit(1).alias("ok"))
    b = bad.select(F.lit(0).alias("ok"))
    both = g.unionByName(b)
    return both.agg(F.count(F.lit(1)).alias("total_rows"),
                    F.count_if(F.col("ok") == 1).alias("conforming_rows"),
                    F.count_if(F.col("ok") == 0).alias("quarantined_rows"))
