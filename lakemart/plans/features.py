"""Tier-2 silver features: event time features, session facts, category
parents, lifecycle segments, favourites, rolling user / product features,
incremental sessionization, fiscal calendar.

All per-entity features are single hash aggregations with conditional
sums over date offsets from an ``as_of`` date (partial aggregation before
the shuffle); per-group orderings use the bucketed row numbering so a hot
session or user never sorts in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import money_avg, money_sum, round_half_up, safe_rate
from ..operators.windows import row_number_by_time, sessionize

# Time-of-day bands (start hours), business hours, lifecycle
# thresholds in days / sessions.
TIME_OF_DAY = [(5, "morning"), (12, "afternoon"), (17, "evening"), (21, "night")]
BUSINESS_HOURS = (9, 17)
NEW_MAX_DAYS, NEW_MAX_SESSIONS = 7, 3
AT_RISK_DAYS, CHURN_DAYS = 30, 60
LOYAL_MIN_SESSIONS, LOYAL_MIN_TENURE_DAYS = 20, 28


def time_of_day(hour: Column) -> Column:
    """night before 05:00 and from 21:00; morning 05-12; afternoon 12-17;
    evening 17-21."""
    out = F.when(hour < TIME_OF_DAY[0][0], F.lit("night"))
    for (start, label), (end, _) in zip(TIME_OF_DAY, TIME_OF_DAY[1:]):
        out = out.when(hour < end, F.lit(label))
    return out.otherwise(F.lit(TIME_OF_DAY[-1][1]))


def fact_time_features(fact: DataFrame) -> DataFrame:
    """Fact rows with hour, ISO weekday, weekend / business-hour flags,
    time of day, the event's position in its session and a first-event
    flag. The position is a row number per session computed per
    (session, minute) plus the count of the session's earlier minutes;
    events without a session or a time are kept without a position."""
    hour = F.hour("event_time")
    dow = F.weekday("event_time") + 1
    lo, hi = BUSINESS_HOURS
    f = fact.select("event_id", "event_time", "event_type", "user_sk", "user_session", "product_sk",
                    hour.alias("hour_of_day"), dow.alias("day_of_week"),
                    dow.isin(6, 7).alias("is_weekend"),
                    ((hour >= lo) & (hour < hi) & ~dow.isin(6, 7)).alias("is_business_hours"),
                    time_of_day(hour).alias("time_of_day"))
    n = row_number_by_time(f, "user_session", "event_time", "event_id", "event_number_in_session")
    return n.withColumn("is_first_event_in_session", F.coalesce(F.col("event_number_in_session") == 1, F.lit(False)))


def fact_sessions(fact: DataFrame) -> DataFrame:
    """One row per session id (``user_session``): timing, counts, breadth,
    mean gap between events ((last - first) / (events - 1), no lag needed),
    outcome, funnel stage, bounce flag, weekend flag, time of day. Events
    without a session id belong to no session and are left out here
    (``sessionless_events`` counts them per day)."""
    sec = F.unix_timestamp("event_time")

    def n(t):
        return F.sum(F.when(F.col("event_type") == t, 1).otherwise(0)).cast("long")

    agg = fact.filter(F.col("user_session").isNotNull()).groupBy(F.col("user_session").alias("session_id")).agg(
        F.min("user_sk").alias("user_sk"),
        F.min("event_date").alias("session_date"),
        F.min("event_time").alias("session_start_time"),
        F.max("event_time").alias("session_end_time"),
        (F.max(sec) - F.min(sec)).alias("session_duration_seconds"),
        F.count(F.lit(1)).alias("total_events"),
        n("view").alias("total_views"), n("cart").alias("total_carts"),
        n("purchase").alias("total_purchases"), n("remove_from_cart").alias("total_removals"),
        F.count_distinct(F.when(F.col("event_type") == "view", F.col("product_sk"))).alias("unique_products_viewed"),
        F.count_distinct(F.when(F.col("event_type") == "view", F.col("category_sk"))).alias("unique_categories_viewed"),
        money_sum(F.when(F.col("event_type") == "purchase", F.col("revenue")).otherwise(0.0)).alias("session_revenue"))
    gap = F.when(F.col("total_events") > 1,
                 round_half_up(F.col("session_duration_seconds") / (F.col("total_events") - 1), 2))
    stage = (F.when(F.col("total_purchases") > 0, "purchase")
             .when(F.col("total_carts") > 0, "cart").otherwise("view_only"))
    start_hour = F.hour("session_start_time")
    return agg.select(
        "*", gap.alias("avg_time_between_events_sec"),
        (F.col("total_purchases") > 0).alias("did_purchase"),
        (F.col("total_carts") > 0).alias("did_add_to_cart"),
        stage.alias("funnel_stage"),
        (F.col("total_events") == 1).alias("is_bounce_session"),
        (F.weekday("session_date") + 1).isin(6, 7).alias("is_weekend"),
        time_of_day(start_hour).alias("session_time_of_day"))


def sessionless_events(fact: DataFrame) -> DataFrame:
    """Per day: events that carry no session id."""
    return (fact.filter(F.col("user_session").isNull()).groupBy("event_date")
            .agg(F.count(F.lit(1)).alias("events"), F.count_distinct("user_sk").alias("users")))


def category_parents(categories: DataFrame) -> DataFrame:
    """Categories with ``parent_category_sk`` (the path one level up)."""
    parent_path = (F.when(F.col("category_depth") == 3, F.concat_ws(".", "category_l1", "category_l2"))
                   .when(F.col("category_depth") == 2, F.col("category_l1")))
    c = categories.select("category_sk", "category_l1", "category_l2", "category_l3", "category_full_path",
                          "category_depth", parent_path.alias("_parent_path"))
    p = categories.select(F.col("category_full_path").alias("_pp"), F.col("category_sk").alias("parent_category_sk"))
    return c.join(p, c["_parent_path"] == p["_pp"], "left").drop("_parent_path", "_pp")


def _as_of(fact: DataFrame, as_of) -> Column:
    if as_of is None:
        return fact.select(F.max("event_date")).scalar()
    return F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of


def user_lifecycle(fact: DataFrame, as_of=None) -> DataFrame:
    """new / active / loyal / at_risk / churned per user as of a date.
    Loyal (no numeric rule in the spec) = at least LOYAL_MIN_SESSIONS
    sessions over at least LOYAL_MIN_TENURE_DAYS days of tenure."""
    d = _as_of(fact, as_of)
    agg = fact.groupBy("user_sk").agg(
        F.min("event_date").alias("first_event_date"), F.max("event_date").alias("last_event_date"),
        F.count_distinct("user_session").alias("total_lifetime_sessions"),
        F.count(F.lit(1)).alias("total_lifetime_events"),
        money_sum("revenue").alias("total_lifetime_revenue"),
        F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).cast("long").alias("total_lifetime_purchases"))
    since_first = F.datediff(d, F.col("first_event_date"))
    since_last = F.datediff(d, F.col("last_event_date"))
    seg = (F.when(since_last > CHURN_DAYS, "churned")
           .when(since_last > AT_RISK_DAYS, "at_risk")
           .when((since_first < NEW_MAX_DAYS) & (F.col("total_lifetime_sessions") < NEW_MAX_SESSIONS), "new")
           .when((F.col("total_lifetime_sessions") >= LOYAL_MIN_SESSIONS)
                 & (since_first >= LOYAL_MIN_TENURE_DAYS), "loyal")
           .otherwise("active"))
    return agg.select("*", since_first.alias("days_since_first"), since_last.alias("days_since_last"),
                      seg.alias("customer_segment"))


def _favorite(df: DataFrame, key: str, col: str, out: str) -> DataFrame:
    """Most frequent non-null ``col`` per ``key`` (ties: smallest value).
    Counted per (key, value) first, so the ranking window sees at most one
    row per distinct value of the key."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(key, col).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(key).orderBy(F.desc("_n"), F.asc(col))
    ranked = counts.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
    return ranked.select(key, F.col(col).alias(out))


def user_favorites(fact: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Favourite top-level category and brand of each user (by events)."""
    f = (fact.join(categories.select("category_sk", "category_l1"), "category_sk", "left")
             .join(products.select("product_sk", "brand"), "product_sk", "left"))
    cat = _favorite(f, "user_sk", "category_l1", "favorite_category_l1")
    brand = _favorite(f, "user_sk", "brand", "favorite_brand")
    return cat.join(brand, "user_sk", "full_outer")


def _in_last(days: int, d: Column, lo_days: int = 0) -> Column:
    """event_date in (as_of - days, as_of - lo_days]; reads the ``_age``
    column (days before as_of) projected before the aggregate (a scalar
    subquery may not appear inside aggregate arguments)."""
    age = F.col("_age")
    return (age >= lo_days) & (age < days)


def _with_age(fact: DataFrame, d: Column) -> DataFrame:
    return fact.withColumn("_age", F.datediff(d, F.col("event_date")))


def user_behavior_features(fact: DataFrame, as_of=None) -> DataFrame:
    """Per-user rolling features as of a date: recency, 7/14/30-day events,
    sessions, revenue, purchases, conversion, AOV, favourite hour and
    weekday, weekend shopper flag and 7-day trend."""
    d = _as_of(fact, as_of)

    def cnt_if(cond: Column) -> Column:
        return F.sum(F.when(cond, 1).otherwise(0)).cast("long")

    def sess_if(cond: Column) -> Column:
        return F.count_distinct(F.when(cond, F.col("user_session")))

    def rev_if(cond: Column) -> Column:
        return money_sum(F.when(cond & (F.col("event_type") == "purchase"), F.col("revenue")).otherwise(0.0))

    purchase = F.col("event_type") == "purchase"
    agg = _with_age(fact, d).groupBy("user_sk").agg(
        F.min("_age").alias("recency_days"),
        cnt_if(_in_last(7, d)).alias("events_last_7d"),
        cnt_if(_in_last(14, d)).alias("events_last_14d"),
        cnt_if(_in_last(30, d)).alias("events_last_30d"),
        cnt_if(_in_last(14, d, 7)).alias("_events_prior_7d"),
        sess_if(_in_last(7, d)).alias("sessions_last_7d"),
        sess_if(_in_last(30, d)).alias("sessions_last_30d"),
        rev_if(_in_last(7, d)).alias("revenue_last_7d"),
        rev_if(_in_last(30, d)).alias("revenue_last_30d"),
        cnt_if(_in_last(30, d) & purchase).alias("purchases_last_30d"),
        money_avg(F.when(_in_last(30, d) & purchase, F.col("revenue"))).alias("avg_order_value_30d"),
        cnt_if((F.weekday("event_time") + 1).isin(6, 7)).alias("_weekend_events"),
        F.count(F.lit(1)).alias("_events"))
    fav_hour = _favorite(fact.withColumn("_h", F.hour("event_time")), "user_sk", "_h", "favorite_shopping_hour")
    fav_day = _favorite(fact.withColumn("_d", F.date_format("event_time", "EEEE")), "user_sk", "_d",
                        "preferred_day_of_week")
    out = agg.select(
        "user_sk", "recency_days", "events_last_7d", "events_last_14d", "events_last_30d",
        "sessions_last_7d", "sessions_last_30d", "revenue_last_7d", "revenue_last_30d",
        "purchases_last_30d",
        safe_rate("purchases_last_30d", "sessions_last_30d", scale=1.0).alias("conversion_rate_30d"),
        "avg_order_value_30d",
        (F.col("_weekend_events") * 2 > F.col("_events")).alias("is_weekend_shopper"),
        safe_rate("events_last_7d", "_events_prior_7d", scale=1.0).alias("trend_events_7d_vs_prior_7d"))
    return out.join(fav_hour, "user_sk", "left").join(fav_day, "user_sk", "left")


def product_features(fact: DataFrame, as_of=None) -> DataFrame:
    """Per-product lifetime and rolling metrics, conversion, prices seen,
    freshness and trend as of a date."""
    d = _as_of(fact, as_of)

    def cnt_if(cond: Column) -> Column:
        return F.sum(F.when(cond, 1).otherwise(0)).cast("long")

    view, cart, purchase = (F.col("event_type") == t for t in ("view", "cart", "purchase"))
    agg = _with_age(fact.filter(F.col("product_sk") != -1), d).groupBy("product_sk").agg(
        cnt_if(view).alias("total_views_lifetime"),
        cnt_if(cart).alias("total_cart_adds_lifetime"),
        cnt_if(purchase).alias("total_purchases_lifetime"),
        money_sum(F.when(purchase, F.col("revenue")).otherwise(0.0)).alias("total_revenue_lifetime"),
        cnt_if(view & _in_last(7, d)).alias("views_last_7d"),
        cnt_if(view & _in_last(30, d)).alias("views_last_30d"),
        cnt_if(view & _in_last(14, d, 7)).alias("_views_prior_7d"),
        cnt_if(purchase & _in_last(7, d)).alias("purchases_last_7d"),
        cnt_if(purchase & _in_last(30, d)).alias("purchases_last_30d"),
        money_sum(F.when(purchase & _in_last(7, d), F.col("revenue")).otherwise(0.0)).alias("revenue_last_7d"),
        money_sum(F.when(purchase & _in_last(30, d), F.col("revenue")).otherwise(0.0)).alias("revenue_last_30d"),
        money_avg(F.when(purchase, F.col("price_at_event"))).alias("avg_price_sold_at"),
        F.min("price_at_event").alias("min_price_seen"),
        F.max("price_at_event").alias("max_price_seen"),
        F.max_by("price_at_event", F.struct("event_time", "event_id")).alias("last_known_price"),
        F.min(F.when(view, F.col("_age"))).alias("days_since_last_view"),
        F.min(F.when(purchase, F.col("_age"))).alias("days_since_last_purchase"))
    trend = safe_rate("views_last_7d", "_views_prior_7d", scale=1.0)
    return agg.select(
        "product_sk", "total_views_lifetime", "total_cart_adds_lifetime", "total_purchases_lifetime",
        "total_revenue_lifetime", "views_last_7d", "views_last_30d", "purchases_last_7d",
        "purchases_last_30d", "revenue_last_7d", "revenue_last_30d",
        safe_rate("total_cart_adds_lifetime", "total_views_lifetime").alias("view_to_cart_rate_lifetime"),
        safe_rate("total_purchases_lifetime", "total_cart_adds_lifetime").alias("cart_to_purchase_rate_lifetime"),
        safe_rate("total_purchases_lifetime", "total_views_lifetime").alias("view_to_purchase_rate_lifetime"),
        "avg_price_sold_at", "min_price_seen", "max_price_seen", "last_known_price",
        "days_since_last_view", "days_since_last_purchase",
        (F.col("views_last_30d") > 0).alias("is_active_product"),
        trend.alias("trend_views_7d_vs_prior_7d"),
        F.coalesce(trend > 1, F.lit(False)).alias("is_trending"))


def incremental_sessions(history: DataFrame, new_events: DataFrame, user: str = "user_sk",
                         gap_s: int = 1800) -> DataFrame:
    """Session numbers for ``new_events`` and for those rows of the already
    sessionized ``history`` (which carries ``session_number``) whose number
    they change: late events may extend, join or precede known sessions.

    Only users present in the new batch are touched. Each is numbered anew
    from the session of the last historical event at or before the user's
    earliest new event (the first session if there is none); sessions before
    that keep their numbers. Events without user or time have no session."""
    early = new_events.groupBy(user).agg(F.min("event_time").alias("_new_from"))
    mine = history.select(user, "event_id", "event_time", "session_number").join(early, user)
    base = mine.groupBy(user).agg(
        F.coalesce(F.max(F.when(F.col("event_time") <= F.col("_new_from"), F.col("session_number"))), F.lit(1)).alias("_base"))
    redo = (mine.join(base, user).filter(F.col("session_number") >= F.col("_base"))
            .select(user, "event_id", "event_time", F.col("session_number").alias("_old")))
    rows = redo.unionByName(new_events.select(user, "event_id", "event_time", F.lit(None).cast("long").alias("_old")))
    s = sessionize(rows, user, "event_time", gap_s).join(base, user, "left")
    number = (F.col("session_number") + F.coalesce(F.col("_base"), F.lit(1)) - 1).cast("long")
    return (s.withColumn("session_number", number)
             .filter(F.col("_old").isNull() | (F.col("_old") != F.col("session_number")))
             .select(user, "event_id", "event_time", "session_number"))


def dim_date_fiscal(dates: DataFrame, fiscal_start_month: int = 7) -> DataFrame:
    """Calendar plus fiscal year / quarter / month for a fiscal year that
    starts in ``fiscal_start_month`` (named by the calendar year it ends
    in)."""
    m = F.col("month")
    fm = ((m - fiscal_start_month + 12) % 12) + 1
    fy = F.col("year") + F.when(m >= fiscal_start_month, 1 if fiscal_start_month > 1 else 0).otherwise(0)
    return dates.select("*", fy.cast("int").alias("fiscal_year"),
                        (F.floor((fm - 1) / 3) + 1).cast("int").alias("fiscal_quarter"),
                        fm.cast("int").alias("fiscal_month"))

