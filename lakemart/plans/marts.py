"""Gold marts: daily, user, product, category, brand, funnel, session,
cohort. Each builder takes the fact (or its stored cells, see
``reduce_cells``) and dimension frames and returns one DataFrame. Every mart ends with ``created_at``; pass
``load_ts`` for a repeatable value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import MONEY_TYPE, TOTAL_TYPE, money, ratio_avg, round_half_up, safe_rate, total_avg, total_sum
from ..operators.joins import UNKNOWN_SK
from ..operators.windows import dense_rank_in, medians_in, number_session_buckets
from ..session import checkpoint_dir

DATE_ATTRS = ["date_key", "full_date", "year", "quarter", "month", "month_name",
              "day_of_month", "day_name", "day_of_week", "is_weekend"]


def _ts(load_ts):
    return (load_ts if load_ts is not None else F.current_timestamp()).alias("created_at")


SESSION_GAP_S = 1800
#: What a cell is counted by, and the marts' measures that cells add up to.
CELL_KEYS = ["event_date", "date_sk", "user_sk", "product_sk", "category_sk", "bucket"]


def as_cells(fact: DataFrame, gap_s: int = SESSION_GAP_S) -> DataFrame:
    """Every event as a cell of its own (a projection, no shuffle), so that
    the marts are written once for events and for reduced cells. Cells are
    returned as they are."""
    if "n" in fact.columns:
        return fact

    def one(t: str) -> Column:
        return (F.col("event_type") == t).cast("long")
    sec = F.unix_timestamp("event_time")
    purchase = F.col("event_type") == "purchase"
    day = F.col("event_date") if "event_date" in fact.columns else F.to_date("event_time").alias("event_date")
    return fact.select(
        day, "date_sk", "user_sk", "product_sk", "category_sk", F.floor(sec / gap_s).alias("bucket"),
        F.lit(1).cast("long").alias("n"),
        *[F.coalesce(one(t), F.lit(0).cast("long")).alias(c) for t, c in (("view", "views"), ("cart", "carts"), ("remove_from_cart", "removes"), ("purchase", "purchases"))],
        money("revenue").alias("all_revenue"),
        F.when(purchase, money("revenue")).otherwise(F.lit(0).cast(MONEY_TYPE)).alias("revenue"),
        (purchase & F.col("revenue").isNotNull()).cast("long").alias("paid"),
        F.when(purchase, F.col("quantity")).otherwise(F.lit(0)).cast("long").alias("sold"),
        F.col("event_time").alias("first_time"), F.col("event_time").alias("last_time"))


def reduce_cells(fact: DataFrame, gap_s: int = SESSION_GAP_S) -> DataFrame:
    """Events added up per day, user, product, category and session-gap
    bucket (partial aggregation before the shuffle). Cells of a day depend on
    that day's events alone, so they can be stored and replaced by the day;
    distinct users, products and days stay exact, since they are keys."""
    return as_cells(fact, gap_s).groupBy(*CELL_KEYS).agg(
        *[F.sum(c).alias(c) for c in ("n", "views", "carts", "removes", "purchases")],
        F.sum("all_revenue").alias("all_revenue"), F.sum("revenue").alias("revenue"), F.sum("paid").alias("paid"), F.sum("sold").alias("sold"),
        F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"))


def _total(col: str) -> Column:
    return F.sum(col).cast("long")


def _type_counts() -> list:
    return [_total(c).alias(a) for c, a in (("n", "total_events"), ("views", "total_views"), ("carts", "total_carts"),
                                            ("removes", "total_removes"), ("purchases", "total_purchases"))]


def _revenue(col: str = "revenue") -> Column:
    return F.round(F.sum(col), 2).cast("double")


def _order_value() -> Column:
    return ratio_avg(F.sum("revenue"), F.sum("paid"))


def _rates() -> list:
    return [safe_rate("total_carts", "total_views").alias("view_to_cart_rate"),
            safe_rate("total_purchases", "total_carts").alias("cart_to_purchase_rate"),
            safe_rate("total_purchases", "total_views").alias("view_to_purchase_rate"),
            safe_rate("total_revenue", "total_views", scale=1.0).alias("revenue_per_view")]


TYPES = {"view": "views", "cart": "carts", "purchase": "purchases"}


def _distincts(rows: DataFrame, keys: list[str], col: str, **names: str) -> DataFrame:
    """Distinct non-null values of ``col`` per ``keys``: over all rows
    (``any=`` column name) and over the rows of an event type. Rows are
    reduced to (keys, col) before the shuffle, so counts are row counts and
    no event is expanded per measure."""
    flags = [F.max(F.col(c) > 0).alias(f"_{t}") for t, c in TYPES.items() if t in names]
    per = rows.groupBy(*keys, col).agg(*(flags or [F.count(F.lit(1)).alias("_n")]))
    have = F.col(col).isNotNull()
    out = [F.count_if(have if k == "any" else have & F.coalesce(F.col(f"_{k}"), F.lit(False))).alias(n) for k, n in names.items()]
    return per.groupBy(*keys).agg(*out)


def _beside(base: DataFrame, keys: list[str], *sides: DataFrame) -> DataFrame:
    """``base`` with the columns of ``sides``, joined on ``keys`` (NULL
    equals NULL; all have the same keys)."""
    for i, side in enumerate(sides):
        s = side.select(*[F.col(k).alias(f"_{i}_{k}") for k in keys], *[c for c in side.columns if c not in keys])
        base = base.join(s, reduce(lambda x, y: x & y, [base[k].eqNullSafe(s[f"_{i}_{k}"]) for k in keys])).drop(*[f"_{i}_{k}" for k in keys])
    return base


def _users(rows: DataFrame, keys: list[str]) -> DataFrame:
    return _distincts(rows, keys, "user_sk", any="unique_users_interacted", view="unique_viewers", cart="unique_carts",
                      purchase="unique_purchasers")


def _days(rows: DataFrame, keys: list[str]) -> DataFrame:
    return _distincts(rows, keys, "date_sk", any="days_active")


def _seen() -> list:
    return [F.min("first_time").alias("first_event_date"), F.max("last_time").alias("last_event_date")]


def gold_daily(fact: DataFrame, dates: DataFrame, users: DataFrame, load_ts=None) -> DataFrame:
    """Daily KPIs: active users, events by type, revenue, AOV, conversion
    rates, distinct products / categories, active users per segment.

    The fact's user keys come from ``users`` (or are -1 when unresolved,
    which the inner join of the mart drops), so the per-day measures are
    aggregated straight from the fact on the narrow ``date_sk`` key; only
    the distinct (day, user) pairs meet the user dimension for the segment
    counts, instead of shuffling every event against it. Calendar
    attributes are joined to the ~one-row-per-day results."""
    f = as_cells(fact).filter(F.col("user_sk") != UNKNOWN_SK)
    agg = f.groupBy("date_sk").agg(
        *_type_counts(),
        _revenue("all_revenue").alias("total_revenue"),
        _order_value().alias("avg_order_value"),
        _total("sold").alias("total_quantity_sold"),
    )
    agg = _beside(agg, ["date_sk"],
                  _distincts(f, ["date_sk"], "product_sk", any="unique_products_viewed", purchase="unique_products_sold"),
                  _distincts(f, ["date_sk"], "category_sk", any="unique_categories_active"))
    day_users = f.select("date_sk", "user_sk").distinct().join(users.select("user_sk", "user_segment"), "user_sk")

    def seg_users(s):
        return F.count_if(F.col("user_segment") == s)

    segs = day_users.groupBy("date_sk").agg(
        F.count(F.lit(1)).alias("daily_active_users"),
        seg_users("power_user").alias("dau_power_users"),
        seg_users("engaged").alias("dau_engaged"),
        seg_users("casual").alias("dau_casual"),
    )
    cal = F.broadcast(dates.select(*DATE_ATTRS))
    return agg.join(segs, "date_sk").join(cal, F.col("date_sk") == cal.date_key).select(
        *DATE_ATTRS, "daily_active_users", "total_events", "total_views", "total_carts",
        "total_removes", "total_purchases", "total_revenue", "avg_order_value",
        "total_quantity_sold",
        safe_rate("total_carts", "total_views").alias("view_to_cart_rate"),
        safe_rate("total_purchases", "total_carts").alias("cart_to_purchase_rate"),
        safe_rate("total_purchases", "total_views").alias("overall_conversion_rate"),
        "unique_products_viewed", "unique_products_sold", "unique_categories_active",
        "dau_power_users", "dau_engaged", "dau_casual", _ts(load_ts))


def gold_user(fact: DataFrame, users: DataFrame, as_of=None, load_ts=None) -> DataFrame:
    """Per current user version: activity, lifetime revenue, recency as of
    ``as_of`` (default: the last event date in the fact), conversion,
    breadth."""
    if as_of is None:
        as_of = fact.select(F.max("event_date")).scalar()
    elif isinstance(as_of, str):
        as_of = F.lit(as_of).cast("date")
    cur = users.filter(F.col("is_current_version")).select("user_sk", "user_id", "user_segment")
    # aggregate on user_sk, then keep current versions (join after: the
    # user dimension meets one row per user instead of every event)
    fact = as_cells(fact)
    agg = fact.groupBy("user_sk").agg(
        *_type_counts(),
        _revenue("all_revenue").alias("lifetime_revenue"),
        _order_value().alias("avg_order_value"),
        _total("sold").alias("total_quantity_purchased"),
        *_seen(),
        F.max(F.to_date("last_time")).alias("_last_day"),
    )
    k = ["user_sk"]
    agg = _beside(agg, k, _days(fact, k),
                  _distincts(fact, k, "product_sk", any="unique_products_viewed", purchase="unique_products_purchased"),
                  _distincts(fact, k, "category_sk", any="unique_categories_browsed")).join(cur, "user_sk")
    return agg.select(
        "user_sk", "user_id", "user_segment", "total_events", "total_views", "total_carts",
        "total_removes", "total_purchases", "lifetime_revenue", "avg_order_value",
        "total_quantity_purchased", "first_event_date", "last_event_date",
        F.datediff("last_event_date", "first_event_date").alias("days_between_first_last"),
        "days_active",
        F.datediff(as_of, F.col("_last_day")).alias("recency_days"),
        F.col("total_purchases").alias("frequency_purchases"),
        safe_rate("total_purchases", "total_views").alias("personal_conversion_rate"),
        "unique_products_viewed", "unique_products_purchased", "unique_categories_browsed",
        _ts(load_ts))


def gold_product(fact: DataFrame, products: DataFrame, categories: DataFrame, load_ts=None) -> DataFrame:
    """Per current product version: counts, revenue, users, prices, rates,
    dense ranks inside the top-level category."""
    p = products.filter(F.col("is_current_version")).select("product_sk", "product_id", "brand", "price")
    c = categories.select("category_sk", F.col("category_full_path").alias("category_code"),
                          "category_l1", "category_l2")
    # aggregate on the fact's keys (category_sk follows from the product
    # version), then attach the product / category attributes
    fact, k = as_cells(fact), ["product_sk", "category_sk"]
    per = fact.groupBy(*k).agg(
        *_type_counts(),
        _revenue().alias("total_revenue"),
        _order_value().alias("avg_revenue_per_purchase"),
        _total("sold").alias("total_quantity_sold"),
        *_seen(),
    )
    per = _beside(per, k, _users(fact, k), _days(fact, k))
    agg = per.join(p, "product_sk").join(c, "category_sk").select(
        "product_sk", "product_id", "brand", "category_code", "category_l1", "category_l2",
        "total_events", "total_views", "total_carts", "total_removes", "total_purchases",
        "total_revenue", "avg_revenue_per_purchase", "total_quantity_sold",
        "unique_users_interacted", "unique_viewers", "unique_carts", "unique_purchasers",
        "first_event_date", "last_event_date", "days_active",
        F.col("price").alias("current_price"), F.col("price").alias("min_price_seen"),
        F.col("price").alias("max_price_seen"))
    # one row per product: aggregated once, then ranked without sorting a
    # whole top-level category in one task
    checkpoint_dir(fact.sparkSession)
    agg = agg.checkpoint(eager=True)
    ranked = dense_rank_in(agg, "category_l1", "total_revenue", "rank_in_category_by_revenue")
    ranked = dense_rank_in(ranked, "category_l1", "total_purchases", "rank_in_category_by_purchases")
    return ranked.select(*agg.columns, *_rates(), "rank_in_category_by_revenue", "rank_in_category_by_purchases", _ts(load_ts))


def gold_category(fact: DataFrame, categories: DataFrame, load_ts=None) -> DataFrame:
    """Per category: counts, revenue, products, users, rates, revenue share
    inside the top-level category and dense ranks."""
    keys = ["category_sk", "category_l1", "category_l2", "category_l3", "category_full_path",
            "category_depth"]
    fact = as_cells(fact)
    per = fact.groupBy("category_sk").agg(
        *_type_counts(),
        _revenue().alias("total_revenue"),
        _order_value().alias("avg_revenue_per_purchase"),
        _total("sold").alias("total_quantity_sold"),
        *_seen(),
    )
    k = ["category_sk"]
    per = _beside(per, k, _distincts(fact, k, "product_sk", any="unique_products", purchase="products_purchased"),
                  _users(fact, k), _days(fact, k))
    agg = per.join(categories.select(*keys), "category_sk").select(*keys, *[c for c in per.columns
                                                                             if c != "category_sk"])
    l1 = Window.partitionBy("category_l1")
    share = round_half_up(F.col("total_revenue") * 100.0
                    / F.nullif(F.sum("total_revenue").over(l1), F.lit(0.0)), 2)
    return agg.select(
        "*", *_rates(),
        share.alias("revenue_share_within_l1"),
        F.dense_rank().over(Window.orderBy(F.desc("total_revenue"))).alias("overall_rank_by_revenue"),
        F.dense_rank().over(l1.orderBy(F.desc("total_revenue"))).alias("rank_within_l1_by_revenue"),
        _ts(load_ts))


def gold_brand(fact: DataFrame, products: DataFrame, categories: DataFrame, load_ts=None) -> DataFrame:
    """Per brand (current product versions): counts, portfolio, category
    breadth, users, price range (event weighted), market share, ranks."""
    p = products.filter(F.col("is_current_version")).select("product_sk", "brand", "price")
    c = categories.select("category_sk", "category_l1")
    f = as_cells(fact).join(p, "product_sk").join(c, "category_sk")
    agg = f.groupBy("brand").agg(
        *_type_counts(),
        _revenue().alias("total_revenue"),
        _order_value().alias("avg_revenue_per_purchase"),
        _total("sold").alias("total_quantity_sold"),
        *_seen(),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        ratio_avg(F.sum(money("price") * F.col("n")), F.sum(F.when(F.col("price").isNotNull(), F.col("n")))).alias("avg_price"),
    )
    k = ["brand"]
    agg = _beside(agg, k, _distincts(f, k, "product_sk", any="unique_products", purchase="products_purchased"),
                  _distincts(f, k, "category_l1", any="categories_l1_count"), _distincts(f, k, "category_sk", any="total_categories"),
                  _users(f, k), _days(f, k))
    everything = Window.partitionBy()
    share = round_half_up(F.col("total_revenue") * 100.0
                    / F.nullif(F.sum("total_revenue").over(everything), F.lit(0.0)), 2)
    return agg.select(
        "*", *_rates(),
        share.alias("revenue_market_share"),
        F.dense_rank().over(Window.orderBy(F.desc("total_revenue"))).alias("rank_by_revenue"),
        F.dense_rank().over(Window.orderBy(F.desc("unique_products"))).alias("rank_by_product_count"),
        _ts(load_ts))


def gold_funnel(fact: DataFrame, products: DataFrame, categories: DataFrame, dates: DataFrame,
                load_ts=None) -> DataFrame:
    """Per day x L1 x L2: funnel users and events, user / event rates,
    drop-offs, abandonment, cart removal and revenue per stage user."""
    p = products.filter(F.col("is_current_version")).select("product_sk")
    c = categories.select("category_sk", "category_l1", "category_l2")
    d = F.broadcast(dates.select("date_key", "full_date"))
    f = as_cells(fact).join(p, "product_sk").join(c, "category_sk")
    k = ["date_sk", "category_l1", "category_l2"]
    agg = f.groupBy(*k).agg(*_type_counts()[1:], _revenue().alias("total_revenue"))
    agg = _beside(agg, k, _distincts(f, k, "user_sk", view="users_viewed", cart="users_carted", purchase="users_purchased"),
                  _distincts(f, k, "product_sk", any="unique_products_in_funnel"))
    agg = agg.join(d, agg.date_sk == d.date_key).select("date_sk", "full_date", *[
        x for x in agg.columns if x != "date_sk"])
    uv, uc, up = F.col("users_viewed"), F.col("users_carted"), F.col("users_purchased")
    return agg.select(
        "*",
        safe_rate(uc, uv).alias("view_to_cart_user_rate"),
        safe_rate(up, uc).alias("cart_to_purchase_user_rate"),
        safe_rate(up, uv).alias("overall_conversion_user_rate"),
        safe_rate("total_carts", "total_views").alias("view_to_cart_event_rate"),
        safe_rate("total_purchases", "total_carts").alias("cart_to_purchase_event_rate"),
        safe_rate("total_purchases", "total_views").alias("overall_conversion_event_rate"),
        (uv - uc).alias("users_dropped_at_cart"),
        (uc - up).alias("users_dropped_at_purchase"),
        safe_rate(uv - uc, uv).alias("cart_abandonment_rate"),
        safe_rate(uc - up, uc).alias("purchase_abandonment_rate"),
        safe_rate("total_removes", "total_carts").alias("cart_removal_rate"),
        safe_rate("total_revenue", uv, scale=1.0).alias("revenue_per_viewer"),
        safe_rate("total_revenue", up, scale=1.0).alias("revenue_per_purchaser"),
        _ts(load_ts))


def session_rows(fact: DataFrame, gap_s: int = SESSION_GAP_S) -> DataFrame:
    """One row per (user, session, date): timing, counts, outcome flags,
    revenue, distinct products / categories. Sessions crossing midnight
    give one row per date, as the daily mart expects.

    Everything comes from the cells (``reduce_cells`` with buckets as wide as
    the gap; given cells must have been reduced so): sessions are numbered
    from their (user, bucket) bounds (``number_session_buckets``), then rolled
    up, and products and categories are counted as reduced rows."""
    unused = {"event_date": F.to_date("event_time"), "quantity": F.lit(0)}  # in cells, but not needed here
    if "n" in fact.columns:
        cells = fact
    else:
        cells = reduce_cells(fact.withColumns({c: v for c, v in unused.items() if c not in fact.columns}), gap_s)
    cells = cells.withColumns({"_smin": F.unix_timestamp("first_time"), "_smax": F.unix_timestamp("last_time")})
    numbers = number_session_buckets(
        cells.groupBy("user_sk", "bucket").agg(F.min("_smin").alias("_first"), F.max("_smax").alias("_last")),
        "user_sk", gap_s, first="_first", last="_last", bkt="bucket")
    keys = ["user_sk", "session_number", "date_sk"]
    rows = cells.join(numbers, ["user_sk", "bucket"])
    sessions = rows.groupBy(*keys).agg(
        F.min("first_time").alias("session_start"),
        F.max("last_time").alias("session_end"),
        ((F.max("_smax") - F.min("_smin")) / 60.0).alias("session_duration_minutes"),
        _total("n").alias("total_events_in_session"),
        _total("views").alias("views_in_session"),
        _total("carts").alias("carts_in_session"),
        _total("purchases").alias("purchases_in_session"),
        F.max(F.when(F.col("carts") > 0, 1).otherwise(0)).alias("had_cart_action"),
        F.max(F.when(F.col("purchases") > 0, 1).otherwise(0)).alias("had_purchase"),
        _revenue().alias("session_revenue"))
    return _beside(sessions, keys, _distincts(rows, keys, "product_sk", any="unique_products_in_session"),
                   _distincts(rows, keys, "category_sk", any="unique_categories_in_session"))


def gold_session(fact: DataFrame, dates: DataFrame, gap_s: int = 1800, load_ts=None) -> DataFrame:
    """Per day: sessions, users, duration avg / exact median / max, events,
    outcomes, revenue and engagement buckets."""
    checkpoint_dir(fact.sparkSession)
    sa = session_rows(fact, gap_s).checkpoint(eager=True)  # read twice: daily sums and medians
    d = F.broadcast(dates.select("date_key", "full_date"))
    j = sa.join(d, sa.date_sk == F.col("date_key"))
    n = F.col("total_events_in_session")
    agg = j.groupBy("date_sk", "full_date").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.count_distinct("user_sk").alias("unique_users_with_sessions"),
        round_half_up(F.avg("session_duration_minutes"), 2).alias("avg_session_duration_minutes"),
        F.max("session_duration_minutes").alias("max_session_duration_minutes"),
        round_half_up(F.avg(n), 2).alias("avg_events_per_session"),
        round_half_up(F.avg("views_in_session"), 2).alias("avg_views_per_session"),
        round_half_up(F.avg("unique_products_in_session"), 2).alias("avg_products_per_session"),
        F.sum("had_cart_action").cast("long").alias("sessions_with_cart"),
        F.sum("had_purchase").cast("long").alias("sessions_with_purchase"),
        total_sum("session_revenue").alias("total_session_revenue"),
        total_avg(F.when(F.col("had_purchase") == 1, F.col("session_revenue")))
         .alias("avg_revenue_per_converting_session"),
        F.sum(F.when(n == 1, 1).otherwise(0)).cast("long").alias("single_event_sessions"),
        F.sum(F.when(n.between(2, 5), 1).otherwise(0)).cast("long").alias("low_engagement_sessions"),
        F.sum(F.when(n.between(6, 15), 1).otherwise(0)).cast("long").alias("medium_engagement_sessions"),
        F.sum(F.when(n > 15, 1).otherwise(0)).cast("long").alias("high_engagement_sessions"),
    )
    medians = medians_in(sa, "date_sk", "session_duration_minutes", "_median").withColumnRenamed("date_sk", "_day")
    agg = agg.join(medians, F.col("date_sk") == F.col("_day"), "left").withColumn(
        "median_session_duration_minutes", round_half_up("_median", 2))
    return agg.select(
        "date_sk", "full_date", "total_sessions", "unique_users_with_sessions",
        "avg_session_duration_minutes", "median_session_duration_minutes",
        "max_session_duration_minutes", "avg_events_per_session", "avg_views_per_session",
        "avg_products_per_session", "sessions_with_cart", "sessions_with_purchase",
        safe_rate("sessions_with_cart", "total_sessions").alias("pct_sessions_with_cart"),
        safe_rate("sessions_with_purchase", "total_sessions").alias("pct_sessions_with_purchase"),
        "total_session_revenue", "avg_revenue_per_converting_session",
        "single_event_sessions", "low_engagement_sessions", "medium_engagement_sessions",
        "high_engagement_sessions", _ts(load_ts))


def user_months(fact: DataFrame, user: str = "user_sk", by: tuple = ()) -> DataFrame:
    """Per user and month of activity (and ``by``): distinct event times of
    views, carts and purchases, and revenue. Events are reduced to (user,
    type, time) first, so no event is expanded per measure; a time lies in
    one day, so counts by day add up to counts by month. Rows that are such
    counts already are added up."""
    if "activity_month" in fact.columns:
        rows = fact
    else:
        money_of = F.when(F.col("event_type") == "purchase", money("revenue")).otherwise(F.lit(0).cast(MONEY_TYPE))
        times = fact.groupBy(user, *by, "event_type", "event_time").agg(F.sum(money_of).alias("revenue"))
        known = F.col("event_time").isNotNull()
        rows = times.select(user, *by, F.date_trunc("MONTH", F.col("event_time")).alias("activity_month"), "revenue",
                            *[F.coalesce((known & (F.col("event_type") == t)).cast("long"), F.lit(0).cast("long")).alias(c) for t, c in TYPES.items()])
    return rows.groupBy(user, *by, "activity_month").agg(*[_total(c).alias(c) for c in TYPES.values()], F.sum("revenue").alias("revenue"))


def gold_cohort(fact: DataFrame, user: str = "user_sk", load_ts=None) -> DataFrame:
    """Monthly acquisition cohorts (month of first event): active users,
    activity, revenue, retention, cumulative revenue and LTV per period.

    View / cart / purchase counts are distinct event times per user-month,
    as the mart defines them (``user_months``, also from stored rows of it);
    the cohort month is the smallest month of each user, taken by a window
    over the user's months (one row per active month, so a hot user stays
    small) — no join of events to a per-user table."""
    ua = (user_months(fact, user).withColumn("revenue", F.round("revenue", 2).cast("double"))
          .withColumn("cohort_month", F.min("activity_month").over(Window.partitionBy(user))))
    periods = F.months_between("activity_month", "cohort_month").cast("int")
    # one row per (user, month): row counts are distinct user counts
    cm = ua.groupBy("cohort_month", periods.alias("periods_since_cohort"), "activity_month").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        F.count(F.lit(1)).alias("active_users"),
        F.sum("views").cast("long").alias("total_views"),
        F.sum("carts").cast("long").alias("total_carts"),
        F.sum("purchases").cast("long").alias("total_purchases"),
        total_sum("revenue").alias("period_revenue"),
        round_half_up(F.avg("views"), 2).alias("avg_views_per_user"),
        total_avg("revenue").alias("avg_revenue_per_user"),
    )
    size = (ua.filter(F.col("activity_month") == F.col("cohort_month"))
              .groupBy("cohort_month").agg(F.count(F.lit(1)).alias("total_cohort_users")))
    w = (Window.partitionBy("cohort_month").orderBy("periods_since_cohort")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cum = F.sum(F.col("period_revenue").cast(TOTAL_TYPE)).over(w)
    return cm.join(size, "cohort_month").select(
        "cohort_month", "periods_since_cohort", "activity_month", "cohort_size", "active_users",
        "total_views", "total_carts", "total_purchases", "period_revenue", "avg_views_per_user",
        "avg_revenue_per_user", "total_cohort_users",
        safe_rate("active_users", "total_cohort_users").alias("retention_rate"),
        F.round(cum, 2).cast("double").alias("cumulative_revenue"),
        F.round(cum / F.col("total_cohort_users"), 2).cast("double").alias("ltv_to_date"),
        _ts(load_ts))
