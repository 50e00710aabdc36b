"""Report queries over bronze, the star schema and the marts.

Each report is ``filter -> (join) -> groupBy/agg -> orderBy(..., tie) ->
limit`` with window functions where the report ranks or shares. Every
ORDER BY that feeds a LIMIT or a row number ends with a unique tie-break,
so results are deterministic. Thresholds are parameters (defaults are
the mart definitions)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import (count_of, ltv_tier, money, money_avg, money_sum, ratio_avg, round_half_up as rhu, total_avg, total_sum,
                                 safe_rate)
from ..operators.windows import ntiles_global, running_total, top_n

RAW_COLUMNS = ["event_time", "event_type", "product_id", "category_id", "category_code", "brand",
               "price", "user_id", "user_session"]


# --- exploration over bronze ---------------------------------------------

def event_total_count(bronze: DataFrame) -> DataFrame:
    return bronze.agg(F.count(F.lit(1)).alias("total_events"))


def event_type_distribution(bronze: DataFrame) -> DataFrame:
    per = bronze.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))
    pct = rhu(F.col("event_count") * 100.0 / F.sum("event_count").over(Window.partitionBy()))
    return per.withColumn("percentage", pct)


def day_breakdown(bronze: DataFrame, day: str) -> DataFrame:
    """One day by type; the equality on the partition column prunes every
    other day's files when bronze is stored partitioned by event_date."""
    return (bronze.filter(F.col("event_date") == F.lit(day).cast("date"))
            .groupBy("event_date", "event_type").agg(F.count(F.lit(1)).alias("event_count")))


def events_per_day(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy(F.to_date("event_time").alias("date")).agg(F.count(F.lit(1)).alias("events"))


def time_range(bronze: DataFrame) -> DataFrame:
    lo, hi = F.min("event_time"), F.max("event_time")
    days = F.floor((F.unix_micros(hi) - F.unix_micros(lo)) / F.lit(86400 * 1000000))
    return bronze.agg(lo.alias("earliest_event"), hi.alias("latest_event"),
                      days.cast("long").alias("duration_days"))


def session_duplicate_ratio(bronze: DataFrame) -> DataFrame:
    out = bronze.agg(F.count_distinct("user_session").alias("unique_sessions"),
                     F.count(F.lit(1)).alias("total_rows"))
    return out.withColumn("duplicate_ratio", rhu((F.col("total_rows") - F.col("unique_sessions")) * 100.0
                                                 / F.col("total_rows")))


def cardinalities(bronze: DataFrame) -> DataFrame:
    """Distinct values (NULL is one) of five columns: each column is reduced
    to its values first, then counted; no row is expanded per column."""
    counts = [bronze.select(c).distinct().select(F.count(F.lit(1))).scalar().alias(f"unique_{n}")
              for c, n in [("product_id", "products"), ("category_id", "categories"), ("brand", "brands"),
                           ("user_id", "users"), ("user_session", "sessions")]]
    return bronze.sparkSession.range(1).select(*counts)


def top_values(bronze: DataFrame, col: str, n: int = 10) -> DataFrame:
    """Top ``n`` non-null values of ``col`` by event count."""
    return (bronze.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(col)).limit(n))


def events_per_user_stats(bronze: DataFrame) -> DataFrame:
    per = bronze.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.min("n").alias("min_events"), F.max("n").alias("max_events"),
                   rhu(F.avg("n")).alias("avg_events"),
                   rhu(F.percentile("n", 0.5), 6).alias("median_events"))


def user_level_funnel(bronze: DataFrame) -> DataFrame:
    def users(t):
        return F.count_distinct(F.when(F.col("event_type") == t, F.col("user_id")))
    out = bronze.agg(users("view").alias("users_viewed"), users("cart").alias("users_carted"),
                     users("purchase").alias("users_purchased"))
    return out.select("*", safe_rate("users_carted", "users_viewed").alias("cart_pct_of_viewers"),
                      safe_rate("users_purchased", "users_viewed").alias("purchase_pct_of_viewers"))


def price_statistics(bronze: DataFrame, exact: bool = True) -> DataFrame:
    """Bounds, mean, median and 95th percentile of the price. Exact
    percentiles come from running counts over the distinct prices (range-
    partitioned, see ``running_total``), not from one task's buffer;
    ``exact=False`` takes ``percentile_approx``."""
    base = [F.min("price").alias("min_price"), F.max("price").alias("max_price"), money_avg("price", 6).alias("avg_price")]
    if not exact:
        return bronze.agg(*base, rhu(F.percentile_approx("price", F.lit(0.5)), 6).alias("median_price"),
                          rhu(F.percentile_approx("price", F.lit(0.95)), 6).alias("p95_price"))
    counts = bronze.filter(F.col("price").isNotNull()).groupBy("price").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_total(counts, "price", "n", "upto")
    total = ranked.select(F.max("upto")).scalar()

    def at(rank):  # the price at a 0-based rank
        return ranked.filter(F.col("upto") > rank).select(F.min("price")).scalar()

    def pct(p):
        place = p * (total - 1)
        low = F.floor(place)
        lo, hi = at(low), at(F.ceil(place))
        return rhu(lo + (hi - lo) * (place - low), 6)
    return bronze.agg(*base).select("*", pct(0.5).alias("median_price"), pct(0.95).alias("p95_price"))


def purchase_revenue_summary(bronze: DataFrame) -> DataFrame:
    return (bronze.filter(F.col("event_type") == "purchase")
            .agg(money_sum("price").alias("total_revenue"), F.count(F.lit(1)).alias("total_purchases"),
                 money_avg("price").alias("avg_order_value")))


# --- star-schema reports ---------------------------------------------------

def monthly_revenue_by_brand(fact, dates, products, year: int) -> DataFrame:
    """Purchases and revenue per month and brand for one year. The calendar
    is joined on the date itself (the fact's partition column), so the year
    filter prunes fact partitions at run time (dynamic partition pruning)."""
    f = (fact.filter(F.col("event_type") == "purchase")
         .join(F.broadcast(dates.select("full_date", "year", "month", "month_name")),
               fact.event_date == F.col("full_date"))
         .filter(F.col("year") == year)
         .join(products.select("product_sk", "brand"), "product_sk"))
    return (f.groupBy("year", "month_name", "month", "brand")
            .agg(money_sum("revenue").alias("total_revenue"), F.count(F.lit(1)).alias("purchases"))
            .drop("month"))


def monthly_buyers_by_brand(fact, dates, products, year: int) -> DataFrame:
    """``monthly_revenue_by_brand`` with distinct buyers: (month, brand,
    user) first, then buyers are a row count."""
    f = (fact.filter(F.col("event_type") == "purchase")
         .join(F.broadcast(dates.select("full_date", "year", "month", "month_name")),
               fact.event_date == F.col("full_date"))
         .filter(F.col("year") == year)
         .join(products.select("product_sk", "brand"), "product_sk"))
    per = (f.groupBy("year", "month_name", "month", "brand", "user_sk")
           .agg(F.sum(money("revenue")).alias("r"), F.count(F.lit(1)).alias("n")))
    return (per.groupBy("year", "month_name", "month", "brand")
            .agg(F.count("user_sk").alias("unique_buyers"), F.round(F.sum("r"), 2).cast("double").alias("total_revenue"),
                 F.sum("n").cast("long").alias("total_purchases")).drop("month"))


def segment_behavior(fact, users) -> DataFrame:
    """Per segment: users, events, average price, purchases, revenue; one
    row per user first, so users are a row count."""
    per = fact.groupBy("user_sk").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("price_at_event")).alias("p"), F.count("price_at_event").alias("pn"),
        count_of("purchase").alias("b"), F.sum(money("revenue")).alias("r"))
    f = per.join(users.select("user_sk", "user_segment"), "user_sk")
    return f.groupBy("user_segment").agg(
        F.count("user_sk").alias("users_count"), F.sum("n").cast("long").alias("total_events"),
        ratio_avg(F.sum("p"), F.sum("pn")).alias("avg_product_price"), F.sum("b").cast("long").alias("purchases"),
        F.round(F.sum("r"), 2).cast("double").alias("total_revenue"))


def category_by_weekday_all(fact, dates, categories) -> DataFrame:
    """All events per ISO weekday and top-level category."""
    f = (fact.join(F.broadcast(dates.select("date_key", "day_of_week", "is_weekend")), fact.date_sk == F.col("date_key"))
         .join(categories.select("category_sk", "category_l1").filter(F.col("category_l1").isNotNull()), "category_sk"))
    return f.groupBy("day_of_week", "is_weekend", "category_l1").agg(
        F.count(F.lit(1)).alias("events"), count_of("purchase").alias("purchases"), money_sum("revenue").alias("revenue"))


def user_segment_performance(fact, users) -> DataFrame:
    f = fact.join(users.select("user_sk", "user_segment"), "user_sk")
    return f.groupBy("user_segment").agg(F.count_distinct("user_sk").alias("unique_users"),
                                         count_of("purchase").alias("purchases"),
                                         money_sum("revenue").alias("total_revenue"))


def category_by_weekday(fact, dates, categories) -> DataFrame:
    f = (fact.filter(F.col("event_type") == "purchase")
         .join(F.broadcast(dates.select("date_key", "day_name")), fact.date_sk == F.col("date_key"))
         .join(categories.select("category_sk", "category_l1"), "category_sk"))
    return f.groupBy("day_name", "category_l1").agg(F.count(F.lit(1)).alias("events"),
                                                    count_of("purchase").alias("purchases"),
                                                    money_sum("revenue").alias("revenue"))


def month_segment_revenue(fact, dates, users) -> DataFrame:
    f = (fact.filter(F.col("event_type") == "purchase")
         .join(F.broadcast(dates.select("date_key", "month_name")), fact.date_sk == F.col("date_key"))
         .join(users.select("user_sk", "user_segment"), "user_sk"))
    return f.groupBy("month_name", "user_segment").agg(money_sum("revenue").alias("revenue"))


def product_history_purchases(fact, products) -> DataFrame:
    """Purchases per product price version (GROUP BY ALL of the doc query)."""
    f = fact.filter(F.col("event_type") == "purchase").select("product_sk").join(
        products.select("product_sk", "product_id", "brand", "price", "effective_from"), "product_sk")
    return f.groupBy("product_id", "brand", "price", "effective_from").agg(
        F.count(F.lit(1)).alias("purchases"))


# --- mart reports ------------------------------------------------------------

def revenue_trend(daily: DataFrame) -> DataFrame:
    return (daily.groupBy("year", "month", "month_name")
            .agg(F.sum("total_purchases").cast("long").alias("purchases"),
                 total_sum("total_revenue").alias("revenue"),
                 total_avg("avg_order_value").alias("avg_aov"),
                 rhu(F.avg("overall_conversion_rate")).alias("avg_conversion"))
            .drop("month"))


def recent_daily_kpis(daily: DataFrame, days: int = 7) -> DataFrame:
    """Daily mart rows of the last ``days`` days before the latest date."""
    last = daily.select(F.max("full_date")).scalar()
    return daily.filter(F.col("full_date") >= F.date_sub(last, days))


def weekend_vs_weekday(daily: DataFrame) -> DataFrame:
    return (daily.groupBy("is_weekend").agg(
        F.count(F.lit(1)).alias("days"),
        rhu(F.avg("daily_active_users"), 0).alias("avg_dau"),
        rhu(F.avg("total_purchases"), 0).alias("avg_purchases"),
        total_avg("total_revenue").alias("avg_revenue"),
        rhu(F.avg("overall_conversion_rate")).alias("avg_conversion_rate"))
        .select(F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type"),
                "days", "avg_dau", "avg_purchases", "avg_revenue", "avg_conversion_rate"))


def top_users_by_ltv(user_mart: DataFrame, n: int = 20) -> DataFrame:
    return (user_mart.select("user_id", "user_segment", "total_events", "total_purchases",
                             "lifetime_revenue", "recency_days", "frequency_purchases", "days_active")
            .orderBy(F.desc("lifetime_revenue"), F.asc("user_id")).limit(n))


def user_segment_distribution(user_mart: DataFrame) -> DataFrame:
    per = user_mart.groupBy("user_segment").agg(
        F.count(F.lit(1)).alias("user_count"),
        rhu(F.avg("total_purchases")).alias("avg_purchases"),
        total_avg("lifetime_revenue").alias("avg_ltv"),
        rhu(F.avg("days_active")).alias("avg_days_active"))
    pct = rhu(F.col("user_count") * 100.0 / F.sum("user_count").over(Window.partitionBy()))
    return per.withColumn("pct_of_users", pct)


def rfm_segments(user_mart: DataFrame, min_score: int = 4, n: int = 10) -> DataFrame:
    """Quintile R/F/M scores of purchasers (R reversed), keep users scoring
    at least ``min_score`` on all three, group by the score string.

    All three NTILEs over the whole user base come from one global index
    (no single-partition window); user_id breaks score ties."""
    buyers = user_mart.filter(F.col("total_purchases") > 0).select(
        "user_id", "recency_days", "frequency_purchases", "lifetime_revenue")
    tiles = ntiles_global(buyers, {"r_tile": ["recency_days", "user_id"], "f_score": ["frequency_purchases", "user_id"],
                                   "m_score": ["lifetime_revenue", "user_id"]}, 5)
    scored = tiles.withColumn("r_score", 6 - F.col("r_tile"))
    top = scored.filter((F.col("r_score") >= min_score) & (F.col("f_score") >= min_score)
                        & (F.col("m_score") >= min_score))
    seg = F.concat(F.col("r_score").cast("string"), F.col("f_score").cast("string"),
                   F.col("m_score").cast("string"))
    return (top.groupBy(seg.alias("rfm_segment")).agg(
        F.count(F.lit(1)).alias("user_count"),
        rhu(F.avg("recency_days"), 1).alias("avg_recency"),
        rhu(F.avg("frequency_purchases"), 1).alias("avg_frequency"),
        total_avg("lifetime_revenue").alias("avg_monetary"))
        .orderBy(F.desc("user_count"), F.asc("rfm_segment")).limit(n))


def ltv_tiers(user_mart: DataFrame) -> DataFrame:
    return user_mart.groupBy(ltv_tier("lifetime_revenue").alias("ltv_tier")).agg(
        F.count(F.lit(1)).alias("users"),
        rhu(F.avg("total_purchases"), 1).alias("avg_purchases"),
        total_avg("lifetime_revenue").alias("avg_ltv"),
        rhu(F.avg("days_active"), 1).alias("avg_days_active"),
        rhu(F.avg("personal_conversion_rate")).alias("avg_conversion_rate"))


def top_products(product_mart: DataFrame, n: int = 20) -> DataFrame:
    return (product_mart.select("product_id", "brand", "category_l1", "total_views", "total_purchases",
                                "total_revenue", "view_to_purchase_rate", "rank_in_category_by_revenue")
            .orderBy(F.desc("total_revenue"), F.asc("product_id")).limit(n))


def category_distribution(product_mart: DataFrame) -> DataFrame:
    return product_mart.groupBy("category_l1").agg(
        F.count(F.lit(1)).alias("product_count"),
        F.sum("total_views").cast("long").alias("total_views"),
        F.sum("total_purchases").cast("long").alias("total_purchases"),
        total_sum("total_revenue").alias("total_revenue"),
        rhu(F.avg("view_to_purchase_rate")).alias("avg_conversion"))


def top_products_by_category(product_mart: DataFrame, n: int = 5) -> DataFrame:
    ranked = top_n(product_mart.filter(F.col("total_revenue") > 0), "category_l1",
                   [F.desc("total_revenue"), F.asc("product_id")], n, keep_rank=True)
    return ranked.select("category_l1", "product_id", "brand", "total_revenue", "total_purchases",
                         "view_to_purchase_rate", "rn")


def high_converting_products(product_mart: DataFrame, min_views: int = 100, min_rate: float = 3.0,
                             n: int = 20) -> DataFrame:
    return (product_mart.filter((F.col("total_views") >= min_views)
                                & (F.col("view_to_purchase_rate") >= min_rate))
            .select("product_id", "brand", "category_l1", "total_views", "total_purchases",
                    "view_to_purchase_rate", "total_revenue", "revenue_per_view")
            .orderBy(F.desc("revenue_per_view"), F.asc("product_id")).limit(n))


def top_categories_by_revenue(category_mart: DataFrame, n: int = 20) -> DataFrame:
    return (category_mart.select("category_l1", "category_l2", "category_l3", "unique_products",
                                 "total_views", "total_purchases", "total_revenue",
                                 "view_to_purchase_rate", "overall_rank_by_revenue", "category_sk")
            .orderBy(F.desc("total_revenue"), F.asc("category_sk")).limit(n).drop("category_sk"))


def category_l1_rollup(category_mart: DataFrame) -> DataFrame:
    return category_mart.groupBy("category_l1").agg(
        F.count(F.lit(1)).alias("subcategory_count"),
        F.sum("unique_products").cast("long").alias("total_products"),
        F.sum("total_views").cast("long").alias("total_views"),
        F.sum("total_purchases").cast("long").alias("total_purchases"),
        total_sum("total_revenue").alias("total_revenue"),
        rhu(F.avg("view_to_purchase_rate")).alias("avg_conversion"))


def category_rollup_levels(fact: DataFrame, categories: DataFrame) -> DataFrame:
    """ROLLUP(l1, l2, l3) with distinct users re-counted at every level
    (summing per-subcategory distinct counts would double count)."""
    levels = ["category_l1", "category_l2", "category_l3"]
    per = fact.groupBy("category_sk", "user_sk").agg(
        F.count(F.lit(1)).alias("n"), count_of("purchase").alias("b"), F.sum(money("revenue")).alias("r"))
    f = per.join(categories.select("category_sk", *levels), "category_sk")
    # per level one row per (path, user), so users are a row count per path
    parts = []
    for depth in range(len(levels), -1, -1):
        keys = levels[:depth]
        g = (1 << (len(levels) - depth)) - 1
        reduced = f.groupBy(*keys, "user_sk").agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.sum("r").alias("r"))
        parts.append(reduced.groupBy(*keys).agg(
            F.sum("n").cast("long").alias("total_events"), F.sum("b").cast("long").alias("total_purchases"),
            F.round(F.sum("r"), 2).cast("double").alias("total_revenue"), F.count("user_sk").alias("unique_users"))
            .select(*[F.col(c) if c in keys else F.lit(None).cast("string").alias(c) for c in levels],
                    F.lit(g).cast("long").alias("level"), "total_events", "total_purchases", "total_revenue", "unique_users"))
    return reduce(DataFrame.unionByName, parts)


def top_subcategories_by_l1(category_mart: DataFrame, n: int = 3) -> DataFrame:
    ranked = top_n(category_mart.filter(F.col("category_l2").isNotNull()), "category_l1",
                   [F.desc("total_revenue"), F.asc("category_sk")], n, keep_rank=True)
    return ranked.select("category_l1", "category_l2", "category_l3", "total_revenue",
                         "total_purchases", "view_to_purchase_rate", "rn")


def high_converting_categories(category_mart: DataFrame, min_views: int = 1000, min_rate: float = 1.0,
                               n: int = 20) -> DataFrame:
    return (category_mart.filter((F.col("total_views") >= min_views)
                                 & (F.col("view_to_purchase_rate") >= min_rate))
            .select("category_l1", "category_l2", "category_l3", "total_views", "total_purchases",
                    "view_to_purchase_rate", "total_revenue", "revenue_per_view", "category_sk")
            .orderBy(F.desc("view_to_purchase_rate"), F.asc("category_sk")).limit(n)
            .drop("category_sk"))


def top_brands_by_revenue(brand_mart: DataFrame, n: int = 20) -> DataFrame:
    return (brand_mart.select("brand", "unique_products", "categories_l1_count", "total_views",
                              "total_purchases", "total_revenue", "view_to_purchase_rate",
                              "revenue_market_share", "rank_by_revenue")
            .orderBy(F.desc("total_revenue"), F.asc("brand")).limit(n))


def multi_category_brands(brand_mart: DataFrame, min_l1: int = 2, n: int = 20) -> DataFrame:
    return (brand_mart.filter(F.col("categories_l1_count") >= min_l1)
            .select("brand", "categories_l1_count", "unique_products", "total_revenue",
                    "view_to_purchase_rate", "revenue_market_share")
            .orderBy(F.desc("total_revenue"), F.asc("brand")).limit(n))


def high_performing_brands(brand_mart: DataFrame, min_views: int = 10000, min_rate: float = 1.5,
                           n: int = 20) -> DataFrame:
    return (brand_mart.filter((F.col("total_views") >= min_views)
                              & (F.col("view_to_purchase_rate") >= min_rate))
            .select("brand", "unique_products", "total_views", "total_purchases",
                    "view_to_purchase_rate", "total_revenue", "revenue_per_view", "revenue_market_share")
            .orderBy(F.desc("revenue_per_view"), F.asc("brand")).limit(n))


def _funnel_tie() -> list[Column]:
    return [F.asc("category_l1"), F.asc_nulls_first("category_l2")]


def recent_funnel(funnel: DataFrame, n: int = 20) -> DataFrame:
    return (funnel.select("full_date", "category_l1", "category_l2", "users_viewed", "users_carted",
                          "users_purchased", "view_to_cart_user_rate", "cart_to_purchase_user_rate",
                          "overall_conversion_user_rate", "cart_abandonment_rate", "total_revenue")
            .orderBy(F.desc("full_date"), F.desc("total_revenue"), *_funnel_tie()).limit(n))


def funnel_by_l1(funnel: DataFrame) -> DataFrame:
    agg = funnel.groupBy("category_l1").agg(
        F.sum("users_viewed").cast("long").alias("total_users_viewed"),
        F.sum("users_carted").cast("long").alias("total_users_carted"),
        F.sum("users_purchased").cast("long").alias("total_users_purchased"),
        total_sum("total_revenue").alias("total_revenue"))
    return agg.select(
        "category_l1", "total_users_viewed", "total_users_carted", "total_users_purchased",
        safe_rate("total_users_carted", "total_users_viewed").alias("avg_view_to_cart_rate"),
        safe_rate("total_users_purchased", "total_users_carted").alias("avg_cart_to_purchase_rate"),
        safe_rate("total_users_purchased", "total_users_viewed").alias("avg_overall_conversion"),
        "total_revenue")


def worst_funnels(funnel: DataFrame, min_viewers: int = 100, n: int = 20) -> DataFrame:
    return (funnel.filter(F.col("users_viewed") >= min_viewers)
            .select("full_date", "category_l1", "category_l2", "users_viewed", "users_carted",
                    "users_purchased", "cart_abandonment_rate", "purchase_abandonment_rate",
                    "overall_conversion_user_rate", "total_revenue")
            .orderBy(F.desc_nulls_last("cart_abandonment_rate"),
                     F.desc_nulls_last("purchase_abandonment_rate"),
                     F.asc("full_date"), *_funnel_tie()).limit(n))


def recent_sessions(session_mart: DataFrame, n: int = 20) -> DataFrame:
    return (session_mart.select("full_date", "total_sessions", "unique_users_with_sessions",
                                "avg_session_duration_minutes", "avg_events_per_session",
                                "pct_sessions_with_cart", "pct_sessions_with_purchase",
                                "total_session_revenue", "avg_revenue_per_converting_session")
            .orderBy(F.desc("full_date")).limit(n))


def session_engagement_mix(session_mart: DataFrame, n: int = 20) -> DataFrame:
    return (session_mart.select(
        "full_date", "total_sessions", "single_event_sessions", "low_engagement_sessions",
        "medium_engagement_sessions", "high_engagement_sessions",
        safe_rate("single_event_sessions", "total_sessions").alias("pct_single_event"),
        safe_rate("high_engagement_sessions", "total_sessions").alias("pct_high_engagement"))
        .orderBy(F.desc("full_date")).limit(n))


def recent_cohorts(cohort: DataFrame, since: str, n: int = 30) -> DataFrame:
    return (cohort.filter(F.col("cohort_month") >= F.lit(since).cast("timestamp"))
            .select("cohort_month", "periods_since_cohort", "activity_month", "total_cohort_users",
                    "active_users", "retention_rate", "period_revenue", "cumulative_revenue",
                    "ltv_to_date")
            .orderBy(F.desc("cohort_month"), F.asc("periods_since_cohort")).limit(n))


def retention_curve(cohort: DataFrame, months: list[str], max_period: int = 6) -> DataFrame:
    return (cohort.filter(F.col("cohort_month").isin(*[F.lit(m).cast("timestamp") for m in months])
                          & (F.col("periods_since_cohort") <= max_period))
            .select("cohort_month", "periods_since_cohort", "total_cohort_users", "active_users",
                    "retention_rate", "cumulative_revenue", "ltv_to_date"))


def best_cohorts(cohort: DataFrame, period: int = 3, n: int = 20) -> DataFrame:
    return (cohort.filter(F.col("periods_since_cohort") == period)
            .select("cohort_month", "total_cohort_users",
                    F.col("retention_rate").alias("month_3_retention"),
                    F.col("ltv_to_date").alias("month_3_ltv"),
                    F.col("cumulative_revenue").alias("total_revenue_month_3"))
            .orderBy(F.desc("month_3_ltv"), F.asc("cohort_month")).limit(n))


# --- dashboard data queries ---------------------------------------------

def dash_daily_metrics(daily: DataFrame, days: int = 30) -> DataFrame:
    return (daily.select("full_date", "daily_active_users", "total_events", "total_purchases",
                         F.col("total_revenue").cast("double"), F.col("avg_order_value").cast("double"),
                         F.col("overall_conversion_rate").cast("double"))
            .orderBy(F.desc("full_date")).limit(days))


def dash_top_products(product_mart: DataFrame, n: int = 10) -> DataFrame:
    return (product_mart.filter(F.col("brand").isNotNull())
            .orderBy(F.desc("total_revenue"), F.asc("product_id")).limit(n)
            .select(F.col("brand").alias("product_name"), F.col("total_revenue").cast("double"),
                    "total_quantity_sold", "total_purchases"))


def dash_category_performance(category_mart: DataFrame) -> DataFrame:
    return (category_mart.filter(F.col("category_l1").isNotNull())
            .select(F.col("category_l1").alias("category_name"), F.col("total_revenue").cast("double"),
                    "total_purchases",
                    F.col("avg_revenue_per_purchase").cast("double").alias("avg_order_value")))


def dash_summary_kpis(daily: DataFrame) -> DataFrame:
    return daily.agg(total_sum("total_revenue").alias("total_revenue"),
                     F.sum("total_purchases").cast("long").alias("total_purchases"),
                     total_avg("avg_order_value", 6).alias("avg_order_value"),
                     F.max("daily_active_users").cast("long").alias("peak_dau"))


def dash_funnel(daily: DataFrame, days: int = 30) -> DataFrame:
    """Views / carts / purchases of the last ``days`` days with each stage
    as a percentage of views (real cart counts)."""
    recent = dash_daily_metrics_full(daily, days)
    tot = recent.agg(F.sum("total_views").cast("long").alias("v"), F.sum("total_carts").cast("long").alias("c"),
                     F.sum("total_purchases").cast("long").alias("p"))
    def stage(order, name, col):
        return tot.select(F.lit(order).alias("stage_order"), F.lit(name).alias("stage"),
                          F.col(col).alias("count"),
                          safe_rate(F.col(col), F.col("v"), digits=1).alias("pct_of_views"))
    return stage(1, "Views", "v").unionByName(stage(2, "Add to Cart", "c")) \
        .unionByName(stage(3, "Purchase", "p"))


def dash_daily_metrics_full(daily: DataFrame, days: int) -> DataFrame:
    """All columns of the latest ``days`` daily rows."""
    return daily.orderBy(F.desc("full_date")).limit(days)
