"""Silver layer: calendar, category hierarchy, SCD2 product and user
dimensions and the event-grain fact table."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.calendar import calendar_columns
from ..functions.columns import (SEGMENT_ENGAGED_MIN, SEGMENT_POWER_MIN, clean_brand,
                                 clean_price, round_half_up, segment)
from ..operators.joins import OPEN_END, UNKNOWN_SK, lookup, point_in_time
from ..operators.keys import dense_key
from ..operators.windows import latest_per_key
from ..session import checkpoint_dir
from ..sources.events import bronze_from_tables

CALENDAR_BUFFER_DAYS = 365
#: Events for each task, where a step holds what is left of them in memory.
EVENTS_PER_TASK = 100_000


def event_tasks(events: DataFrame) -> int:
    """Number of tasks that grows with the events (of a Parquet scan, only
    footers are read for it)."""
    return max(1, -(-events.count() // EVENTS_PER_TASK))


def dim_date(spark: SparkSession, bronze: DataFrame, buffer_days: int = CALENDAR_BUFFER_DAYS) -> DataFrame:
    """One row per day from the first event date to the last + buffer.

    The bounds are scalar subqueries over the events (no driver collect);
    the row count is bounded by the date span, so the calendar is a safe
    broadcast side.
    """
    bounds = bronze.select(F.struct(F.min("event_date").alias("lo"),
                                    F.max("event_date").alias("hi"))).scalar()
    days = spark.range(1).select(F.explode(F.sequence(bounds.getField("lo"),
                                                      F.date_add(bounds.getField("hi"), buffer_days))).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def category_rows(bronze: DataFrame) -> DataFrame:
    """Distinct category paths split into three levels; NULL path ->
    'unknown' (depth 0)."""
    raw = bronze.select("category_code").distinct()
    parts = F.split(F.col("category_code"), r"\.")
    l1, l2, l3 = F.get(parts, 0), F.get(parts, 1), F.get(parts, 2)
    depth = (F.when(l3.isNotNull(), 3).when(l2.isNotNull(), 2)
             .when(l1.isNotNull(), 1).otherwise(0))
    return raw.select(
        F.coalesce(l1, F.lit("unknown")).alias("category_l1"),
        l2.alias("category_l2"),
        l3.alias("category_l3"),
        F.coalesce(F.col("category_code"), F.lit("unknown")).alias("category_full_path"),
        depth.alias("category_depth"),
    )


def dim_categories(bronze: DataFrame, load_ts=None) -> DataFrame:
    """The category paths; key = position in path order."""
    keyed = dense_key(category_rows(bronze), ["category_full_path"], "category_sk")
    return keyed.select("category_sk", "category_l1", "category_l2", "category_l3",
                        "category_full_path", "category_depth",
                        (load_ts if load_ts is not None else F.current_timestamp()).alias("created_at"))


def dim_products(bronze: DataFrame, categories: DataFrame, load_ts=None) -> DataFrame:
    """Initial product dimension: the latest attributes of each product
    (latest event; event_id breaks ties), cleaned, version 1 valid from the
    first event date. Products whose path has no category get -1."""
    latest = latest_per_key(bronze.filter(F.col("product_id").isNotNull()), "product_id",
                            ["event_time", "event_id"], ["price", "brand", "category_code"])
    enriched = lookup(latest, categories, "category_code", "category_full_path", "category_sk")
    start = bronze.select(F.min("event_date")).scalar()
    versioned = enriched.select(
        "product_id",
        clean_brand("brand").alias("brand"),
        clean_price("price").alias("price"),
        "category_sk", "category_code",
        start.alias("effective_from"),
        F.lit(OPEN_END).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current_version"),
        F.lit(1).alias("version_number"),
    )
    keyed = dense_key(versioned, ["product_id"], "product_sk")
    ts = load_ts if load_ts is not None else F.current_timestamp()
    return keyed.select("product_sk", "product_id", "brand", "price", "category_sk", "category_code",
                        "effective_from", "effective_to", "is_current_version", "version_number",
                        ts.alias("created_at"), ts.alias("updated_at"))


def user_activity(bronze: DataFrame) -> DataFrame:
    """Per-user activity counts. Two-level aggregate: (user, date, type)
    counts first (partial aggregation collapses hot users before the
    shuffle), then the per-user distincts, which hold each row once for each
    of them, run on that frame, dealt by user."""
    days = (bronze.filter(F.col("user_id").isNotNull())
            .groupBy("user_id", "event_date", "event_type").agg(F.count(F.lit(1)).alias("n")))
    return _activity(days.repartition(event_tasks(bronze), "user_id"))


def _activity(lvl1: DataFrame) -> DataFrame:
    """Per user from (user, date, type) counts."""

    def n_of(t):
        return F.sum(F.when(F.col("event_type") == t, F.col("n")).otherwise(F.lit(0))).cast("long")

    return lvl1.groupBy("user_id").agg(
        F.sum("n").cast("long").alias("total_events"),
        F.count_distinct("event_type").alias("event_types_count"),
        F.min("event_date").alias("first_seen_date"),
        F.max("event_date").alias("last_seen_date"),
        F.count_distinct("event_date").alias("active_days"),
        n_of("purchase").alias("purchase_count"),
        n_of("view").alias("view_count"),
        n_of("cart").alias("cart_count"),
    )


def dim_users(bronze: DataFrame, power: int = SEGMENT_POWER_MIN, engaged: int = SEGMENT_ENGAGED_MIN,
              load_ts=None) -> DataFrame:
    """Initial user dimension: activity metrics and segment, version 1 valid
    from the first seen date."""
    versioned = _user_columns(user_activity(bronze), power, engaged)
    keyed = dense_key(versioned, ["user_id"], "user_sk")
    ts = load_ts if load_ts is not None else F.current_timestamp()
    return keyed.select("user_sk", *[c for c in versioned.columns], ts.alias("created_at"),
                        ts.alias("updated_at"))


def users_from_days(days: DataFrame, power: int = SEGMENT_POWER_MIN, engaged: int = SEGMENT_ENGAGED_MIN) -> DataFrame:
    """``dim_users`` without key and audit times, from (user, date, type)
    counts."""
    return _user_columns(_activity(days), power, engaged)


def _user_columns(act: DataFrame, power: int, engaged: int) -> DataFrame:
    days_active = F.datediff("last_seen_date", "first_seen_date") + 1
    return act.select(
        "user_id",
        segment("total_events", power, engaged).alias("user_segment"),
        "total_events", "event_types_count", "first_seen_date", "last_seen_date", "active_days",
        round_half_up(F.col("total_events") / days_active, 2).alias("avg_events_per_day"),
        "purchase_count", "view_count", "cart_count",
        F.col("first_seen_date").alias("effective_from"),
        F.lit(OPEN_END).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current_version"),
        F.lit(1).alias("version_number"),
    )


def fact_events(bronze: DataFrame, dates: DataFrame, users: DataFrame, products: DataFrame,
                load_ts=None) -> DataFrame:
    """Event-grain fact: calendar key, current user version, product version
    valid on the event date (half-open interval), and the measures."""
    f = bronze.select("event_id", "event_time", "event_date", "event_type", "user_id",
                      "product_id", "user_session")
    f = lookup(f, dates, "event_date", "full_date", "date_key", out="date_sk", bounded=True)
    f = lookup(f, users.filter(F.col("is_current_version")), "user_id", "user_id", "user_sk")
    f = point_in_time(f, products, "product_id", "event_date",
                      {"product_sk": "product_sk", "category_sk": "category_sk",
                       "price": "price_at_event"},
                      unknown={"product_sk": UNKNOWN_SK, "category_sk": UNKNOWN_SK})
    qty = F.when(F.col("event_type").isin("cart", "purchase"), 1).otherwise(0)
    revenue = F.when(F.col("event_type") == "purchase", F.col("price_at_event") * qty).otherwise(F.lit(0.0))
    return f.select(
        "event_id", "event_time", "event_date", "event_type", "date_sk", "user_sk", "product_sk",
        "category_sk", "price_at_event", qty.alias("quantity"), revenue.alias("revenue"),
        F.lit(1).alias("event_count"), "user_session",
        (load_ts if load_ts is not None else F.current_timestamp()).alias("created_at"))


#: Bronze columns that dimensions and fact are built from.
SILVER_INPUT = ["event_id", "event_time", "event_date", "event_type", "user_id", "product_id", "price", "brand",
                "category_code", "user_session"]


def _laid_down(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to a new folder beside the shared
    checkpoints and read back (columns pruned, no lineage)."""
    spark = df.sparkSession
    out = f"{checkpoint_dir(spark).rstrip('/')}/star-{uuid.uuid4().hex}"
    df.write.parquet(out)
    return spark.read.schema(df.schema).parquet(out)


class Star:
    """Bronze and the tables built from it, each built when first asked for
    (a bronze reader starts no dimension job)."""

    def __init__(self, spark: SparkSession, bronze: DataFrame, power: int = SEGMENT_POWER_MIN,
                 engaged: int = SEGMENT_ENGAGED_MIN):
        self.spark, self.bronze, self._power, self._engaged = spark, bronze, power, engaged

    @cached_property
    def _events(self) -> DataFrame:
        """The bronze columns that dimensions and fact read, laid down once:
        the joins behind bronze are not repeated for each of them."""
        return _laid_down(self.bronze.select(*SILVER_INPUT))

    @cached_property
    def dates(self) -> DataFrame:
        return dim_date(self.spark, self._events)

    @cached_property
    def categories(self) -> DataFrame:
        return dim_categories(self._events)

    @cached_property
    def products(self) -> DataFrame:
        return dim_products(self._events, self.categories)

    @cached_property
    def users(self) -> DataFrame:
        return dim_users(self._events, self._power, self._engaged)

    @cached_property
    def fact(self) -> DataFrame:
        """Laid down too: a mart reads it several times."""
        return _laid_down(fact_events(self._events, self.dates, self.users, self.products))


def build_star(spark: SparkSession, bronze: DataFrame, power: int = SEGMENT_POWER_MIN,
               engaged: int = SEGMENT_ENGAGED_MIN) -> Star:
    return Star(spark, bronze, power, engaged)


_STARS: dict[tuple, Star] = {}


def _file_states(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> tuple:
    """Path, size and modification time of the tables' files, as the input's
    own file system lists them."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for t in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{t}.parquet")
        out += [(str(f.getPath()), f.getLen(), f.getModificationTime()) for f in path.getFileSystem(conf).listStatus(path)]
    return tuple(out)


def star_from_tables(spark: SparkSession, sf_dir: str, power: int = SEGMENT_POWER_MIN,
                     engaged: int = SEGMENT_ENGAGED_MIN) -> Star:
    """Star schema over the given tables; the dimension key steps checkpoint
    once per session and state of the input files, later calls reuse the
    same frames."""
    key = (spark.sparkContext.applicationId, spark._jsparkSession.hashCode(), sf_dir, power, engaged, _file_states(spark, sf_dir, ("events", "part")))
    if key not in _STARS:
        while len(_STARS) >= 16:
            _STARS.pop(next(iter(_STARS)))
        _STARS[key] = build_star(spark, bronze_from_tables(spark, sf_dir), power, engaged)
    return _STARS[key]
