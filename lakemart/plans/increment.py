"""Later loads: state per day, and tables that follow it.

Everything a load may change is derived from two state tables partitioned by
day, which the load recomputes for its own days only:

* ``product_days``  last observed price, brand and category path of each
                    product on each day;
* ``user_days``     events by type of each user on each day.

A day's state depends on that day's events alone, so days may arrive in any
order and as often as they like. Dimensions are then brought up to date for
the keys of the load alone:

* ``splice_versions``  type 2 versions: a day between known days splits the
                       version valid then (or moves, or removes a boundary);
                       versions that stay keep their surrogate key;
* ``update_users``     totals and segments of the users in the load;
* ``add_categories``   new paths keyed after the known ones, none renumbered;
* ``changed_days``     the days on which some product now resolves to another
                       version: the facts to be rewritten beside the load's.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import SEGMENT_ENGAGED_MIN, SEGMENT_POWER_MIN, clean_brand, clean_price, segment
from ..operators.joins import lookup, point_in_time_bucketed
from ..operators.keys import continue_keys
from . import scd2, star

AUDIT = ("created_at", "updated_at")


def product_days(bronze: DataFrame) -> DataFrame:
    """(product_id, event_date, price, brand, category_code): each product's
    last observed values of each day (``max_by``, partial aggregation)."""
    known = bronze.filter(F.col("product_id").isNotNull() & F.col("event_date").isNotNull())
    last = F.max_by(F.struct("price", "brand", "category_code"), F.struct("event_time", "event_id")).alias("_v")
    return known.groupBy("product_id", "event_date").agg(last).select(
        "product_id", clean_price("_v.price").alias("price"), clean_brand("_v.brand").alias("brand"),
        F.col("_v.category_code").alias("category_code"), "event_date")


def user_days(bronze: DataFrame) -> DataFrame:
    """(user_id, event_type, n, event_date)."""
    return (bronze.filter(F.col("user_id").isNotNull()).groupBy("user_id", "event_type", "event_date")
            .agg(F.count(F.lit(1)).alias("n")).select("user_id", "event_type", "n", "event_date"))


def _product_values(days: DataFrame, categories: DataFrame) -> DataFrame:
    d = lookup(days, categories, "category_code", "category_full_path", "category_sk")
    return d.withColumnRenamed("event_date", "day")


def _user_values(days: DataFrame, power: int, engaged: int) -> DataFrame:
    per_day = days.filter(F.col("event_date").isNotNull()).groupBy("user_id", F.col("event_date").alias("day")).agg(F.sum("n").alias("n"))
    w = Window.partitionBy("user_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    running = per_day.withColumn("events_at_start", F.sum("n").over(w).cast("long"))
    return running.withColumn("user_segment", segment("events_at_start", power, engaged)).drop("n")


PRODUCT_VALUES = ["price", "brand", "category_sk", "category_code"]


def _same(pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs])


def splice_versions(dim: DataFrame, daily: DataFrame, touched: DataFrame, key: str, values: list[str], sk: str,
                    extra: list[str] | None = None, load_ts=None) -> DataFrame:
    """The dimension after the days of the keys in ``touched`` changed.

    ``daily`` (key, day, values) is the state of all days; only touched keys'
    days are read into versions again (one row per key and day, however many
    events). A version that starts on the same day as before keeps its
    surrogate key, and its audit times if nothing about it changed; others
    are keyed after the largest key. Applied twice, nothing changes."""
    extra = extra or []
    ts = load_ts if load_ts is not None else F.current_timestamp()
    touched = touched.select(key).filter(F.col(key).isNotNull()).distinct()
    target = scd2._islands(daily.join(touched, key, "left_semi"), key, values, extra)
    fields = [*values, *extra, "effective_to", "is_current_version", "version_number"]
    prior = dim.join(touched, key, "left_semi").select(key, "effective_from", sk, *AUDIT, *[F.col(c).alias(f"_was_{c}") for c in fields])
    joined = target.join(prior, [key, "effective_from"], "left")
    same = _same([(c, f"_was_{c}") for c in fields]) & F.col(sk).isNotNull()
    joined = joined.withColumn("updated_at", F.when(same, F.col("updated_at")).otherwise(ts)).withColumn("created_at", F.coalesce("created_at", ts))
    known = joined.filter(F.col(sk).isNotNull())
    fresh = continue_keys(dim, joined.filter(F.col(sk).isNull()).drop(sk), [key, "effective_from"], sk)
    rest = dim.join(touched, key, "left_anti")
    return reduce(DataFrame.unionByName, [d.select(*dim.columns) for d in (rest, known, fresh)])


def splice_products(dim: DataFrame, days: DataFrame, touched: DataFrame, categories: DataFrame, load_ts=None) -> DataFrame:
    return splice_versions(dim, _product_values(days, categories), touched, "product_id", PRODUCT_VALUES, "product_sk", load_ts=load_ts)


def splice_users(dim: DataFrame, days: DataFrame, touched: DataFrame, power: int = SEGMENT_POWER_MIN, engaged: int = SEGMENT_ENGAGED_MIN,
                 load_ts=None) -> DataFrame:
    """Segment versions: the running count continues over late days too."""
    touched = touched.select("user_id").filter("user_id is not null").distinct()
    daily = _user_values(days.join(touched, "user_id", "left_semi"), power, engaged)
    return splice_versions(dim, daily, touched, "user_id", ["user_segment"], "user_sk", ["events_at_start"], load_ts)


def update_users(users: DataFrame, days: DataFrame, touched: DataFrame, power: int = SEGMENT_POWER_MIN, engaged: int = SEGMENT_ENGAGED_MIN,
                 load_ts=None) -> DataFrame:
    """``users`` with the touched users' totals and segments from the state;
    known users keep their key, new ones are keyed after them."""
    touched = touched.select("user_id").filter("user_id is not null").distinct()
    ts = load_ts if load_ts is not None else F.current_timestamp()
    now = star.users_from_days(days.join(touched, "user_id", "left_semi"), power, engaged)
    prior = users.join(touched, "user_id", "left_semi").select("user_id", "user_sk", *AUDIT, *[F.col(c).alias(f"_was_{c}") for c in now.columns if c != "user_id"])
    joined = now.join(prior, "user_id", "left")
    same = _same([(c, f"_was_{c}") for c in now.columns if c != "user_id"]) & F.col("user_sk").isNotNull()
    joined = joined.withColumn("updated_at", F.when(same, F.col("updated_at")).otherwise(ts)).withColumn("created_at", F.coalesce("created_at", ts))
    fresh = continue_keys(users, joined.filter(F.col("user_sk").isNull()).drop("user_sk"), ["user_id"], "user_sk")
    parts = (users.join(touched, "user_id", "left_anti"), joined.filter(F.col("user_sk").isNotNull()), fresh)
    return reduce(DataFrame.unionByName, [d.select(*users.columns) for d in parts])


def add_categories(categories: DataFrame, batch: DataFrame, load_ts=None) -> DataFrame:
    """``categories`` and the batch's new paths; no known key moves."""
    new = star.category_rows(batch).join(categories.select("category_full_path"), "category_full_path", "left_anti")
    ts = (load_ts if load_ts is not None else F.current_timestamp()).alias("created_at")
    keyed = continue_keys(categories, new.select("*", ts), ["category_full_path"], "category_sk")
    return categories.unionByName(keyed.select(*categories.columns))


def changed_days(old: DataFrame, new: DataFrame, days: DataFrame, touched: DataFrame) -> DataFrame:
    """Days on which a touched product resolves to another version, price or
    category in ``new`` than in ``old`` (both product dimensions)."""
    touched = touched.select("product_id").filter("product_id is not null").distinct()
    at = days.join(touched, "product_id", "left_semi").select("product_id", "event_date")
    cols = ("product_sk", "category_sk", "price")
    for name, dim in (("old", old), ("new", new)):
        mine = dim.join(touched, "product_id", "left_semi")
        at = point_in_time_bucketed(at, mine, "product_id", "event_date", {c: f"{name}_{c}" for c in cols})
    return at.filter(~_same([(f"old_{c}", f"new_{c}") for c in cols])).select("event_date").distinct()
