"""Slowly changing dimensions (type 2).

* ``scd2_detect``      compare a new snapshot with the current versions
                       (NULL-safe; new keys are reported too).
* ``scd2_apply``       the complete next dimension as one DataFrame:
                       history + unchanged + closed + new versions + new
                       keys. Intervals are half-open: the closed version
                       ends on the day the new one starts, so no day falls
                       between versions. Re-applying the same snapshot is a
                       no-op. Write it to a new path, then switch readers.
* ``products_from_history`` / ``users_from_history``
                       versions rebuilt from the event history (price /
                       brand / category change points; segment evolution
                       by running event count), one version per change day.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import (SEGMENT_ENGAGED_MIN, SEGMENT_POWER_MIN, clean_brand, clean_price,
                                 round_half_up, segment)
from ..operators.joins import OPEN_END, lookup
from ..operators.keys import continue_keys, dense_key
from ..session import checkpoint_dir

PRODUCT_TRACKED = ["price", "brand", "category_sk"]

# Fixed values of the deterministic test snapshot: the product_id % 10 rule
# that drops price 20%, raises it 10%, renames the brand, or adds a new key.
SNAPSHOT_PRICE_DROP = 0.8
SNAPSHOT_PRICE_RISE = 1.1
SNAPSHOT_BRAND_SUFFIX = "_updated"
SNAPSHOT_NEW_KEY_OFFSET = 1000


def snapshot_from_dim(products: DataFrame) -> DataFrame:
    """A new product snapshot derived from the current versions: ids ending
    in 0 drop price 20%, in 1 raise it 10%, in 2 rename the brand, in 3 also
    appear as a brand-new product (id + 1000); the rest are unchanged."""
    cur = products.filter(F.col("is_current_version")).select(
        "product_id", "price", "brand", "category_sk", "category_code")
    d = F.col("product_id") % 10
    changed = cur.select(
        "product_id",
        F.when(d == 0, round_half_up(F.col("price") * SNAPSHOT_PRICE_DROP, 2))
         .when(d == 1, round_half_up(F.col("price") * SNAPSHOT_PRICE_RISE, 2))
         .otherwise(F.col("price")).alias("price"),
        F.when(d == 2, F.concat(F.col("brand"), F.lit(SNAPSHOT_BRAND_SUFFIX)))
         .otherwise(F.col("brand")).alias("brand"),
        "category_sk", "category_code")
    new_keys = cur.filter(d == 3).select(
        (F.col("product_id") + SNAPSHOT_NEW_KEY_OFFSET).alias("product_id"),
        "price", "brand", "category_sk", "category_code")
    return changed.unionByName(new_keys)


def _changed(tracked: list[str]) -> Column:
    return reduce(lambda a, b: a | b,
                  [~F.col(f"new_{c}").eqNullSafe(F.col(f"old_{c}")) for c in tracked])


def snapshot_rows(snapshot: DataFrame, key: str, values: list[str]) -> DataFrame:
    """One row per non-null key: of several rows of a key the one with the
    greatest values (compared in order, NULL smallest)."""
    return (snapshot.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*values)).alias("_s"))
            .select(key, *[F.col(f"_s.{c}").alias(c) for c in values]))


def scd2_detect(dim: DataFrame, snapshot: DataFrame, key: str, tracked: list[str],
                sk: str = "product_sk", carry: list[str] | None = None) -> DataFrame:
    """One row per snapshot key: ``change_type`` new / changed / unchanged,
    new and old tracked values, the current version's key, number and start,
    and the ``carry`` columns of the snapshot."""
    carry = carry or []
    cur = dim.filter(F.col("is_current_version")).select(
        key, *[F.col(c).alias(f"old_{c}") for c in tracked], F.col(sk).alias("old_sk"),
        F.col("version_number").alias("old_version"), F.col("effective_from").alias("old_from"))
    new = snapshot_rows(snapshot, key, [*tracked, *carry]).select(
        key, *[F.col(c).alias(f"new_{c}") for c in tracked], *carry)
    j = new.join(cur, key, "left")
    kind = (F.when(F.col("old_sk").isNull(), F.lit("new"))
            .when(_changed(tracked), F.lit("changed"))
            .otherwise(F.lit("unchanged")))
    return j.withColumn("change_type", kind)


def scd2_apply(dim: DataFrame, snapshot: DataFrame, key: str, tracked: list[str], as_of,
               sk: str = "product_sk", carry: list[str] | None = None, load_ts=None) -> DataFrame:
    """Next version of ``dim`` after ``snapshot`` takes effect on ``as_of``.

    ``carry`` lists non-tracked snapshot columns copied to new versions
    (e.g. a denormalized category code). New surrogate keys continue after
    the current maximum (scalar subquery, no driver collect).

    A version that began on ``as_of`` itself is replaced in place (same key
    and number, no empty interval), so a corrected snapshot may be applied
    on the same day. An ``as_of`` before the start of a version that it
    would close is an error when the result is computed. The changes are
    found once and checkpointed (one row per changed or new key)."""
    carry = carry or []
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    ts = load_ts if load_ts is not None else F.current_timestamp()
    cols = dim.columns
    checkpoint_dir(dim.sparkSession)
    late = F.raise_error(F.concat(F.lit("as_of is before the current version of key "), F.col(key).cast("string")))
    det = (scd2_detect(dim, snapshot, key, tracked, sk, carry).filter(F.col("change_type") != "unchanged")
           .withColumn("change_type", F.when(F.col("change_type") == "new", F.lit("new"))
                       .when(F.col("old_from") < as_of, F.lit("changed"))
                       .when(F.col("old_from") == as_of, F.lit("same_day"))
                       .otherwise(late.cast("string")))
           .checkpoint(eager=True))
    hist = dim.filter(~F.col("is_current_version"))
    cur = dim.filter(F.col("is_current_version")).join(
        det.filter(F.col("change_type") != "new").select(key, "change_type"), key, "left")
    kept = cur.filter(F.col("change_type").isNull()).select(*cols)
    closed = (cur.filter(F.col("change_type") == "changed")
              .withColumn("effective_to", as_of)
              .withColumn("is_current_version", F.lit(False))
              .withColumn("updated_at", ts)
              .select(*cols))
    values = det.select(key, *[F.col(f"new_{c}").alias(c) for c in tracked], *carry, "change_type", "old_version")
    replaced = (dim.filter(F.col("is_current_version")).drop(*tracked, *carry)
                .join(values.filter(F.col("change_type") == "same_day").drop("change_type", "old_version"), key)
                .withColumn("updated_at", ts).select(*cols))
    fresh = (values.filter(F.col("change_type").isin("changed", "new"))
             .select(key, *tracked, *carry,
                     as_of.alias("effective_from"),
                     F.lit(OPEN_END).cast("date").alias("effective_to"),
                     F.lit(True).alias("is_current_version"),
                     (F.coalesce(F.col("old_version"), F.lit(0)) + 1).alias("version_number"),
                     ts.alias("created_at"), ts.alias("updated_at")))
    keyed = continue_keys(dim, fresh, [key], sk)
    return reduce(DataFrame.unionByName, [hist.select(*cols), kept, closed, replaced, keyed.select(*cols)])


def scd2_history(dim: DataFrame, key: str) -> DataFrame:
    """All versions of the keys that have more than one version."""
    multi = dim.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(key)
    return dim.join(multi, key, "left_semi")


def _islands(daily: DataFrame, key: str, values: list[str], extra: list[str] | None = None) -> DataFrame:
    """Collapse per-(key, day) values into versions: a version starts on the
    first day and on each day whose values differ (NULL-safe) from the
    previous day's; it ends where the next one starts (half-open)."""
    w = Window.partitionBy(key).orderBy("day")
    diff = reduce(lambda a, b: a | b,
                  [~F.col(v).eqNullSafe(F.lag(v).over(w)) for v in values])
    flagged = daily.withColumn("_start", F.when(F.lag("day").over(w).isNull() | diff, 1).otherwise(0))
    numbered = flagged.withColumn("version_number",
                                  F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    extra = extra or []
    starts = numbered.filter(F.col("_start") == 1).select(key, "version_number", "day", *values, *extra)
    wv = Window.partitionBy(key).orderBy("version_number")
    nxt = F.lead("day").over(wv)
    return starts.select(
        key, *values, *extra,
        F.col("day").alias("effective_from"),
        F.coalesce(nxt, F.lit(OPEN_END).cast("date")).alias("effective_to"),
        nxt.isNull().alias("is_current_version"),
        "version_number")


def products_from_history(bronze: DataFrame, categories: DataFrame, load_ts=None) -> DataFrame:
    """Product versions from the event history: each day's last observed
    price / brand / category (cleaned) per product; a new version on every
    day those differ from the day before.

    The per-(product, day) reduction is a ``max_by`` aggregate (partial
    aggregation before the shuffle), so the windows only see one row per
    product per day however hot a product is."""
    ev = bronze.filter(F.col("product_id").isNotNull() & F.col("event_date").isNotNull())
    daily = (ev.groupBy("product_id", F.col("event_date").alias("day"))
             .agg(F.max_by(F.struct("price", "brand", "category_code"),
                           F.struct("event_time", "event_id")).alias("_v"))
             .select("product_id", "day",
                     clean_price("_v.price").alias("price"),
                     clean_brand("_v.brand").alias("brand"),
                     F.col("_v.category_code").alias("category_code")))
    daily = lookup(daily, categories, "category_code", "category_full_path", "category_sk")
    versions = _islands(daily, "product_id", ["price", "brand", "category_sk", "category_code"])
    keyed = dense_key(versions, ["product_id", "version_number"], "product_sk")
    ts = load_ts if load_ts is not None else F.current_timestamp()
    return keyed.select("product_sk", "product_id", "brand", "price", "category_sk", "category_code",
                        "effective_from", "effective_to", "is_current_version", "version_number",
                        ts.alias("created_at"), ts.alias("updated_at"))


def users_from_history(bronze: DataFrame, power: int = SEGMENT_POWER_MIN,
                       engaged: int = SEGMENT_ENGAGED_MIN, load_ts=None) -> DataFrame:
    """User segment versions: the segment implied by the running event count
    at the end of each active day; a new version on each day it changes."""
    per_day = (bronze.filter(F.col("user_id").isNotNull() & F.col("event_date").isNotNull())
               .groupBy("user_id", F.col("event_date").alias("day"))
               .agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("user_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    running = per_day.withColumn("events_to_date", F.sum("n").over(w).cast("long"))
    daily = running.withColumn("user_segment", segment("events_to_date", power, engaged))
    versions = _islands(daily.select("user_id", "day", "user_segment",
                                     F.col("events_to_date").alias("events_at_start")),
                        "user_id", ["user_segment"], extra=["events_at_start"])
    keyed = dense_key(versions, ["user_id", "version_number"], "user_sk")
    ts = load_ts if load_ts is not None else F.current_timestamp()
    return keyed.select("user_sk", "user_id", "user_segment", "events_at_start", "effective_from",
                        "effective_to", "is_current_version", "version_number",
                        ts.alias("created_at"), ts.alias("updated_at"))
