"""Daily user feature snapshots: one row per (user, feature date).

A rolling metric changes only on days on which something enters or leaves
its window. So no event is repeated for the days that see it: events shrink
to one row per active (user, day), each of which gives a *difference* on its
own day and the opposite difference where it leaves a window; running sums of
the differences give the metrics on every day of change, and a metric row
holds until the next change. Only that last step, the stated result itself,
has a row for each day.

Distinct sessions need no set per window: of the days of one session, each
counts from itself until it leaves the window or the session's next day takes
over, whichever comes first, so a session is never counted twice.

Windows over one user see at most one row per day of change, however many
events a hot user has.

The steps are dealt to a number of tasks that grows with the events, so the
rows that one task holds do not. Events are first counted per hour, sessions
by buckets: a hot user's rows shrink in many tasks before they meet in one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import MONEY, ratio_avg, safe_rate
from .star import event_tasks

EVENT_WINDOWS = (7, 14, 30)
SESSION_WINDOWS = (7, 30)
REVENUE_WINDOWS = (7, 30, 60)
#: Names of weekdays as ``date_format(..., 'EEEE')`` gives them.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _hour(h: int) -> str:
    return f"_hour{h}"


def _weekday(d: int) -> str:
    return f"_weekday{d}"


#: Running totals, over the user's whole past; they change on active days only.
TOTALS = [*(_hour(h) for h in range(24)), *(_weekday(d) for d in range(7))]
#: What is read off the totals of an active day (weekdays as their position in alphabetical order).
HABITS = ("_favorite", "_preferred", "_weekender")
WEEKDAY_NAMES = sorted(WEEKDAYS)

#: Parts into which a user's sessions are dealt.
SESSION_BUCKETS = 64


def _dated(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("event_date").isNotNull()).withColumns({"day": F.col("event_date"), "_hour": F.hour("event_time")})


def user_day_cells(fact: DataFrame, tasks: int) -> DataFrame:
    """(user_sk, day): events by hour and weekday, purchases, exact revenue
    and the number of priced purchases. Events without a date are left out."""
    bought = F.col("event_type") == "purchase"
    hourly = (_dated(fact).select(
        "user_sk", "day", "_hour", F.weekday("event_time").alias("_weekday"), F.when(bought, 1).otherwise(0).alias("purchases"),
        F.when(bought, F.col("revenue").cast("decimal(18,6)")).alias("paid"))
        .repartition(tasks, "user_sk", "day", "_hour").groupBy("user_sk", "day", "_hour", "_weekday").agg(
            F.count(F.lit(1)).alias("events"), F.sum("purchases").alias("purchases"),
            F.sum("paid").alias("revenue"), F.count("paid").alias("priced")))

    def n(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("events")).otherwise(0)).cast("long")

    return hourly.repartition(tasks, "user_sk").groupBy("user_sk", "day").agg(
        F.sum("events").alias("events"), F.sum("purchases").alias("purchases"),
        F.coalesce(F.sum("revenue"), F.lit(0)).cast("decimal(28,6)").alias("revenue"), F.sum("priced").alias("priced"),
        *[n(F.col("_hour") == h).alias(_hour(h)) for h in range(24)],
        *[n(F.col("_weekday") == d).alias(_weekday(d)) for d in range(7)])


def _most(cols: list[str], labels: list) -> Column:
    """The label with the greatest total (ties: the smallest label)."""
    best = F.greatest(*cols)
    ordered = sorted(zip(labels, cols), key=lambda x: x[0])
    return reduce(lambda later, x: F.when(F.col(x[1]) == best, F.lit(x[0])).otherwise(later), reversed(ordered), F.lit(None))


def _with_habits(cells: DataFrame) -> DataFrame:
    """The cells' totals up to their day, as ``HABITS``."""
    until = Window.partitionBy("user_sk").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    amounts = [c for c in cells.columns if c not in TOTALS]
    so_far = cells.select(*amounts, *[F.sum(c).over(until).alias(c) for c in TOTALS])
    week = [_weekday(d) for d in range(7)]
    weekend, all_days = F.col(week[5]) + F.col(week[6]), reduce(Column.__add__, [F.col(c) for c in week])
    return so_far.select(*amounts, _most([_hour(h) for h in range(24)], list(range(24))).cast("int").alias("_favorite"),
                         _most(week, [WEEKDAY_NAMES.index(d) for d in WEEKDAYS]).alias("_preferred"),
                         (weekend * 2 > all_days).alias("_weekender"))


def _differences(cells: DataFrame) -> DataFrame:
    """Rows (user, day, differences): each cell on its day, and less the
    windowed amounts on the days on which they leave a window."""
    rolling = ([("events", k) for k in EVENT_WINDOWS] + [("revenue", k) for k in REVENUE_WINDOWS]
               + [("purchases", 30), ("priced", 30)])
    offsets = sorted({k for _, k in rolling})
    d = cells.select("*", F.explode(F.array(F.lit(0), *[F.lit(k) for k in offsets])).alias("_at"))
    entering = F.col("_at") == 0

    def moved(c: str, k: int) -> Column:
        return F.when(entering, F.col(c)).when(F.col("_at") == k, -F.col(c)).otherwise(0).cast(cells.schema[c].dataType)

    return d.select(
        "user_sk", F.date_add("day", F.col("_at")).alias("day"), F.when(entering, F.col("day")).alias("_active"),
        *[F.when(entering, F.col(c)).alias(c) for c in HABITS],
        *[moved(c, k).alias(f"{c}_{k}") for c, k in rolling])


def _session_differences(fact: DataFrame, tasks: int) -> DataFrame:
    """Rows (user, day, sessions_k) that add up to the distinct sessions of
    the last k days."""
    keys = ("user_sk", "_bucket", "user_session", "day")
    seen = (_dated(fact).filter(F.col("user_session").isNotNull())
            .select("user_sk", F.pmod(F.hash("user_session"), F.lit(SESSION_BUCKETS)).alias("_bucket"), "user_session", "day", "_hour")
            .repartition(tasks, "user_sk", "day", "_hour").distinct().select(*keys)
            .repartition(tasks, "user_sk", "_bucket").distinct())
    following = F.lead("day").over(Window.partitionBy("user_sk", "_bucket", "user_session").orderBy("day"))
    seen = seen.withColumn("_next", following)
    # a session's day is out when the window passes it, or its next day takes over
    enters = F.struct(F.col("day").alias("day"), *[F.lit(1).cast("long").alias(f"sessions_{k}") for k in SESSION_WINDOWS])
    leaves = [F.struct(F.least(F.date_add("day", k), F.col("_next")).alias("day"),
                       *[F.lit(-1 if j == k else 0).cast("long").alias(f"sessions_{j}") for j in SESSION_WINDOWS])
              for k in SESSION_WINDOWS]
    return (seen.select("user_sk", "_bucket", F.explode(F.array(enters, *leaves)).alias("_d")).select("user_sk", "_bucket", "_d.*")
            .groupBy("user_sk", "_bucket", "day").agg(*[F.sum(f"sessions_{k}").alias(f"sessions_{k}") for k in SESSION_WINDOWS])
            .drop("_bucket"))


def user_feature_changes(fact: DataFrame, last_day=None) -> DataFrame:
    """Features of each user from each day of change (``valid_from``) to the
    day before the next (``valid_to``, inclusive; the last one ends on
    ``last_day``, by default the last day of ``fact``)."""
    end = fact.select(F.max("event_date")).scalar() if last_day is None else F.lit(last_day).cast("date")
    tasks = event_tasks(fact)
    moved = _differences(_with_habits(user_day_cells(fact, tasks))).filter(F.col("day") <= end)
    sessions = _session_differences(fact, tasks).filter(F.col("day") <= end).repartition(tasks, "user_sk")
    amounts = [c for c in moved.columns if c not in ("user_sk", "day", "_active", *HABITS)]
    counted = [f"sessions_{k}" for k in SESSION_WINDOWS]
    rows = moved.unionByName(sessions, allowMissingColumns=True)  # both dealt by user
    per_day = rows.groupBy("user_sk", "day").agg(*[F.max(c).alias(c) for c in ("_active", *HABITS)], *[
        F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*amounts, *counted)])
    days = Window.partitionBy("user_sk").orderBy("day")
    until = days.rowsBetween(Window.unboundedPreceding, 0)
    state = per_day.select("user_sk", "day", F.lead("day").over(days).alias("_next"), F.max("_active").over(until).alias("_last"),
                           *[F.last(c, ignorenulls=True).over(until).alias(c) for c in HABITS],
                           *[F.sum(c).over(until).alias(c) for c in (*amounts, *counted)])
    state = state.withColumn("_end", end)

    def money(c: Column | str) -> Column:
        return F.round(c, MONEY).cast("double")

    out = state.select(
        "user_sk", F.col("day").alias("valid_from"), F.coalesce(F.least(F.date_sub("_next", 1), "_end"), F.col("_end")).alias("valid_to"),
        F.col("_last").alias("last_event_date"),
        *[F.col(f"events_{k}").cast("long").alias(f"events_last_{k}d") for k in EVENT_WINDOWS],
        *[F.col(f"sessions_{k}").cast("long").alias(f"sessions_last_{k}d") for k in SESSION_WINDOWS],
        money(F.col("revenue_7")).alias("revenue_last_7d"), money(F.col("revenue_30")).alias("revenue_last_30d"),
        F.col("purchases_30").cast("long").alias("purchases_last_30d"),
        ratio_avg("revenue_30", F.col("priced_30")).alias("avg_order_value_30d"),
        F.col("_favorite").alias("favorite_shopping_hour"),
        F.get(F.array(*[F.lit(d) for d in WEEKDAY_NAMES]), "_preferred").alias("preferred_day_of_week"),
        F.col("_weekender").alias("is_weekend_shopper"),
        (F.col("events_14") - F.col("events_7")).alias("_events_prior"), money(F.col("revenue_60") - F.col("revenue_30")).alias("_revenue_prior"))
    return out.select(
        *[c for c in out.columns if not c.startswith("_")],
        safe_rate("events_last_30d", "sessions_last_30d", scale=1.0).alias("avg_events_per_session_30d"),
        safe_rate("purchases_last_30d", "sessions_last_30d", scale=1.0).alias("conversion_rate_30d"),
        safe_rate("events_last_7d", "_events_prior", scale=1.0).alias("trend_events_7d_vs_prior_7d"),
        safe_rate("revenue_last_30d", "_revenue_prior", scale=1.0).alias("trend_revenue_30d_vs_prior_30d"))


def user_daily_features(fact: DataFrame, last_day=None) -> DataFrame:
    """One row per user and day, from the user's first day to ``last_day``."""
    changes = user_feature_changes(fact, last_day)
    daily = changes.select("*", F.explode(F.sequence("valid_from", "valid_to")).alias("feature_date"))
    return daily.select("user_sk", "feature_date", F.datediff("feature_date", "last_event_date").alias("recency_days"),
                        *[c for c in changes.columns if c not in ("user_sk", "valid_from", "valid_to", "last_event_date")])
