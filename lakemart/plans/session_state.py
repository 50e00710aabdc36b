"""Incremental sessions from a state table, without the event history.

The state has one row per session: (user, session_number, session_start,
session_end). A known session is a chain of events no further apart than the
gap, so for numbering it is one interval: new events, cut into buckets as
wide as the gap (two events of one bucket are always in one session), are
merged with the user's intervals, and a session opens where an interval
starts more than the gap after everything before it has ended. Known sessions
are never split by new events, only joined, extended or renumbered.

So the look-back is bounded: of a user's state only the sessions that end
less than a gap before the batch's first event or later are read into the
window, and the event history is read only where a number changed, on the
days of the sessions concerned (``renumber``: a literal range of days, which
prunes a history partitioned by day). Loads in time order read no history.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window, functions as F

from ..operators.windows import sessionize


class SessionLoad(NamedTuple):
    events: DataFrame     # the new events plus session_number
    moves: DataFrame      # (user, old_number, session_number, session_start, session_end) of known sessions whose number changed
    state: DataFrame      # the whole state after the load


def session_state(numbered: DataFrame, user: str = "user_sk") -> DataFrame:
    """The state of events that carry ``session_number``."""
    return (numbered.filter(F.col("session_number").isNotNull()).groupBy(user, "session_number")
            .agg(F.min("event_time").alias("session_start"), F.max("event_time").alias("session_end")))


def load_sessions(state: DataFrame, new_events: DataFrame, user: str = "user_sk", gap_s: int = 1800) -> SessionLoad:
    """Number ``new_events`` (late ones too) against ``state``. Events
    without user or time are kept with a NULL number. Gaps are whole-second
    differences, as in ``sessionize``."""
    second = F.unix_timestamp("event_time")
    keyed = new_events.withColumn("_bkt", F.floor(second / gap_s))
    buckets = (keyed.filter(F.col(user).isNotNull() & F.col("_bkt").isNotNull()).groupBy(user, "_bkt")
               .agg(F.min("event_time").alias("session_start"), F.max("event_time").alias("session_end")))
    early = buckets.groupBy(user).agg(F.unix_timestamp(F.min("session_start")).alias("_from"))
    mine = state.join(early, user)
    before = F.unix_timestamp("session_end") < F.col("_from") - gap_s
    base = mine.filter(before).groupBy(user).agg(F.max("session_number").alias("_base"))
    known = mine.filter(~before).select(user, F.lit(None).cast("long").alias("_bkt"), "session_start", "session_end",
                                        F.col("session_number").alias("old_number"))
    spans = known.unionByName(buckets.withColumn("old_number", F.lit(None).cast("long")))
    order = Window.partitionBy(user).orderBy("session_start", "session_end")
    ended = F.max(F.unix_timestamp("session_end")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(ended.isNull() | (F.unix_timestamp("session_start") - ended > gap_s), 1).otherwise(0)
    spans = spans.withColumn("_open", opens).withColumn(
        "_local", F.sum("_open").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = (spans.join(base, user, "left")
             .withColumn("session_number", (F.col("_local") + F.coalesce("_base", F.lit(0))).cast("long"))
             .select(user, "_bkt", "session_start", "session_end", "old_number", "session_number"))
    numbers = spans.filter(F.col("_bkt").isNotNull()).select(user, "_bkt", "session_number")
    events = keyed.join(numbers, [user, "_bkt"], "left").drop("_bkt").select(*new_events.columns, "session_number")
    moves = spans.filter(F.col("old_number") != F.col("session_number")).select(
        user, "old_number", "session_number", "session_start", "session_end")
    again = spans.groupBy(user, "session_number").agg(F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"))
    kept = state.join(early, user, "left").filter(F.col("_from").isNull() | before).select(*again.columns)
    return SessionLoad(events, moves, kept.unionByName(again))


def renumber(history: DataFrame, moves: DataFrame, user: str = "user_sk", day: str = "event_date") -> DataFrame:
    """Rows of ``history`` (with ``session_number`` and ``day``) whose number
    changes, with the new one. The moved sessions' range of days goes into
    the scan as a literal filter; without moves nothing is read."""
    lo, hi = moves.agg(F.to_date(F.min("session_start")), F.to_date(F.max("session_end"))).first()
    within = F.lit(False) if lo is None else F.col(day).between(F.lit(lo), F.lit(hi))
    new = moves.select(F.col(user).alias("_user"), F.col("old_number").alias("_old"), F.col("session_number").alias("_new"))
    rows = history.filter(within).join(new, (F.col(user) == F.col("_user")) & (F.col("session_number") == F.col("_old")))
    return rows.withColumn("session_number", F.col("_new")).select(*history.columns)


def start_state(events: DataFrame, user: str = "user_sk", gap_s: int = 1800) -> tuple[DataFrame, DataFrame]:
    """Numbered events of a first load and their state."""
    numbered = sessionize(events, user, "event_time", gap_s)
    return numbered, session_state(numbered, user)
