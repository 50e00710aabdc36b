"""Dimension lookups and the point-in-time (SCD2 interval) join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

UNKNOWN_SK = -1
OPEN_END = "9999-12-31"


def lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, sk: str,
           out: str | None = None, unknown: int = UNKNOWN_SK, bounded: bool = False) -> DataFrame:
    """Left-join ``dim`` on ``fact_key == dim_key`` and add ``coalesce(sk, -1)``.

    ``bounded=True`` marks a dimension whose size is bounded by construction
    (e.g. a calendar: one row per day) and broadcasts it; otherwise Spark's
    adaptive planner broadcasts at run time only if the measured size is
    under the threshold, and falls back to a shuffle join (with skewed
    partitions split) beyond it.
    """
    out = out or sk
    d = dim.select(F.col(dim_key).alias("_lk_key"), F.col(sk).alias("_lk_sk"))
    if bounded:
        d = F.broadcast(d)
    j = fact.join(d, fact[fact_key] == d["_lk_key"], "left")
    return (j.withColumn(out, F.coalesce(F.col("_lk_sk"), F.lit(unknown)))
             .drop("_lk_key", "_lk_sk"))


def point_in_time(fact: DataFrame, dim: DataFrame, key: str, at: str, cols: dict[str, str],
                  frm: str = "effective_from", to: str = "effective_to",
                  unknown: dict[str, int] | None = None) -> DataFrame:
    """As-of interval join: for each fact row pick the ``dim`` version of the
    same ``key`` whose half-open interval ``[frm, to)`` contains ``fact[at]``.

    ``cols`` maps dim column -> output column. Columns listed in ``unknown``
    get that default when no version matches (other columns stay NULL).
    Planned as an equi-join on ``key`` with the interval test as a residual
    condition (no nested loop); a hot key is split by adaptive skew handling.
    """
    unknown = unknown or {}
    sel = [F.col(key).alias("_pit_key"), F.col(frm).alias("_pit_from"), F.col(to).alias("_pit_to")]
    sel += [F.col(c).alias(f"_pit_{c}") for c in cols]
    d = dim.select(*sel)
    cond = ((fact[key] == d["_pit_key"]) & (fact[at] >= d["_pit_from"]) & (fact[at] < d["_pit_to"]))
    j = fact.join(d, cond, "left")
    for c, name in cols.items():
        v = F.col(f"_pit_{c}")
        if name in unknown:
            v = F.coalesce(v, F.lit(unknown[name]))
        j = j.withColumn(name, v)
    return j.drop("_pit_key", "_pit_from", "_pit_to", *[f"_pit_{c}" for c in cols])


def point_in_time_bucketed(fact: DataFrame, dim: DataFrame, key: str, at: str, cols: dict[str, str], frm: str = "effective_from",
                           to: str = "effective_to", unknown: dict[str, int] | None = None, width_days: int = 32) -> DataFrame:
    """``point_in_time`` for keys with many versions: time is cut into
    buckets of ``width_days``, a version stands in every bucket between its
    bounds (open ends stop at the fact's last day), and rows meet on (key,
    bucket). An event is compared with the versions of its own bucket only,
    at most one more than start in it, however many the key has; a hot key
    falls apart into its buckets. Same rows as ``point_in_time`` (intervals
    of a key may not overlap).

    Work: events x versions per bucket, plus versions x buckets they span."""
    unknown = unknown or {}
    bounds = fact.agg(F.min(F.to_date(at)).alias("lo"), F.max(F.to_date(at)).alias("hi")).select(F.struct("lo", "hi")).scalar()

    def bucket(day: Column) -> Column:
        return F.floor(F.unix_date(day) / width_days)
    d = dim.select(F.col(key).alias("_pit_key"), F.col(frm).alias("_pit_from"), F.col(to).alias("_pit_to"),
                   *[F.col(c).alias(f"_pit_{c}") for c in cols], bounds.alias("_pit_b"))
    first = F.greatest(F.to_date("_pit_from"), F.col("_pit_b.lo"))
    last = F.least(F.to_date("_pit_to"), F.col("_pit_b.hi"))
    d = d.filter(first <= last).withColumn("_pit_bucket", F.explode(F.sequence(bucket(first), bucket(last)))).drop("_pit_b")
    f = fact.withColumn("_pit_mine", bucket(F.to_date(at)))
    j = f.join(d, (F.col(key) == F.col("_pit_key")) & (F.col("_pit_mine") == F.col("_pit_bucket"))
               & (F.col(at) >= F.col("_pit_from")) & (F.col(at) < F.col("_pit_to")), "left")
    for c, name in cols.items():
        v = F.col(f"_pit_{c}")
        j = j.withColumn(name, F.coalesce(v, F.lit(unknown[name])) if name in unknown else v)
    return j.drop("_pit_key", "_pit_from", "_pit_to", "_pit_mine", "_pit_bucket", *[f"_pit_{c}" for c in cols])
