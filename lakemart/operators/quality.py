"""Data-quality operators: row counts, null counts, range checks,
mart-vs-fact reconciliation, foreign-key resolution, SCD2 invariants.
Each check is one aggregate pass producing a small frame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import round_half_up


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: (table_name, row_count)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: null count and percent of rows (one aggregate pass, then
    an unpivot of the single result row)."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    wide = df.agg(*aggs)
    long = wide.unpivot("_total", cols, "column_name", "null_count")
    return long.select("column_name", "null_count",
                       round_half_up(F.col("null_count") * 100.0 / F.col("_total")).alias("null_pct"))


def range_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: min, max and avg (rounded to 2), as doubles. One
    aggregate pass, then an unpivot of the single result row."""
    wide = df.agg(*[F.struct(F.min(c).cast("double").alias("min_value"), F.max(c).cast("double").alias("max_value"),
                             round_half_up(F.avg(F.col(c).cast("double"))).alias("avg_value")).alias(c) for c in cols])
    long = wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in cols])).alias("x"))
    return long.select("x.column_name", "x.v.min_value", "x.v.max_value", "x.v.avg_value")


def reconcile(mart_totals: DataFrame, fact_totals: DataFrame, label_mart: str = "Gold Table",
              label_fact: str = "Fact Table", flag: bool = True) -> DataFrame:
    """UNION ALL of two one-row totals with a ``source`` label; with
    ``flag``, a ``matches`` column true when every measure agrees (the
    window spans the two rows only)."""
    a = mart_totals.select(F.lit(label_mart).alias("source"), "*")
    b = fact_totals.select(F.lit(label_fact).alias("source"), "*")
    both = a.unionByName(b)
    if not flag:
        return both
    measures = [c for c in mart_totals.columns]
    same = reduce(lambda x, y: x & y,
                  [F.min(c).over(Window.partitionBy()).eqNullSafe(F.max(c).over(Window.partitionBy()))
                   for c in measures])
    return both.withColumn("matches", same)


def fk_resolution(fact: DataFrame, keys: list[str], unknown: int = -1) -> DataFrame:
    """Total rows and rows whose surrogate key resolved (!= unknown)."""
    aggs = [F.count(F.lit(1)).alias("total_events")]
    aggs += [F.count_if(F.col(k) != unknown).alias(f"valid_{k}") for k in keys]
    return fact.agg(*aggs)


def version_summary(dim: DataFrame, name: str) -> DataFrame:
    return dim.agg(F.count(F.lit(1)).alias("total_rows"),
                   F.count_if(F.col("is_current_version")).alias("current_versions"),
                   F.count_if(~F.col("is_current_version")).alias("historical_versions")) \
              .select(F.lit(name).alias("dimension"), "*")


def scd2_invariants(dim: DataFrame, key: str, frm: str = "effective_from", to: str = "effective_to",
                    version: str = "version_number") -> DataFrame:
    """One row of SCD2 invariant violations (all zero when healthy):
    keys without exactly one current version, empty or inverted intervals,
    gaps / overlaps between consecutive versions, non-consecutive version
    numbers."""
    w = Window.partitionBy(key).orderBy(frm)
    prev_to = F.lag(to).over(w)
    prev_ver = F.lag(version).over(w)
    rows = dim.select(key, frm, to, version, "is_current_version",
                      prev_to.alias("_prev_to"), prev_ver.alias("_prev_ver"))
    per_key = rows.groupBy(key).agg(
        F.count_if(F.col("is_current_version")).alias("_cur"),
        F.count_if(F.col(frm) >= F.col(to)).alias("_bad_interval"),
        F.count_if(F.col("_prev_to").isNotNull() & (F.col("_prev_to") != F.col(frm))).alias("_gap"),
        F.count_if(F.col("_prev_ver").isNotNull() & (F.col(version) != F.col("_prev_ver") + 1)).alias("_ver"),
    )
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("_cur") != 1).alias("keys_without_one_current"),
        F.sum("_bad_interval").cast("long").alias("empty_intervals"),
        F.sum("_gap").cast("long").alias("gaps_or_overlaps"),
        F.sum("_ver").cast("long").alias("version_breaks"),
    )
