"""Physical-plan properties that matter at scale (checked on the executed
plan, so adaptive re-planning is included)."""
import re

from conftest import SMOKE
from lakemart.operators.windows import latest_per_key, sessionize
from lakemart.plans import marts
from lakemart.queries.common import star


def _plan(df) -> str:
    """The final adaptive plan: run this Dataset's own execution first."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _single_partition_windows(plan: str) -> int:
    final = plan.split("== Initial Plan ==")[0]          # adaptive plans print both
    return len(re.findall(r"Exchange SinglePartition", final))


def test_event_scan_reads_only_needed_columns(spark):
    s = star(spark, SMOKE)
    plan = s.fact.select("event_id", "event_type")._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert scans and all("value" not in cols for cols in scans)     # price column not read


def test_calendar_lookup_is_broadcast(spark):
    plan = _plan(star(spark, SMOKE).fact)
    assert "BroadcastHashJoin" in plan and "BroadcastNestedLoopJoin" not in plan


def test_sessionize_has_no_event_level_sort_or_single_partition(spark, tmp_path):
    star(spark, SMOKE).fact.select("user_sk", "event_id", "event_time").write.parquet(str(tmp_path / "f"))
    fact = spark.read.parquet(str(tmp_path / "f"))
    plan = _plan(sessionize(fact, "user_sk", "event_time", 1800))
    assert _single_partition_windows(plan) == 0
    # the only window runs on the per-(user, bucket) aggregate
    assert plan.count("Window ") + plan.count("Window [") >= 1


def test_latest_per_key_uses_partial_aggregation(spark):
    b = star(spark, SMOKE).bronze
    plan = _plan(latest_per_key(b, "product_id", ["event_time", "event_id"], ["price"]))
    assert "partial_max_by" in plan and "Window" not in plan


def test_daily_mart_groups_on_date_key_only(spark):
    s = star(spark, SMOKE)
    plan = marts.gold_daily(s.fact, s.dates, s.users)._jdf.queryExecution().optimizedPlan().toString()
    aggs = [line for line in plan.splitlines() if "Aggregate [" in line]
    assert aggs and all("month_name" not in a for a in aggs)


def test_point_in_time_join_is_equi_join_with_residual(spark):
    s = star(spark, SMOKE)
    plan = _plan(s.fact)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert re.search(r"(SortMergeJoin|BroadcastHashJoin) .*product_id", plan)


def test_dense_keys_do_not_window_over_the_whole_dimension(spark):
    users = star(spark, SMOKE).users
    plan = _plan(users)
    # the only single-partition exchange feeds the prefix sum over the
    # per-partition row counts (one row per partition), which is broadcast
    assert _single_partition_windows(plan) <= 1 and "BroadcastExchange" in plan
    assert "Scan ExistingRDD" in plan          # numbered from the checkpointed, range-partitioned rows


def test_calendar_filter_prunes_fact_partitions(spark, tmp_path):
    from lakemart.operators.io import write_table
    from lakemart.plans import reports
    s = star(spark, SMOKE)
    write_table(s.fact, str(tmp_path / "fact"), ["event_date"])
    fact = spark.read.parquet(str(tmp_path / "fact"))
    q = reports.monthly_revenue_by_brand(fact, s.dates, s.products, 2024)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_hot_product_is_split_by_adaptive_skew_join(spark):
    """One product holds a third of all events: the point-in-time join runs
    as a sort-merge join whose hot partition AQE splits into several tasks
    (thresholds lowered to test scale, broadcasts off), results unchanged."""
    import datetime as dt
    from pyspark.sql import functions as F
    from lakemart.operators.joins import point_in_time
    n = 30000
    ev = spark.range(n).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("product_id"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 30).cast("int")).alias("event_date"))
    dim = spark.range(1000).select(
        F.col("id").alias("product_id"), F.lit(dt.date(2023, 1, 1)).alias("effective_from"),
        F.lit(dt.date(9999, 12, 31)).alias("effective_to"), (F.col("id") + 1).alias("product_sk"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        j = point_in_time(ev, dim, "product_id", "event_date", {"product_sk": "product_sk"},
                          unknown={"product_sk": -1})
        plan = _plan(j)
        final = plan.split("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true)" in final and "AQEShuffleRead skewed" in final
        assert j.filter(F.col("product_sk") == 8).count() == ev.filter(F.col("product_id") == 7).count()
        assert j.filter(F.col("product_sk") == -1).count() == 0
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
