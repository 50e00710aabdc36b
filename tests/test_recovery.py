"""Loads and publishes that must not lose rows: partial days, failed writes,
NULL keys, totals beyond one event's range, wide ids, lazy dimensions."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE
from lakemart import pipeline
from lakemart.functions.columns import round_half_up, total_avg, total_sum
from lakemart.operators.io import compact, merge_bronze, write_bronze, write_table
from lakemart.operators.quality import scd2_invariants
from lakemart.operators.windows import dense_rank_in, row_number_by_time, running_total, sessionize
from lakemart.plans import features, reports, scd2
from lakemart.plans.star import star_from_tables
from lakemart.schemas import STREAM_EVENT
from lakemart.sources.events import bronze_from_tables
from lakemart.streaming import parse_events


def test_partial_day_load_keeps_the_rest_of_the_day(spark, tmp_path):
    out = str(tmp_path / "bronze")
    b = bronze_from_tables(spark, SMOKE)
    day = b.filter(F.col("event_date") == "2024-01-02")
    first, rest = day.filter("event_id % 2 = 0"), day.filter("event_id % 2 = 1")
    write_bronze(b.filter(F.col("event_date") == "2024-01-03").unionByName(first), out)
    n = spark.read.parquet(out).count()
    for _ in range(2):                                       # a replayed batch changes nothing
        merge_bronze(spark, rest, out)
        back = spark.read.parquet(out)
        assert back.count() == n + rest.count()
        assert back.select("event_id").distinct().count() == back.count()


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "mart")
    write_table(spark.range(5), path)
    with pytest.raises(Exception, match="stop here"):
        write_table(spark.range(9).withColumn("x", F.raise_error(F.lit("stop here"))), path)
    assert spark.read.parquet(path).count() == 5
    write_table(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7
    assert [f for f in os.listdir(tmp_path) if ".old-" in f] == []


def test_compaction_splits_a_heavy_partition(spark, tmp_path):
    src, dst = str(tmp_path / "s"), str(tmp_path / "d")
    df = spark.range(9000).select("id", F.when(F.col("id") < 8000, "hot").otherwise("cold").alias("p"))
    df.repartition(30).write.partitionBy("p").parquet(src)
    assert compact(spark, src, dst, 8, ["p"]).count() == 9000
    assert len([f for f in os.listdir(f"{dst}/p=hot") if f.endswith(".parquet")]) >= 4


def test_null_keys_are_kept(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, 1, t), (2, None, t), (3, 1, None), (4, 1, t + dt.timedelta(hours=1)), (5, None, None)]
    df = spark.createDataFrame(rows, "event_id int, user_sk int, event_time timestamp")
    got = {r.event_id: r.session_number for r in sessionize(df).collect()}
    assert got == {1: 1, 2: None, 3: None, 4: 2, 5: None}
    got = {r.event_id: r.rn for r in row_number_by_time(df, "user_sk", "event_time", "event_id").collect()}
    assert got == {1: 1, 2: None, 3: None, 4: 2, 5: None}


def test_totals_beyond_one_events_range(spark):
    df = spark.createDataFrame([("a", 2.5e12), ("b", 9e12)], "k string, v double")
    r = df.agg(total_sum("v").alias("s"), total_avg("v").alias("a")).first()
    assert (r.s, r.a) == (11.5e12, 5.75e12)
    daily = spark.createDataFrame([(2024, 1, "January", 5, 2.5e13, 1.0, 1.0)],
                                  "year int, month int, month_name string, total_purchases long, total_revenue double, avg_order_value double, overall_conversion_rate double")
    assert reports.revenue_trend(daily).first().revenue == 2.5e13


def test_rounding_at_half_way_points(spark):
    vals = [395.98999999999995 / 14, 0.125, 2.675, 1.005, -0.125, 1e9 + 0.005, 28.2849999]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "v double").select(round_half_up("v")).collect()]
    assert got == [28.29, 0.13, 2.68, 1.01, -0.13, 1e9 + 0.01, 28.28]


def test_wide_ids_are_valid_messages(spark):
    assert all(STREAM_EVENT[c].dataType.simpleString() == "bigint" for c in ("user_id", "product_id", "category_id"))
    msg = ('{"event_id":"1","event_type":"view","user_id":3000000000,"product_id":1,"category_id":9000000000,'
           '"event_time":"2024-01-01T00:00:00.000000","price":1.0}')
    # the columns a Kafka source delivers
    kafka = spark.createDataFrame([(b"k", msg.encode(), "t", 0, 7)], "key binary, value binary, topic string, partition int, offset long")
    good, bad = parse_events(kafka)
    assert good.first().category_id == 9000000000 and bad.count() == 0


def _jobs(spark) -> int:
    ids = spark.sparkContext.statusTracker().getJobIdsForGroup("lazy-star")
    return len(ids)


def test_bronze_readers_start_no_dimension_job(spark, tmp_path):
    from lakemart.queries.reports_q import q_event_total_count
    from lakemart.queries.stream_q import q_tumbling_metrics
    for t in ("events", "part"):                             # a folder no star was built for
        spark.read.parquet(f"{SMOKE}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    spark.sparkContext.setJobGroup("lazy-star", "x")
    try:
        q_event_total_count(spark, str(tmp_path))
        q_tumbling_metrics(spark, str(tmp_path))
        built = vars(star_from_tables(spark, str(tmp_path), 72, 62))
        assert not {"dates", "categories", "products", "users", "fact"} & set(built)
        assert _jobs(spark) <= 8                             # reading Parquet footers only
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_star_follows_its_input_files(spark, tmp_path):
    def put(n):
        spark.read.parquet(f"{SMOKE}/part.parquet").write.mode("overwrite").parquet(f"{tmp_path}/part.parquet")
        spark.read.parquet(f"{SMOKE}/events.parquet").limit(n).write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
    put(10)
    assert star_from_tables(spark, str(tmp_path)).bronze.count() == 10
    put(20)
    assert star_from_tables(spark, str(tmp_path)).bronze.count() == 20


def test_marts_do_not_expand_events(spark):
    from lakemart.plans import marts
    from lakemart.queries.common import star
    s = star(spark, SMOKE)
    frames = [marts.gold_daily(s.fact, s.dates, s.users), marts.gold_user(s.fact, s.users), marts.gold_category(s.fact, s.categories),
              marts.gold_brand(s.fact, s.products, s.categories), marts.gold_funnel(s.fact, s.products, s.categories, s.dates),
              reports.cardinalities(s.bronze), reports.category_rollup_levels(s.fact, s.categories)]
    for f in frames:
        assert "Expand" not in f._jdf.queryExecution().optimizedPlan().toString()


def test_range_check_reads_a_mart_once(spark, tmp_path):
    from lakemart.operators.quality import range_profile
    spark.range(10).select("id", (F.col("id") * 2.5).alias("v")).write.parquet(str(tmp_path / "m"))
    got = range_profile(spark.read.parquet(str(tmp_path / "m")), ["id", "v"])
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert {r.column_name: (r.min_value, r.max_value, r.avg_value) for r in got.collect()} == {"id": (0, 9, 4.5), "v": (0, 22.5, 11.25)}


def test_same_day_and_duplicate_snapshots_keep_invariants(spark):
    from test_scd2 import AS_OF, _dim, _snapshot
    dim = _dim(spark)
    snap = _snapshot(dim)
    twice = snap.unionByName(snap.withColumn("price", F.col("price") + 1)).unionByName(
        snap.limit(1).withColumn("product_id", F.lit(None).cast("long")))
    out = scd2.scd2_apply(dim, twice, "product_id", scd2.PRODUCT_TRACKED, AS_OF, carry=["category_code"])
    again = scd2.scd2_apply(out, snap, "product_id", scd2.PRODUCT_TRACKED, AS_OF, carry=["category_code"])
    once_more = scd2.scd2_apply(again, snap, "product_id", scd2.PRODUCT_TRACKED, AS_OF, carry=["category_code"])
    for d in (out, again, once_more):
        i = scd2_invariants(d, "product_id").first()
        assert (i.keys_without_one_current, i.empty_intervals, i.gaps_or_overlaps, i.version_breaks) == (0, 0, 0, 0)
    drop = ["created_at", "updated_at"]
    assert sorted(again.drop(*drop).collect()) == sorted(once_more.drop(*drop).collect())
    with pytest.raises(Exception, match="as_of is before"):
        scd2.scd2_apply(again, snap.withColumn("price", F.col("price") + 5), "product_id", scd2.PRODUCT_TRACKED,
                        dt.date(2019, 11, 1), carry=["category_code"]).collect()


def test_late_events_renumber_sessions(spark):
    t = dt.datetime(2024, 1, 1)
    hist = spark.createDataFrame([(1, 1, t), (1, 2, t + dt.timedelta(hours=10))], "user_sk int, event_id int, event_time timestamp")
    new = spark.createDataFrame([(1, 3, t + dt.timedelta(hours=5)), (1, 4, t + dt.timedelta(hours=10, minutes=5)), (2, 5, t)],
                                "user_sk int, event_id int, event_time timestamp")
    got = {r.event_id: r.session_number for r in features.incremental_sessions(sessionize(hist), new).collect()}
    assert got == {2: 3, 3: 2, 4: 3, 5: 1}                   # the history row 2 moves to session 3


def test_running_total_and_dense_rank(spark):
    df = spark.createDataFrame([(i, (i * 7) % 5, f"g{i % 3}" if i % 4 else None) for i in range(1, 200)], "k int, n int, g string")
    got = {r.k: r.t for r in running_total(df, "k", "n", "t", 7).collect()}
    total = 0
    for i in range(1, 200):
        total += (i * 7) % 5
        assert got[i] == total
    from pyspark.sql import Window
    want = df.withColumn("r", F.dense_rank().over(Window.partitionBy("g").orderBy(F.desc("n"))))
    assert sorted(map(tuple, dense_rank_in(df, "g", "n", "r").collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_approximate_price_percentiles(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("price"))
    exact, about = reports.price_statistics(df).first(), reports.price_statistics(df, exact=False).first()
    assert (exact.median_price, exact.p95_price) == (500.0, 950.0)
    assert abs(about.median_price - 500) <= 2 and abs(about.p95_price - 950) <= 2


def test_maintenance_run(spark, tmp_path):
    out = str(tmp_path / "lake")
    b = bronze_from_tables(spark, SMOKE)
    days = sorted(r[0] for r in b.select("event_date").distinct().collect())
    old = b.filter((F.col("event_date") < F.lit(days[-3])) | ((F.col("event_date") == F.lit(days[-3])) & (F.col("event_id") % 2 == 0)))
    new = b.join(old.select("event_id"), "event_id", "left_anti")
    write_bronze(old, f"{out}/bronze")
    pipeline.build_silver(spark, out, spark.read.parquet(f"{out}/bronze"))
    for _ in range(2):                                       # a replay leaves the same lake
        got = pipeline.maintain(spark, out, new, only=["gold_daily"])
        assert spark.read.parquet(f"{out}/fact_events").count() == b.count()
        q = got["quality_products"].first()
        assert (q.keys_without_one_current, q.empty_intervals, q.gaps_or_overlaps, q.version_breaks) == (0, 0, 0, 0)
        users = spark.read.parquet(f"{out}/dim_users")
        assert users.count() == users.select("user_sk").distinct().count() == b.select("user_id").distinct().count()
        assert spark.read.parquet(f"{out}/gold_daily").agg(F.sum("total_events")).first()[0] == b.count()
