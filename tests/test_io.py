"""Sources, sinks and table layout."""
import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SMOKE
from lakemart.operators.io import (compact, partition_stats, sample_events, snapshot_diff, with_comments,
                                   write_bronze, write_clustered)
from lakemart.schemas import STREAM_BRONZE, conform
from lakemart.sources.events import bronze_from_tables, read_events_csv


def test_partitioned_write_replaces_only_present_days(spark, tmp_path):
    out = str(tmp_path / "bronze")
    b = bronze_from_tables(spark, SMOKE)
    write_bronze(b, out)
    days = {d for d in os.listdir(out) if d.startswith("event_date=")}
    assert len(days) == b.select("event_date").distinct().count()
    one_day = b.filter(F.col("event_date") == "2024-01-02").limit(3)
    write_bronze(one_day, out)                               # re-run of a single day
    back = spark.read.parquet(out)
    assert back.filter(F.col("event_date") == "2024-01-02").count() == 3
    assert back.count() == b.filter(F.col("event_date") != "2024-01-02").count() + 3


def test_partition_pruning_on_event_date(spark, tmp_path):
    out = str(tmp_path / "bronze")
    write_bronze(bronze_from_tables(spark, SMOKE), out)
    q = spark.read.parquet(out).filter(F.col("event_date") == "2024-01-15").groupBy("event_type").count()
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-15" in plan


def test_partition_stats(spark):
    s = partition_stats(bronze_from_tables(spark, SMOKE)).first()
    assert s.total_rows == 1000 and s.partitions == 30 and s.min_rows <= s.avg_rows <= s.max_rows


def test_compact_and_clustered_write(spark, tmp_path):
    src, dst, cl = (str(tmp_path / n) for n in ("many", "few", "clustered"))
    b = bronze_from_tables(spark, SMOKE).drop("ingestion_timestamp")
    b.repartition(40).write.parquet(src)
    c = compact(spark, src, dst, 2)
    assert len([f for f in os.listdir(dst) if f.endswith(".parquet")]) <= 2 and c.count() == 1000
    write_clustered(b, cl, ["product_id"], num_files=4)
    files = sorted(f for f in os.listdir(cl) if f.endswith(".parquet"))
    ranges = [spark.read.parquet(os.path.join(cl, f)).agg(F.min("product_id"), F.max("product_id")).first()
              for f in files]
    ranges = sorted(tuple(r) for r in ranges)
    assert all(a[1] <= b_[0] for a, b_ in zip(ranges, ranges[1:]))   # disjoint ranges -> file skipping


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None)], "k int, v double")
    new = spark.createDataFrame([(1, 1.0), (2, 2.5), (3, 3.0), (4, 4.0)], "k int, v double")
    got = {r.k: r.change for r in snapshot_diff(old, new, ["k"], ["v"]).collect()}
    assert got == {2: "changed", 3: "changed", 4: "added"}


def test_column_comments_survive_a_write(spark, tmp_path):
    df = with_comments(spark.range(3), {"id": "row id"})
    df.write.parquet(str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).schema["id"].metadata.get("comment") == "row id"


def test_csv_reader_explicit_schema(spark, tmp_path):
    p = tmp_path / "ev.csv"
    p.write_text("event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
                 "2019-10-01 00:00:00 UTC,view,1,2,a.b,x,1.5,7,s1\n"
                 "garbage,cart,1,2,,,-1,7,s1\n")
    df = read_events_csv(spark, str(p))
    rows = df.collect()
    assert rows[0].event_time == dt.datetime(2019, 10, 1) and rows[1].event_time is None
    assert read_events_csv(spark, str(p), schema=None).schema["price"].dataType.simpleString() == "string"


def test_conform_quarantines_not_null_violations(spark):
    df = spark.createDataFrame([("1", "view", 1, 1, 1, dt.datetime(2024, 1, 1)),
                                (None, "view", 1, 1, 1, dt.datetime(2024, 1, 1))],
                               "event_id string, event_type string, user_id int, product_id int, "
                               "category_id int, event_time timestamp")
    good, bad = conform(df.withColumn("processed_time", F.current_timestamp()), STREAM_BRONZE)
    assert good.count() == 1 and bad.first().violations == ["event_id"]


def test_sample_events(spark):
    b = bronze_from_tables(spark, SMOKE)
    s = sample_events(b, "event_date", dt.date(2024, 1, 15), 50, seed=1)
    assert s.count() == 50 and s.filter(F.col("event_date") < "2024-01-15").count() == 0
