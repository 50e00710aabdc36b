"""The batch pipeline job end to end (tables and raw CSV input)."""
import os

from pyspark.sql import functions as F

from conftest import SMOKE
from lakemart import pipeline
from lakemart.schemas import RAW_EVENT
from lakemart.sources.events import bronze_from_tables


def test_pipeline_from_tables(spark, tmp_path):
    out = str(tmp_path / "lake")
    pipeline.main(["--tables", SMOKE, "--out", out, "--marts", "gold_daily", "gold_cohort"])
    assert spark.read.parquet(os.path.join(out, "fact_events")).count() == 1000
    assert spark.read.parquet(os.path.join(out, "gold_daily")).count() == 30
    assert not os.path.exists(os.path.join(out, "gold_user"))


def test_pipeline_from_raw_csv(spark, tmp_path):
    raw = bronze_from_tables(spark, SMOKE).select(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss 'UTC'").alias("event_time"),
        *[f.name for f in RAW_EVENT.fields if f.name != "event_time"])
    raw.coalesce(2).write.option("header", True).csv(str(tmp_path / "raw"))
    out = str(tmp_path / "lake")
    pipeline.main(["--csv", str(tmp_path / "raw" / "*.csv"), "--out", out, "--marts", "gold_daily"])
    bronze = spark.read.parquet(os.path.join(out, "bronze"))
    assert bronze.count() == 1000 and bronze.filter(F.col("event_time").isNull()).count() == 0
    assert bronze.select("event_id").distinct().count() == 1000
    assert spark.read.parquet(os.path.join(out, "gold_daily")).agg(F.sum("total_events")).first()[0] == 1000
