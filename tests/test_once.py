"""Costly steps run once, however many columns and filters read them."""
from pyspark.sql import functions as F

from lakemart.schemas import STREAM_BRONZE, conform
from lakemart.streaming import parse_events, tag_events, with_stream_metadata


def _raw(spark):
    rows = ['{"event_id":"1","event_type":"view","user_id":1,"product_id":2,"category_id":3,"event_time":"2024-01-01T00:00:00"}', "{bad", None]
    return spark.createDataFrame([(r,) for r in rows], "value string").select(F.col("value").cast("binary"))


def _parses(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json(")


def test_messages_are_parsed_once(spark):
    good, bad = parse_events(_raw(spark))
    assert (_parses(good), _parses(bad)) == (1, 1)
    assert (good.count(), bad.count()) == (1, 2)


def test_a_contract_check_parses_once(spark):
    rows = with_stream_metadata(tag_events(_raw(spark)).select("data.*", F.col("_ts").alias("_t")).withColumn("event_time", F.col("_t")).drop("_t"))
    for part, n in zip(conform(rows, STREAM_BRONZE), (1, 2)):
        part = part.select(F.lit(1).alias("ok"))
        assert _parses(part) == 1 and part.count() == n
