"""Stream sources.

The event parser accepts any frame with a binary/string ``value`` column,
which is what the Kafka source produces, so the same code runs on a Kafka
topic, on a folder of JSON/Parquet files, or on a batch frame (tests).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_event_stream(spark: SparkSession, fmt: str, path: str | None = None,
                      schema=None, **options) -> DataFrame:
    """``readStream`` for ``fmt`` in {kafka, parquet, json, text, ...}.

    Kafka options (``kafka.bootstrap.servers``, ``subscribe``,
    ``startingOffsets``, ``maxOffsetsPerTrigger``) are passed through; file
    sources take ``maxFilesPerTrigger`` and need ``schema``.
    """
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path) if path else reader.load()


def stream_events_from_bronze(bronze: DataFrame, corrupt_mod: int | None = None) -> DataFrame:
    """Encode bronze rows as stream messages: a binary JSON ``value`` with
    the stream event fields (quantity 1 for cart/purchase, revenue = price
    for purchases), plus a ``key`` of the user id, like a Kafka record.

    ``corrupt_mod`` truncates the message of every event whose id is a
    multiple of it (malformed JSON, to exercise quarantine routing)."""
    qty = F.when(F.col("event_type").isin("cart", "purchase"), 1).otherwise(0)
    rev = F.when(F.col("event_type") == "purchase", F.col("price") * qty).otherwise(F.lit(0.0))
    payload = F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_type"),
        F.col("user_id").cast("long").alias("user_id"),
        F.col("product_id").cast("long").alias("product_id"),
        F.col("category_id").cast("long").alias("category_id"),
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_time"),
        F.col("price"),
        qty.cast("int").alias("quantity"),
        rev.alias("revenue"),
    )
    text = F.to_json(payload)
    if corrupt_mod:
        text = F.when(F.col("event_id") % corrupt_mod == 0, F.substring(text, 1, 25)).otherwise(text)
    return bronze.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        text.cast("binary").alias("value"),
    )
