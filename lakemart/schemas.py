"""Table contracts: raw CSV events, stream events, and ``conform``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# Raw shop-event CSV layout (one row per event).
RAW_EVENT = T.StructType([
    T.StructField("event_time", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("category_id", T.LongType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_session", T.StringType()),
])

# Format of ``event_time`` in the raw CSV files.
RAW_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss z"

# JSON payload of one stream event (ids as wide as in the bronze table).
STREAM_EVENT = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("product_id", T.LongType(), False),
    T.StructField("category_id", T.LongType(), False),
    T.StructField("event_time", T.StringType(), False),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("quantity", T.IntegerType(), True),
    T.StructField("revenue", T.DoubleType(), True),
])

# Stream bronze table contract (NOT NULL where the table declares it).
STREAM_BRONZE = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("product_id", T.LongType(), False),
    T.StructField("category_id", T.LongType(), False),
    T.StructField("event_time", T.TimestampType(), False),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("quantity", T.IntegerType(), True),
    T.StructField("revenue", T.DoubleType(), True),
    T.StructField("batch_id", T.IntegerType(), True),
    T.StructField("produced_at", T.TimestampType(), True),
    T.StructField("processed_time", T.TimestampType(), False),
    T.StructField("source", T.StringType(), True),
])

EVENT_TYPES = ("view", "cart", "remove_from_cart", "purchase")


def conform(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Project ``df`` onto ``schema`` (missing columns become NULL, types are
    cast with ``try_cast`` so bad values turn NULL instead of failing).

    Returns ``(good, quarantine)``: rows violating a NOT NULL field go to
    quarantine with a ``violations`` array naming the offending columns.
    """
    cols = []
    for field in schema.fields:
        if field.name in df.columns:
            cols.append(F.col(field.name).try_cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    typed = df.select(*cols)
    required = [f.name for f in schema.fields if not f.nullable]
    if not required:
        return typed, typed.limit(0).withColumn("violations", F.array().cast("array<string>"))
    flags = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]),
                     lambda x: x.isNotNull())
    tagged = typed.withColumn("violations", flags)
    good = tagged.filter(F.size("violations") == 0).drop("violations")
    bad = tagged.filter(F.size("violations") > 0)
    return good, bad
