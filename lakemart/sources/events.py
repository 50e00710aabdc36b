"""Event sources: the raw CSV reader and the mapping of the given test tables
onto the shop-event model (bronze layer)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import RAW_EVENT, RAW_TIME_FORMAT
from .tables import load

# Fixed values of the test-data mapping (event type renames; the modulo
# rules that seed missing / blank brands, missing categories and
# missing / negative prices so that every cleaning branch is exercised).
EVENT_TYPE_MAP = {"click": "cart", "error": "remove_from_cart"}
NULL_BRAND_MOD = 7
BLANK_BRAND_MOD = 11
CATEGORY_DEPTH_MOD = 5
CATEGORY_ID_MOD = 25
NULL_PRICE_MOD = 97
NEGATIVE_PRICE_MOD = 89

BRONZE_COLUMNS = ["event_id", "event_time", "event_type", "product_id", "category_id",
                  "category_code", "brand", "price", "user_id", "user_session",
                  "ingestion_timestamp", "source_file", "event_date"]


def read_events_csv(spark: SparkSession, path: str, schema=RAW_EVENT,
                    time_format: str = RAW_TIME_FORMAT) -> DataFrame:
    """Scan raw event CSV files (glob allowed) with an explicit schema.

    ``schema=None`` reads every column as a string (no inference pass).
    ``event_time`` is parsed with ``try_to_timestamp`` so malformed values
    become NULL instead of failing the job.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    if schema is not None:
        df = df.withColumn("event_time", F.try_to_timestamp("event_time", F.lit(time_format)))
    return df


def with_lineage(df: DataFrame, load_ts: Column | None = None, file_col: Column | None = None) -> DataFrame:
    """Add bronze lineage columns: load time, source file and event date."""
    return (df
            .withColumn("ingestion_timestamp", load_ts if load_ts is not None else F.current_timestamp())
            .withColumn("source_file", file_col if file_col is not None else F.col("_metadata.file_path"))
            .withColumn("event_date", F.to_date("event_time")))


def bronze_from_tables(spark: SparkSession, sf_dir: str, load_ts: Column | None = None) -> DataFrame:
    """Bronze events derived from the ``events`` and ``part`` tables.

    Every column is a plain expression, so the plan is one scan of ``events``
    joined to the (pruned) ``part`` scan; Spark chooses broadcast or
    sort-merge at run time from the measured size of ``part``. The scanned
    rows are dealt anew first: a file of few row groups is read by few tasks,
    which would otherwise do all the work that follows.
    """
    ev = load(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props",
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("source_file"))
    ev = ev.repartition("event_id", "ts").select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"), "source_file")
    part = load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("k"),
        F.lower("p_type").alias("ptype"),
        F.lower(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("w1"),
        F.lower(F.split_part("p_name", F.lit(" "), F.lit(2))).alias("w2"),
        F.col("p_brand"))
    j = ev.join(part, "k", "left")
    k = F.col("k")
    depth = k % CATEGORY_DEPTH_MOD
    category = (F.when(depth == 0, F.lit(None).cast("string"))
                .when(depth == 1, F.col("ptype"))
                .when(depth == 2, F.concat_ws(".", "ptype", "w2"))
                .otherwise(F.concat_ws(".", "ptype", "w2", "w1")))
    # concat_ws skips NULLs; a product missing from ``part`` must stay NULL.
    category = F.when(F.col("ptype").isNull(), F.lit(None).cast("string")).otherwise(category)
    brand = (F.when(k % NULL_BRAND_MOD == 0, F.lit(None).cast("string"))
             .when(k % BLANK_BRAND_MOD == 0, F.lit("  "))
             .otherwise(F.concat(F.lit(" "), F.col("p_brand"))))
    price = (F.when(F.col("event_id") % NULL_PRICE_MOD == 0, F.lit(None).cast("double"))
             .when(F.col("event_id") % NEGATIVE_PRICE_MOD == 0, -F.col("value"))
             .otherwise(F.col("value")))
    event_time = F.col("ts").cast("timestamp")
    etype = F.col("event_type")
    mapped_type = etype
    for src, dst in EVENT_TYPE_MAP.items():
        mapped_type = F.when(etype == src, F.lit(dst)).otherwise(mapped_type)
    out = j.select(
        F.col("event_id"),
        event_time.alias("event_time"),
        mapped_type.alias("event_type"),
        k.alias("product_id"),
        (k % CATEGORY_ID_MOD).alias("category_id"),
        category.alias("category_code"),
        brand.alias("brand"),
        price.alias("price"),
        F.col("user_id"),
        F.concat_ws("-", F.col("user_id").cast("string"),
                    F.to_date(event_time).cast("string")).alias("user_session"),
        (load_ts if load_ts is not None else F.current_timestamp()).alias("ingestion_timestamp"),
        F.col("source_file"),
        F.to_date(event_time).alias("event_date"),
    )
    return out


def events_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events of the order star (orders x lineitem): one row per
    order line, user = customer, product = part, basket = order."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("event_id"),
        F.col("o_orderkey").alias("basket_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        F.lit("purchase").alias("event_type"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
    )
