"""Batch pipeline job: raw events -> bronze -> silver star schema -> gold
marts, each layer written as Parquet under an output root.

    spark-submit lakemart/pipeline.py --csv 's3://bucket/raw/*.csv' --out s3://bucket/lake
    python -m lakemart.pipeline --tables /root/testdata/sf0.1 --out /tmp/run-x/lake

Every stage reads the previous stage's written table, so a failed stage is
re-run from its inputs and the lineage of each job stays short. Dense-key
steps checkpoint to the session's ``spark.checkpoint.dir`` (shared storage
on a cluster).
"""

from __future__ import annotations

import argparse
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .functions.columns import SEGMENT_ENGAGED_MIN, SEGMENT_POWER_MIN
from .operators import quality as Q
from .operators.io import (append_table, merge_bronze, partitioned_layout, remove_table, rows_of_days, swap_in, write_bronze,
                           write_table)
from .plans import increment as I, marts, scd2, star as S
from .session import checkpoint_dir, get_spark
from .sources.events import bronze_from_tables, read_events_csv, with_lineage

MARTS = ("gold_daily", "gold_user", "gold_product", "gold_category", "gold_brand", "gold_funnel",
         "gold_session", "gold_cohort")
DIMENSIONS = ("dim_date", "dim_categories", "dim_products", "dim_users", "dim_user_versions")


def _p(root: str, name: str) -> str:
    return os.path.join(root, name)


def with_event_id(raw: DataFrame, cols: list[str]) -> DataFrame:
    """``event_id``: the MD5 of all raw columns and an occurrence number, so
    exact duplicate rows stay apart and ids do not collide at scale. Only
    identical rows share a window group."""
    digest = F.md5(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).cast("binary"))
    nth = F.row_number().over(Window.partitionBy("_digest").orderBy(F.lit(1)))
    return (raw.withColumn("_digest", digest).withColumn("event_id", F.concat(F.col("_digest"), F.lit("-"), nth.cast("string")))
            .drop("_digest"))


def read_batch(spark: SparkSession, csv: str | None = None, tables: str | None = None, load_ts: Column | None = None) -> DataFrame:
    """Raw CSV files (explicit schema) or the test tables, in bronze form."""
    if not csv:
        return bronze_from_tables(spark, tables, load_ts)
    raw = read_events_csv(spark, csv)
    return with_event_id(with_lineage(raw, load_ts), raw.columns)


def build_bronze(spark: SparkSession, out: str, csv: str | None = None, tables: str | None = None,
                 load_ts: Column | None = None) -> DataFrame:
    """The initial load: the input's days, partitioned by event date."""
    write_bronze(read_batch(spark, csv, tables, load_ts), _p(out, "bronze"))
    return spark.read.parquet(_p(out, "bronze"))


def build_silver(spark: SparkSession, out: str, bronze: DataFrame, power: int = SEGMENT_POWER_MIN,
                 engaged: int = SEGMENT_ENGAGED_MIN, load_ts: Column | None = None) -> dict[str, DataFrame]:
    """The state per day, calendar, categories, product versions from the
    state, users and their segment versions, the fact (partitioned by event
    date, time-clustered), then the cells that the marts add up."""
    write_table(S.dim_date(spark, bronze), _p(out, "dim_date"))
    write_table(S.dim_categories(bronze, load_ts), _p(out, "dim_categories"))
    write_bronze(I.product_days(bronze), _p(out, "product_days"), order_col="product_id")
    write_bronze(I.user_days(bronze), _p(out, "user_days"), order_col="user_id")
    write_table(scd2.products_from_history(bronze, _read(spark, out, "dim_categories"), load_ts), _p(out, "dim_products"))
    write_table(S.dim_users(bronze, power, engaged, load_ts), _p(out, "dim_users"))
    write_table(scd2.users_from_history(bronze, power, engaged, load_ts), _p(out, "dim_user_versions"))
    dims = {n: _read(spark, out, n) for n in DIMENSIONS}
    fact = S.fact_events(bronze, dims["dim_date"], dims["dim_users"], dims["dim_products"], load_ts)
    write_table(partitioned_layout(fact, "event_date", "event_time"), _p(out, "fact_events"), ["event_date"])
    dims["fact_events"] = _read(spark, out, "fact_events")
    return dims | write_cells(spark, out, dims["fact_events"])


def _read(spark: SparkSession, out: str, name: str) -> DataFrame:
    return spark.read.parquet(_p(out, name))


def write_cells(spark: SparkSession, out: str, fact: DataFrame) -> dict[str, DataFrame]:
    """The marts' partials of the days in ``fact``, in place of those stored
    for these days: cells, and the users' counts of distinct event times."""
    write_bronze(marts.reduce_cells(fact), _p(out, "cells"), order_col="user_sk")
    write_bronze(marts.user_months(fact, by=("event_date",)), _p(out, "user_activity"), order_col="user_sk")
    return {n: _read(spark, out, n) for n in ("cells", "user_activity")}


def gold_builders(silver: dict[str, DataFrame], load_ts: Column | None = None) -> dict:
    """Builders of the marts, from the stored cells where ``silver`` has
    them, else from the fact."""
    fact, dates, users = silver.get("cells", silver["fact_events"]), silver["dim_date"], silver["dim_users"]
    products, cats = silver["dim_products"], silver["dim_categories"]
    return {
        "gold_daily": lambda: marts.gold_daily(fact, dates, users, load_ts),
        "gold_user": lambda: marts.gold_user(fact, users, load_ts=load_ts),
        "gold_product": lambda: marts.gold_product(fact, products, cats, load_ts),
        "gold_category": lambda: marts.gold_category(fact, cats, load_ts),
        "gold_brand": lambda: marts.gold_brand(fact, products, cats, load_ts),
        "gold_funnel": lambda: marts.gold_funnel(fact, products, cats, dates, load_ts),
        "gold_session": lambda: marts.gold_session(fact, dates, load_ts=load_ts),
        "gold_cohort": lambda: marts.gold_cohort(silver.get("user_activity", silver["fact_events"]), load_ts=load_ts),
    }


def build_gold(spark: SparkSession, out: str, silver: dict[str, DataFrame], only: list[str] | None = None,
               load_ts: Column | None = None) -> dict[str, DataFrame]:
    result = {}
    for name, build in gold_builders(silver, load_ts).items():
        if only and name not in only:
            continue
        write_table(build(), _p(out, name))
        result[name] = spark.read.parquet(_p(out, name))
    return result


def maintain(spark: SparkSession, out: str, batch: DataFrame, power: int = SEGMENT_POWER_MIN, engaged: int = SEGMENT_ENGAGED_MIN,
             only: list[str] | None = None, load_ts: Column | None = None) -> dict[str, DataFrame]:
    """A later load over a lake of ``build_silver``. The batch may hold any
    days, whole or in part, late or new, and undated rows; after any order of
    loads the lake equals a full build but for surrogate keys.

    1. The batch is merged into bronze; the state of its days is recomputed.
    2. New category paths are keyed after the known ones; versions of the
       batch's products and users are spliced, its users' totals renewed.
    3. Facts and cells are rewritten for the batch's days and for those days
       on which a product of the batch now resolves to another version.
    4. The marts are added up from the cells.

    The days of step 3 are noted in ``pending_days`` before a dimension is
    replaced, and the note goes when all is written: a load that broke off
    is made good by the next one. Tables are written beside the old ones and
    swapped in, day partitions replaced by dynamic overwrite."""
    missing = [c for c in ("event_id", "event_time", "event_date", "event_type", "product_id", "category_code", "brand", "price", "user_id", "user_session")
               if c not in batch.columns]
    if missing:
        raise ValueError(f"the batch lacks {missing}")
    staged, pending = f"{_p(out, 'batch')}-{uuid.uuid4().hex}", _p(out, "pending_days")
    batch.write.parquet(staged)
    batch = spark.read.parquet(staged)
    merge_bronze(spark, batch, _p(out, "bronze"))
    bronze = _read(spark, out, "bronze")
    days = batch.select("event_date").distinct()
    touched = rows_of_days(bronze, days)
    write_bronze(I.product_days(touched), _p(out, "product_days"), order_col="product_id")
    write_bronze(I.user_days(touched), _p(out, "user_days"), order_col="user_id")
    old = {n: _read(spark, out, n) for n in DIMENSIONS}
    by_product, by_user = _read(spark, out, "product_days"), _read(spark, out, "user_days")

    write_table(S.dim_date(spark, bronze), _p(out, "dim_date"))
    write_table(I.add_categories(old["dim_categories"], batch, load_ts), _p(out, "dim_categories"))
    cats = _read(spark, out, "dim_categories")
    products = _p(out, f"dim_products.new-{uuid.uuid4().hex}")
    I.splice_products(old["dim_products"], by_product, batch, cats, load_ts).write.parquet(products)
    moved = I.changed_days(old["dim_products"], spark.read.parquet(products), by_product, batch)
    append_table(days.unionByName(moved).distinct(), pending)
    swap_in(spark, products, _p(out, "dim_products"))
    write_table(I.update_users(old["dim_users"], by_user, batch, power, engaged, load_ts), _p(out, "dim_users"))
    write_table(I.splice_users(old["dim_user_versions"], by_user, batch, power, engaged, load_ts), _p(out, "dim_user_versions"))

    silver = {n: _read(spark, out, n) for n in DIMENSIONS}
    again = spark.read.parquet(pending).distinct()
    write_bronze(S.fact_events(rows_of_days(bronze, again), silver["dim_date"], silver["dim_users"], silver["dim_products"], load_ts),
                 _p(out, "fact_events"))
    silver["fact_events"] = _read(spark, out, "fact_events")
    silver |= write_cells(spark, out, rows_of_days(silver["fact_events"], again))
    result = build_gold(spark, out, silver, only, load_ts)
    result |= build_quality(spark, out, silver)
    for done in (pending, staged):
        remove_table(spark, done)
    return result


def build_quality(spark: SparkSession, out: str, silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Checks over the written tables: key resolution, type 2 invariants,
    row counts."""
    tables = {"quality_keys": Q.fk_resolution(silver["fact_events"], ["date_sk", "user_sk", "product_sk", "category_sk"]),
              "quality_products": Q.scd2_invariants(silver["dim_products"], "product_id"),
              "quality_users": Q.scd2_invariants(silver["dim_user_versions"], "user_id"),
              "quality_rows": Q.row_counts(silver)}
    for name, df in tables.items():
        write_table(df, _p(out, name))
    return {name: spark.read.parquet(_p(out, name)) for name in tables}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="raw event CSV files (glob)")
    src.add_argument("--tables", help="folder with the events / part Parquet tables")
    ap.add_argument("--out", required=True, help="output root (shared storage on a cluster)")
    ap.add_argument("--maintain", action="store_true", help="merge the input into the lake at --out")
    ap.add_argument("--marts", nargs="*", choices=MARTS, help="only these marts")
    ap.add_argument("--power", type=int, default=SEGMENT_POWER_MIN)
    ap.add_argument("--engaged", type=int, default=SEGMENT_ENGAGED_MIN)
    args = ap.parse_args(argv)
    spark = get_spark()
    checkpoint_dir(spark)
    if args.maintain:
        maintain(spark, args.out, read_batch(spark, args.csv, args.tables), args.power, args.engaged, args.marts)
        return
    bronze = build_bronze(spark, args.out, args.csv, args.tables)
    silver = build_silver(spark, args.out, bronze, args.power, args.engaged)
    build_gold(spark, args.out, silver, args.marts)


if __name__ == "__main__":
    main()
