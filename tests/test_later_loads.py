"""Later loads: whatever the order of loads, the lake equals a full build."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE
from lakemart import pipeline
from lakemart.operators.io import merge_bronze, rows_of_days, write_bronze
from lakemart.operators.joins import point_in_time, point_in_time_bucketed
from lakemart.plans import increment
from lakemart.sources.events import bronze_from_tables

POWER, ENGAGED = 8, 4
TS = "2024-02-01 00:00:00"
#: Surrogate keys depend on the order of loads; rows are compared without.
KEYS = {"product_sk", "category_sk", "user_sk", "created_at", "updated_at"}


def ts():
    return F.lit(TS).cast("timestamp")


def events(spark):
    """Prices, brands and categories that change and change back, products
    and categories that come later, users that grow, undated rows."""
    t0 = dt.datetime(2024, 1, 1, 10)
    rows = []
    for day in range(9):
        for p in range(6):
            if (day + p) % 3 == 0 or p == 0:
                continue_path = None if p == 5 else f"c{(day // (p + 2)) % 3}.{p % 2}"
                for k, kind in enumerate(("view", "cart", "purchase")[: 1 + (day + p) % 3]):
                    rows.append((len(rows), t0 + dt.timedelta(days=day, minutes=7 * p + k), kind, p, continue_path, ("A ", "b", None)[(day + p) // 4 % 3],
                                 float(10 + p + day // 4), day % 4 if p else 7, f"s{day}"))
    rows += [(1000, None, "view", 1, "zz.1", "x", 3.0, 1, None), (1001, None, "purchase", 77, "zz.2", "x", 3.0, 99, None),
             (1002, t0 + dt.timedelta(days=4), "purchase", 40, "aa.first", "new", 5.0, 3, "s"), (1003, t0 + dt.timedelta(days=8), "view", None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "event_id long, event_time timestamp, event_type string, product_id long, category_code string, brand string, "
                                     "price double, user_id long, user_session string")
    return df.withColumn("event_date", F.to_date("event_time")).withColumn("source_file", F.lit("x")).withColumn("ingestion_timestamp", ts())


def build(spark, out, df, marts=False):
    write_bronze(df, f"{out}/bronze")
    silver = pipeline.build_silver(spark, out, spark.read.parquet(f"{out}/bronze"), POWER, ENGAGED, ts())
    if marts:
        pipeline.build_gold(spark, out, silver, load_ts=ts())
    return out


def content(spark, out, name):
    df = spark.read.parquet(f"{out}/{name}")
    cols = sorted(c for c in df.columns if c not in KEYS)
    if name == "fact_events":  # by what the keys stand for
        p = spark.read.parquet(f"{out}/dim_products").select("product_sk", F.struct("product_id", "effective_from", "price", "brand").alias("product"))
        c = spark.read.parquet(f"{out}/dim_categories").select("category_sk", "category_full_path")
        u = spark.read.parquet(f"{out}/dim_users").select("user_sk", "user_id", "user_segment")
        df, cols = df.join(p, "product_sk", "left").join(c, "category_sk", "left").join(u, "user_sk", "left"), [*cols, "product", "category_full_path", "user_id", "user_segment"]
    return sorted((tuple(r) for r in df.select(cols).collect()), key=repr)


TABLES = ("dim_date", "dim_categories", "dim_products", "dim_users", "dim_user_versions", "fact_events", "product_days", "user_days", *pipeline.MARTS)


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory):
    out = build(spark, str(tmp_path_factory.mktemp("full")), events(spark), True)
    return {t: content(spark, out, t) for t in TABLES}


def day(n):
    return F.col("event_date") == F.lit(dt.date(2024, 1, 1) + dt.timedelta(days=n))


@pytest.mark.parametrize("order", ["in_order", "late_day_last", "partial_days"])
def test_any_order_of_loads_equals_a_full_build(spark, tmp_path, full, order):
    df, undated = events(spark), F.col("event_date").isNull()
    parts = {"in_order": [df.filter((F.col("event_date") < "2024-01-05") | undated), df.filter(day(4) | day(5)), df.filter(F.col("event_date") > "2024-01-06")],
             "late_day_last": [df.filter((~(day(0) | day(3) | day(4))) | (undated & (F.col("event_id") == 1000))), df.filter(day(4) | (undated & (F.col("event_id") == 1001))),
                               df.filter(day(3)), df.filter(day(0))],
             "partial_days": [df.filter("event_id % 2 = 0"), df.filter("event_id % 4 = 3"), df.filter("event_id % 4 = 1"), df.filter("event_id % 4 = 1")]}[order]
    out = build(spark, str(tmp_path / "lake"), parts[0])
    some = pipeline.MARTS if order == "late_day_last" else ("gold_daily",)
    for i, part in enumerate(parts[1:], 2):
        got = pipeline.maintain(spark, out, part, POWER, ENGAGED, list(some) if i == len(parts) else ["gold_daily"], ts())
        for q in ("quality_products", "quality_users"):
            i = got[q].first()
            assert (i.keys_without_one_current, i.empty_intervals, i.gaps_or_overlaps, i.version_breaks) == (0, 0, 0, 0)
    for t in TABLES:
        if t not in pipeline.MARTS or t in some:
            assert content(spark, out, t) == full[t], t
    for d, k in (("dim_products", "product_sk"), ("dim_users", "user_sk"), ("dim_user_versions", "user_sk"), ("dim_categories", "category_sk")):
        x = spark.read.parquet(f"{out}/{d}")
        assert x.count() == x.select(k).distinct().count()
    import os
    assert not [f for f in os.listdir(out) if f.startswith(("batch-", "pending")) or ".new-" in f or ".old-" in f]


def test_keys_and_untouched_days_stay(spark, tmp_path):
    import os
    df = events(spark)
    out = build(spark, str(tmp_path / "lake"), df.filter(~day(8)))
    before = {t: {(r[0], r[1]) for r in spark.read.parquet(f"{out}/{t}").select(*k).collect()}
              for t, k in (("dim_categories", ("category_full_path", "category_sk")), ("dim_users", ("user_id", "user_sk")))}
    versions = {(r.product_id, r.effective_from): r.product_sk for r in spark.read.parquet(f"{out}/dim_products").collect()}
    files = {d: os.listdir(f"{out}/fact_events/{d}") for d in os.listdir(f"{out}/fact_events") if d.startswith("event_date=")}
    pipeline.maintain(spark, out, df.filter(day(8)), POWER, ENGAGED, ["gold_daily"])
    for t, k in (("dim_categories", ("category_full_path", "category_sk")), ("dim_users", ("user_id", "user_sk"))):
        assert before[t] <= {(r[0], r[1]) for r in spark.read.parquet(f"{out}/{t}").select(*k).collect()}
    now = {(r.product_id, r.effective_from): r.product_sk for r in spark.read.parquet(f"{out}/dim_products").collect()}
    assert all(now[k] == v for k, v in versions.items())
    same = [d for d in files if files[d] == os.listdir(f"{out}/fact_events/{d}")]
    assert len(same) == len(files)                           # a new last day rewrites no other day


def test_broken_load_is_made_good(spark, tmp_path, full, monkeypatch):
    """A late load that stops before the fact is written."""
    df = events(spark)
    out = build(spark, str(tmp_path / "lake"), df.filter(~day(3) | F.col("event_date").isNull()))
    with monkeypatch.context() as m:
        m.setattr(pipeline.S, "fact_events", lambda *a: (_ for _ in ()).throw(RuntimeError("stop")))
        with pytest.raises(RuntimeError, match="stop"):
            pipeline.maintain(spark, out, df.filter(day(3)), POWER, ENGAGED, ["gold_daily"], ts())
    pipeline.maintain(spark, out, df.filter(day(3)), POWER, ENGAGED, ["gold_daily"], ts())
    for t in ("dim_products", "fact_events", "gold_daily"):
        assert content(spark, out, t) == full[t], t


def test_marts_read_the_cells_alone(spark, tmp_path):
    out = build(spark, str(tmp_path / "lake"), events(spark))
    silver = {n: spark.read.parquet(f"{out}/{n}") for n in (*pipeline.DIMENSIONS, "fact_events", "cells", "user_activity")}
    for name, make in pipeline.gold_builders(silver).items():
        plan = make()
        if name != "gold_product":  # ranks are checkpointed
            assert "fact_events" not in " ".join(plan.inputFiles()), name
    one = rows_of_days(silver["fact_events"], spark.createDataFrame([(dt.date(2024, 1, 3),), (None,)], "event_date date"))
    from lakemart.plans import marts
    scan = marts.reduce_cells(one)._jdf.queryExecution().sparkPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "2024-01-03" in scan and "isnull" in scan


def test_undated_rows_survive_a_merge(spark, tmp_path):
    out = str(tmp_path / "bronze")
    df = events(spark)
    write_bronze(df.filter("event_id in (1, 2, 1000)"), out)
    for _ in range(2):
        merge_bronze(spark, df.filter("event_id in (3, 1001)"), out)
        assert {r.event_id for r in spark.read.parquet(out).collect()} == {1, 2, 3, 1000, 1001}


def test_bucketed_point_in_time_join(spark):
    base = dt.date(2023, 1, 1)
    versions = [(k, base + dt.timedelta(days=3 * i), base + dt.timedelta(days=3 * i + 3) if i < 199 else dt.date(9999, 12, 31), i) for k in (1, 2) for i in range(200)]
    dim = spark.createDataFrame(versions, "k int, effective_from date, effective_to date, v int")
    fact = spark.createDataFrame([(i, i % 4, base + dt.timedelta(days=(i * 37) % 900 - 20)) for i in range(500)] + [(900, None, base), (901, 1, None)], "id int, k int, d date")
    a = point_in_time(fact, dim, "k", "d", {"v": "v"}, unknown={"v": -1})
    for width in (1, 32, 5000):
        b = point_in_time_bucketed(fact, dim, "k", "d", {"v": "v"}, unknown={"v": -1}, width_days=width)
        assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
    empty = point_in_time_bucketed(fact.limit(0), dim, "k", "d", {"v": "v"})
    assert empty.collect() == []


def test_changed_days_are_exactly_those(spark):
    days = spark.createDataFrame([(1, 1.0, "a", "x", dt.date(2024, 1, d)) for d in (1, 2, 5, 9)] + [(2, 1.0, "a", "x", dt.date(2024, 1, 5))],
                                 "product_id long, price double, brand string, category_code string, event_date date")
    end = dt.date(9999, 12, 31)
    old = spark.createDataFrame([(1, 1, 1.0, 5, dt.date(2024, 1, 1), end), (2, 2, 1.0, 5, dt.date(2024, 1, 5), end)],
                                "product_sk long, product_id long, price double, category_sk int, effective_from date, effective_to date")
    new = spark.createDataFrame([(1, 1, 1.0, 5, dt.date(2024, 1, 1), dt.date(2024, 1, 3)), (3, 1, 2.0, 5, dt.date(2024, 1, 3), dt.date(2024, 1, 6)),
                                 (4, 1, 1.0, 5, dt.date(2024, 1, 6), end), (9, 2, 1.0, 5, dt.date(2024, 1, 5), end)], old.schema)
    got = increment.changed_days(old, new, days, spark.createDataFrame([(1,), (None,)], "product_id long")).collect()
    assert sorted(r[0] for r in got) == [dt.date(2024, 1, 5), dt.date(2024, 1, 9)]
