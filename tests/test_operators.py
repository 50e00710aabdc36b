"""Operators against brute-force window formulations and edge cases."""
import datetime as dt
import random

from pyspark.sql import Window, functions as F

from lakemart.functions.columns import money_avg, round_half_up, safe_rate
from lakemart.operators.joins import point_in_time
from lakemart.operators.windows import (latest_per_key, ntile_global, row_index, row_number_by_time,
                                        sessionize)


def test_row_index_matches_row_number(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, id int")
    got = row_index(df, ["k", "id"], "rn", num_partitions=7)
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("k", "id")))
    assert sorted(got.select("id", "rn").collect()) == sorted(want.select("id", "rn").collect())


def test_row_index_descending_and_empty_partitions(spark):
    df = spark.createDataFrame([(i,) for i in range(5)], "x int")
    got = row_index(df, [F.desc("x")], "rn", num_partitions=16).orderBy("rn").collect()
    assert [r.x for r in got] == [4, 3, 2, 1, 0] and [r.rn for r in got] == [1, 2, 3, 4, 5]


def test_ntile_global_matches_ntile(spark):
    for n in (7, 23, 3):
        df = spark.createDataFrame([(i % 4, i) for i in range(n)], "k int, id int")
        got = ntile_global(df, ["k", "id"], 5, "t")
        want = df.withColumn("t", F.ntile(5).over(Window.orderBy("k", "id")))
        assert sorted(got.select("id", "t").collect()) == sorted(want.select("id", "t").collect())


def _brute_sessions(df, gap):
    w = Window.partitionBy("u").orderBy("t")
    sec = F.unix_timestamp("t")
    d = df.withColumn("g", sec - F.lag(sec).over(w))
    flag = F.when(F.col("g").isNull() | (F.col("g") > gap), 1).otherwise(0)
    return d.withColumn("sn", F.sum(flag).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def test_sessionize_edges(spark):
    base = dt.datetime(2024, 1, 1, 23, 40, 0)
    times = [base, base + dt.timedelta(seconds=1800),          # gap exactly 1800 -> same session
             base + dt.timedelta(seconds=3601),                 # gap 1801 -> new session
             base + dt.timedelta(seconds=3601),                 # same second
             base + dt.timedelta(hours=5)]                      # next day, new session
    rows = [(1, i, t) for i, t in enumerate(times)] + [(2, 10, base)]
    df = spark.createDataFrame(rows, "u int, id int, t timestamp")
    got = {r.id: r.session_number for r in sessionize(df, "u", "t", 1800).collect()}
    assert got == {0: 1, 1: 1, 2: 2, 3: 2, 4: 3, 10: 1}


def test_sessionize_matches_brute_force_hot_user(spark):
    rnd = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = []
    t = start
    for i in range(3000):                                     # one hot user over many buckets
        t = t + dt.timedelta(seconds=rnd.choice([5, 60, 900, 1799, 1800, 1801, 4000]))
        rows.append((0 if i % 3 else rnd.randint(1, 20), i, t))
    df = spark.createDataFrame(rows, "u int, id int, t timestamp")
    got = sessionize(df, "u", "t", 1800).select("id", F.col("session_number").alias("sn"))
    want = _brute_sessions(df, 1800).select("id", F.col("sn").cast("long"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_row_number_by_time(spark):
    rnd = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    rows = [("a" if i % 4 else "b", i, start + dt.timedelta(minutes=rnd.randint(0, 3000))) for i in range(500)]
    df = spark.createDataFrame(rows, "s string, id int, t timestamp")
    got = row_number_by_time(df, "s", "t", "id", "rn", bucket_s=1800)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("s").orderBy("t", "id")).cast("long"))
    assert sorted(got.select("id", "rn").collect()) == sorted(want.select("id", "rn").collect())


def test_latest_per_key_tie_break(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t, 1, 5.0), (1, t, 2, 6.0), (2, t, 3, 1.0)], "p int, t timestamp, e int, v double")
    got = {r.p: r.v for r in latest_per_key(df, "p", ["t", "e"], ["v"]).collect()}
    assert got == {1: 6.0, 2: 1.0}


def test_point_in_time_versioned_products(spark):
    """Six-row versioned product fixture, half-open intervals."""
    d = dt.date
    dim = spark.createDataFrame([
        (1, 100, 10.0, d(2019, 10, 1), d(2019, 11, 16)), (2, 100, 12.0, d(2019, 11, 16), d(9999, 12, 31)),
        (3, 200, 5.0, d(2019, 10, 1), d(9999, 12, 31)), (4, 300, 8.0, d(2019, 10, 1), d(2019, 10, 21)),
        (5, 300, 9.0, d(2019, 10, 21), d(9999, 12, 31)), (6, 400, 15.0, d(2019, 10, 1), d(9999, 12, 31))],
        "sk long, pid int, price double, effective_from date, effective_to date")
    ev = spark.createDataFrame([(1, 100, d(2019, 11, 15)), (2, 100, d(2019, 11, 16)), (3, 300, d(2019, 10, 20)),
                                (4, 300, d(2019, 10, 21)), (5, 500, d(2019, 10, 5)), (6, 100, d(2019, 9, 30))],
                               "e int, pid int, day date")
    got = {r.e: (r.sk, r.price) for r in
           point_in_time(ev, dim, "pid", "day", {"sk": "sk", "price": "price"}, unknown={"sk": -1}).collect()}
    assert got == {1: (1, 10.0), 2: (2, 12.0), 3: (4, 8.0), 4: (5, 9.0), 5: (-1, None), 6: (-1, None)}


def test_rates_and_rounding(spark):
    df = spark.createDataFrame([(0, 0, 28.28), (3, 0, 28.29), (1, 8, None)], "a long, b long, x double")
    r = df.select(safe_rate("a", "b").alias("r")).collect()
    assert [x.r for x in r] == [None, None, 12.5]
    assert df.agg(money_avg("x").alias("m")).first().m == 28.29
    assert spark.range(1).select(round_half_up(F.lit(395.99) / 14).alias("v")).first().v == 28.29


def test_share_overall_and_within_group(spark):
    from lakemart.operators.windows import share
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 4.0), ("c", 0.0)], "g string, v double")
    assert sorted(r.v_share for r in share(df, "v").collect()) == [0.0, 12.5, 37.5, 50.0]
    within = {(r.g, r.v): r.v_share for r in share(df, "v", part="g").collect()}
    assert within[("a", 1.0)] == 25.0 and within[("b", 4.0)] == 100.0 and within[("c", 0.0)] is None


def test_session_rows_split_at_midnight(spark):
    """A session crossing midnight gives one row per date (same session
    number), as the daily session mart counts it on both days."""
    from lakemart.plans.marts import session_rows
    rows = [(1, dt.datetime(2024, 1, 1, 23, 50), "view", 20240101, 0.0, 10, 1),
            (1, dt.datetime(2024, 1, 2, 0, 10), "purchase", 20240102, 5.5, 11, 1),
            (1, dt.datetime(2024, 1, 2, 0, 15), "view", 20240102, 0.0, 10, 2),
            (1, dt.datetime(2024, 1, 2, 3, 0), "cart", 20240102, 0.0, 12, 2),      # gap > 30 min
            (2, dt.datetime(2024, 1, 2, 0, 0), "view", 20240102, 0.0, 10, 1)]
    fact = spark.createDataFrame(rows, "user_sk long, event_time timestamp, event_type string, date_sk int, "
                                       "revenue double, product_sk long, category_sk long")
    got = {(r.user_sk, r.session_number, r.date_sk):
           (r.total_events_in_session, r.had_purchase, r.had_cart_action, r.session_revenue,
            r.unique_products_in_session, r.unique_categories_in_session)
           for r in session_rows(fact, 1800).collect()}
    assert got == {(1, 1, 20240101): (1, 0, 0, 0.0, 1, 1),
                   (1, 1, 20240102): (2, 1, 0, 5.5, 2, 2),
                   (1, 2, 20240102): (1, 0, 1, 0.0, 1, 1),
                   (2, 1, 20240102): (1, 0, 0, 0.0, 1, 1)}


def test_zero_revenue_share_and_negative_dropoff(spark):
    from lakemart.plans.marts import gold_category, gold_funnel
    d = dt.date(2024, 1, 1)
    fact = spark.createDataFrame([
        (1, 1, 1, 20240101, dt.datetime(2024, 1, 1, 10), "cart", 0.0, 0),     # cart without a view
        (2, 1, 1, 20240101, dt.datetime(2024, 1, 1, 11), "purchase", 0.0, 1),
        (3, 2, 2, 20240101, dt.datetime(2024, 1, 1, 12), "view", 0.0, 0)],
        "event_id long, user_sk long, category_sk long, date_sk int, event_time timestamp, event_type string, "
        "revenue double, quantity int").withColumn("product_sk", F.col("category_sk"))
    cats = spark.createDataFrame([(1, "a", None, None, "a", 1), (2, "b", None, None, "b", 1)],
                                 "category_sk long, category_l1 string, category_l2 string, category_l3 string, "
                                 "category_full_path string, category_depth int")
    shares = {r.category_sk: r.revenue_share_within_l1 for r in gold_category(fact, cats).collect()}
    assert shares == {1: None, 2: None}                    # zero revenue in the group: NULL, no error
    products = spark.createDataFrame([(1, True), (2, True)], "product_sk long, is_current_version boolean")
    dates = spark.createDataFrame([(20240101, d)], "date_key int, full_date date")
    f = {r.category_l1: r for r in gold_funnel(fact, products, cats, dates).collect()}
    assert f["a"].users_dropped_at_cart == -1 and f["a"].view_to_cart_user_rate is None
