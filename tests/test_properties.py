"""Property tests: the scale-oriented operators equal their brute-force
single-window formulations on random inputs (ties, exact-gap intervals,
empty partitions)."""
import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from lakemart.operators.windows import ntile_global, row_index, sessionize

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
BASE = dt.datetime(2024, 1, 1, 23, 0, 0)

events = st.lists(
    st.tuples(st.integers(0, 3),                                      # user (hot users likely)
              st.sampled_from([0, 1, 59, 900, 1799, 1800, 1801, 3600, 7200])),   # gap to previous
    min_size=1, max_size=60)


@SETTINGS
@given(events, st.sampled_from([600, 1800, 3600]))
def test_sessionize_equals_lag_and_running_sum(spark, rows, gap):
    t, data = BASE, []
    for i, (u, step) in enumerate(rows):
        t = t + dt.timedelta(seconds=step)
        data.append((u, i, t))
    df = spark.createDataFrame(data, "u int, id int, t timestamp")
    got = sorted(sessionize(df, "u", "t", gap).select("id", "session_number").collect())
    w = Window.partitionBy("u").orderBy("t", "id")
    sec = F.unix_timestamp("t")
    flag = F.when(F.lag(sec).over(w).isNull() | (sec - F.lag(sec).over(w) > gap), 1).otherwise(0)
    want = sorted(df.withColumn("f", flag)
                  .select("id", F.sum("f").over(w.rowsBetween(Window.unboundedPreceding, 0))
                          .cast("long").alias("session_number")).collect())
    assert got == want


@SETTINGS
@given(st.lists(st.integers(0, 5), min_size=1, max_size=80), st.integers(1, 9))
def test_row_index_and_ntile_equal_window_functions(spark, keys, parts):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, id int")
    w = Window.orderBy(F.desc("k"), "id")
    got = sorted(row_index(df, [F.desc("k"), F.asc("id")], "rn", num_partitions=parts)
                 .select("id", "rn").collect())
    want = sorted(df.select("id", F.row_number().over(w).cast("long").alias("rn")).collect())
    assert got == want
    got_t = sorted(ntile_global(df, [F.desc("k"), F.asc("id")], 4, "t").select("id", "t").collect())
    want_t = sorted(df.select("id", F.ntile(4).over(w).alias("t")).collect())
    assert got_t == want_t
