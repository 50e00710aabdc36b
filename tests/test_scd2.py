"""SCD2 apply / detect / history on hand-built fixtures."""
import datetime as dt

from pyspark.sql import functions as F

from lakemart.operators.joins import point_in_time
from lakemart.operators.quality import scd2_invariants
from lakemart.plans import scd2

D0, OPEN, AS_OF = dt.date(2019, 10, 1), dt.date(9999, 12, 31), dt.date(2019, 12, 1)
IDS = [1000365, 1000978, 1001588, 1001606, 1001618, 1001619, 1001894, 1002042, 1002062, 1002098]
SCHEMA = ("product_sk long, product_id long, brand string, price double, category_sk long, category_code string, "
          "effective_from date, effective_to date, is_current_version boolean, version_number int, "
          "created_at timestamp, updated_at timestamp")


def _dim(spark):
    ts = dt.datetime(2019, 10, 1)
    rows = [(i + 1, pid, None if pid == 1002098 else "samsung", 100.0 + i, 5, "electronics.smartphone",
             D0, OPEN, True, 1, ts, ts) for i, pid in enumerate(IDS)]
    return spark.createDataFrame(rows, SCHEMA)


def _snapshot(dim):
    pid = F.col("product_id")
    snap = dim.select(
        "product_id",
        F.when(pid.isin(1000365, 1001588, 1001606), F.round(F.col("price") * 0.8, 2))
         .when(pid.isin(1001618, 1001619), F.round(F.col("price") * 1.1, 2)).otherwise(F.col("price")).alias("price"),
        F.when(pid == 1002042, F.lit("samsung_updated"))
         .when(pid == 1002098, F.lit("acme")).otherwise(F.col("brand")).alias("brand"),  # NULL -> value
        "category_sk", "category_code")
    new = dim.limit(1).select(F.lit(2000001).cast("long").alias("product_id"), F.lit(9.99).alias("price"),
                              F.lit("newco").alias("brand"), "category_sk", "category_code")
    return snap.unionByName(new)


def test_detect(spark):
    dim = _dim(spark)
    det = {r.product_id: r.change_type for r in
           scd2.scd2_detect(dim, _snapshot(dim), "product_id", scd2.PRODUCT_TRACKED).collect()}
    assert sum(v == "changed" for v in det.values()) == 7     # 5 price, 1 brand, 1 NULL -> value
    assert det[2000001] == "new" and det[1000978] == "unchanged"


def test_apply_closes_inserts_and_is_idempotent(spark):
    dim = _dim(spark)
    snap = _snapshot(dim)
    out = scd2.scd2_apply(dim, snap, "product_id", scd2.PRODUCT_TRACKED, AS_OF, carry=["category_code"])
    rows = out.collect()
    closed = [r for r in rows if not r.is_current_version]
    new = [r for r in rows if r.version_number == 2]
    assert len(rows) == 18 and len(closed) == 7 and len(new) == 7
    assert all(r.effective_to == AS_OF for r in closed)              # closed on the day the new one starts
    assert all(r.effective_from == AS_OF and r.effective_to == OPEN for r in new)
    fresh = sorted((r.product_id, r.product_sk) for r in rows if r.product_sk > 10)
    assert [k for _, k in fresh] == list(range(11, 19))              # keys continue after max, in id order
    assert {r.product_id for r in rows if r.product_sk == 18} == {2000001}
    inv = scd2_invariants(out, "product_id").first()
    assert (inv.keys_without_one_current, inv.empty_intervals, inv.gaps_or_overlaps, inv.version_breaks) == (0, 0, 0, 0)
    again = scd2.scd2_apply(out, snap, "product_id", scd2.PRODUCT_TRACKED, AS_OF, carry=["category_code"])
    cols = ["product_sk", "product_id", "brand", "price", "effective_from", "effective_to", "is_current_version"]
    assert sorted(again.select(cols).collect()) == sorted(out.select(cols).collect())


def test_history_versions_and_no_gap_day(spark):
    day = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    ev = spark.createDataFrame([
        (1, dt.datetime(2024, 1, 1, 9), "view", 7, 10.0, " A ", "x.y", day[0]),
        (2, dt.datetime(2024, 1, 1, 18), "view", 7, 11.0, " A ", "x.y", day[0]),   # day's last price wins
        (3, dt.datetime(2024, 1, 2, 9), "purchase", 7, 11.0, "a", "x.y", day[1]),   # brand cleans to same
        (4, dt.datetime(2024, 1, 3, 9), "view", 7, -1.0, None, "x.y", day[2]),      # price 0, brand unknown
    ], "event_id long, event_time timestamp, event_type string, product_id long, price double, brand string, "
       "category_code string, event_date date")
    cats = spark.createDataFrame([(1, "x.y")], "category_sk long, category_full_path string")
    hist = scd2.products_from_history(ev, cats).orderBy("version_number").collect()
    assert [(r.version_number, r.price, r.brand, r.effective_from, r.effective_to) for r in hist] == [
        (1, 11.0, "a", day[0], day[2]), (2, 0.0, "unknown", day[2], OPEN)]
    pit = point_in_time(ev, scd2.products_from_history(ev, cats), "product_id", "event_date",
                        {"version_number": "v"})
    assert {r.event_id: r.v for r in pit.collect()} == {1: 1, 2: 1, 3: 1, 4: 2}


def test_users_segment_evolution(spark):
    rows = [(i, dt.datetime(2024, 1, 1 + i // 4), "view", 1, dt.date(2024, 1, 1 + i // 4)) for i in range(24)]
    ev = spark.createDataFrame(rows, "event_id long, event_time timestamp, event_type string, user_id long, event_date date")
    hist = scd2.users_from_history(ev, power=21, engaged=6).orderBy("version_number").collect()
    assert [(r.user_segment, r.events_at_start) for r in hist] == [("casual", 4), ("engaged", 8), ("power_user", 24)]
