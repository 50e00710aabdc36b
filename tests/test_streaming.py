"""Structured Streaming jobs on a file source with availableNow triggers,
checked against their batch twins."""
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE
from lakemart.sources.events import bronze_from_tables
from lakemart.sources.stream import read_event_stream, stream_events_from_bronze
from lakemart.streaming import (dedupe_events, parse_events, start_bronze_stream, start_mart_stream,
                                start_memory_stream, stream_progress, windows as W)

MSG_SCHEMA = "key binary, value binary"


@pytest.fixture(scope="module")
def messages(spark, tmp_path_factory):
    """Stream messages from the smoke events in two time-ordered files."""
    root = tmp_path_factory.mktemp("msgs")
    bronze = bronze_from_tables(spark, SMOKE)
    early = bronze.filter(F.col("event_date") <= "2024-01-15")
    late = bronze.filter(F.col("event_date") > "2024-01-15")
    stream_events_from_bronze(early).coalesce(1).write.parquet(str(root / "in" / "part1"))
    stream_events_from_bronze(late).coalesce(1).write.parquet(str(root / "in" / "part2"))
    src = root / "src"
    src.mkdir()
    return root, bronze


def _stage(root, name, parts):
    """A stream input folder holding the given message files."""
    d = root / name
    d.mkdir(exist_ok=True)
    for p in parts:
        for f in os.listdir(root / "in" / p):
            if f.endswith(".parquet"):
                os.link(root / "in" / p / f, d / f"{p}-{f}")
    return str(d)


def _stream(spark, folder):
    raw = read_event_stream(spark, "parquet", folder, MSG_SCHEMA, maxFilesPerTrigger=1)
    good, bad = parse_events(raw)
    return good, bad


def _batch_good(spark, bronze):
    good, _ = parse_events(stream_events_from_bronze(bronze))
    return good


def test_complete_mode_funnel_equals_batch_twin(spark, messages, tmp_path):
    root, bronze = messages
    good, _ = _stream(spark, _stage(root, "c1", ["part1", "part2"]))
    q = start_memory_stream(W.funnel(good, sketch=True), "funnel_complete", "complete", str(tmp_path / "ck"))
    q.awaitTermination()
    assert stream_progress(q)["batch_id"] is not None
    got = spark.table("funnel_complete")
    want = W.funnel(_batch_good(spark, bronze))
    cols = ["window_start", "views", "carts", "purchases", "revenue", "view_to_cart_rate", "cart_to_purchase_rate"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())
    # HLL sketch on the stream; small windows are counted exactly
    diff = got.join(want.select("window_start", F.col("active_users").alias("exact")), "window_start")
    assert diff.filter(F.abs(F.col("active_users") - F.col("exact")) > 1).count() == 0


def test_append_mode_emits_closed_windows_only(spark, messages, tmp_path):
    root, bronze = messages
    good, _ = _stream(spark, _stage(root, "a1", ["part1", "part2"]))
    q = start_memory_stream(W.tumbling(good), "tumble_append", "append", str(tmp_path / "ck"))
    q.awaitTermination()
    got = spark.table("tumble_append")
    want = W.tumbling(_batch_good(spark, bronze))
    wm = _batch_good(spark, bronze).agg(F.max("event_time")).first()[0] - dt.timedelta(minutes=10)
    closed = want.filter(F.col("window_end") <= F.lit(wm))
    assert got.count() > 0
    assert sorted(got.select(want.columns).collect()) == sorted(closed.collect())     # distinct counts too


def test_late_events_within_watermark_are_counted(spark, tmp_path):
    """Spark's guarantee is one-sided: rows later than the watermark may or
    may not be aggregated, rows within it always are."""
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)

    def msg(i, t):
        return json.dumps({"event_id": str(i), "event_type": "view", "user_id": 1, "product_id": 1,
                           "category_id": 1, "event_time": t.isoformat(), "price": 1.0, "quantity": 0,
                           "revenue": 0.0})
    d = tmp_path / "late"
    d.mkdir()
    (d / "a.json").write_text(msg(1, t0 + dt.timedelta(minutes=30)) + "\n")
    raw = read_event_stream(spark, "text", str(d), maxFilesPerTrigger=1)
    good, _ = parse_events(raw)
    q = start_memory_stream(W.tumbling(good, sketch=True), "late_update", "update", str(tmp_path / "ck"))
    q.awaitTermination()
    # second file: one event 25 minutes late (beyond the 10 minute watermark), one 5 minutes late
    (d / "b.json").write_text(msg(2, t0 + dt.timedelta(minutes=5)) + "\n"
                              + msg(3, t0 + dt.timedelta(minutes=25)) + "\n")
    q = start_memory_stream(W.tumbling(good, sketch=True), "late_update2", "update", str(tmp_path / "ck2"))
    q.awaitTermination()
    starts = {r.window_start for r in spark.table("late_update2").collect()}
    assert t0 + dt.timedelta(minutes=25) in starts        # 5 minutes late: within the watermark
    assert t0 + dt.timedelta(minutes=30) in starts


def test_bronze_sink_restart_has_no_duplicates(spark, messages, tmp_path):
    root, bronze = messages
    folder = _stage(root, "r1", ["part1"])
    out, ck = str(tmp_path / "bronze"), str(tmp_path / "ck")
    good, _ = _stream(spark, folder)
    start_bronze_stream(good, out, ck, available_now=True).awaitTermination()
    n1 = spark.read.parquet(out).count()
    start_bronze_stream(good, out, ck, available_now=True).awaitTermination()   # nothing new
    assert spark.read.parquet(out).count() == n1
    for f in os.listdir(root / "in" / "part2"):
        if f.endswith(".parquet"):
            os.link(root / "in" / "part2" / f, os.path.join(folder, f"part2-{f}"))
    start_bronze_stream(good, out, ck, available_now=True).awaitTermination()
    written = spark.read.parquet(out)
    assert written.count() == bronze.count() == written.select("event_id").distinct().count()


def test_malformed_messages_are_quarantined(spark, tmp_path):
    d = tmp_path / "bad"
    d.mkdir()
    ok = json.dumps({"event_id": "1", "event_type": "view", "user_id": 1, "product_id": 1, "category_id": 1,
                     "event_time": "2024-01-01T00:00:00"})
    (d / "a.json").write_text("\n".join([ok, '{"event_id": "2", "event_ty', "not json",
                                         ok.replace("2024-01-01T00:00:00", "yesterday")]) + "\n")
    raw = read_event_stream(spark, "text", str(d))
    good, bad = parse_events(raw)
    start_memory_stream(good, "q_good", "append", str(tmp_path / "ck1")).awaitTermination()
    start_memory_stream(bad, "q_bad", "append", str(tmp_path / "ck2")).awaitTermination()
    assert spark.table("q_good").count() == 1
    reasons = sorted(r.reason for r in spark.table("q_bad").collect())
    assert reasons == ["bad_event_time", "missing_required_field", "missing_required_field"]


def test_dedupe_within_watermark(spark, messages, tmp_path):
    root, bronze = messages
    d = tmp_path / "dups"
    d.mkdir()
    for i in range(2):                                     # the same file delivered twice
        for f in os.listdir(root / "in" / "part1"):
            if f.endswith(".parquet"):
                os.link(root / "in" / "part1" / f, d / f"copy{i}-{f}")
    good, _ = _stream(spark, str(d))
    start_memory_stream(dedupe_events(good), "dedup", "append", str(tmp_path / "ck")).awaitTermination()
    n = bronze.filter(F.col("event_date") <= "2024-01-15").count()
    assert spark.table("dedup").count() == n


def test_session_windows_stream_vs_batch(spark, messages, tmp_path):
    root, bronze = messages
    good, _ = _stream(spark, _stage(root, "s1", ["part1", "part2"]))
    start_memory_stream(W.session_windows(good), "sess", "append", str(tmp_path / "ck")).awaitTermination()
    got = spark.table("sess")
    want = W.session_windows(_batch_good(spark, bronze))
    wm = _batch_good(spark, bronze).agg(F.max("event_time")).first()[0] - dt.timedelta(minutes=10)
    closed = want.filter(F.col("session_end") <= F.lit(wm))
    assert sorted(got.collect()) == sorted(closed.collect())


def test_mart_sink_foreach_batch(spark, messages, tmp_path):
    root, bronze = messages
    good, _ = _stream(spark, _stage(root, "m1", ["part1", "part2"]))
    out = str(tmp_path / "mart")
    start_mart_stream(W.funnel(good, sketch=True), out, str(tmp_path / "ck"), available_now=True).awaitTermination()
    assert spark.read.parquet(out).count() == W.funnel(_batch_good(spark, bronze)).count()


def test_stream_static_join_with_dimension(spark, messages, tmp_path):
    """Stream events enriched with a static dimension (stream-static join)."""
    from lakemart.plans.star import dim_categories, dim_products
    root, bronze = messages
    good, _ = _stream(spark, _stage(root, "j1", ["part1"]))
    # streams join the written dimension table, as the pipeline does
    dim_products(bronze, dim_categories(bronze)).write.parquet(str(tmp_path / "dim_products"))
    products = spark.read.parquet(str(tmp_path / "dim_products")).select(
        F.col("product_id").cast("int").alias("product_id"), "brand", "product_sk")
    enriched = good.join(products, "product_id", "left")
    start_memory_stream(enriched, "enriched", "append", str(tmp_path / "ck")).awaitTermination()
    out = spark.table("enriched")
    assert out.count() == bronze.filter(F.col("event_date") <= "2024-01-15").count()
    assert out.filter(F.col("product_sk").isNull()).count() == 0


def test_console_sink_update_mode(spark, messages, tmp_path):
    from lakemart.streaming import start_debug_stream
    root, _ = messages
    good, _ = _stream(spark, _stage(root, "k1", ["part1"]))
    q = start_debug_stream(W.tumbling(good, sketch=True), mode="update", available_now=True, checkpoint=str(tmp_path / "ck"))
    q.awaitTermination()
    assert q.lastProgress["numInputRows"] >= 0


def test_exact_user_funnel_in_append_mode(spark, messages, tmp_path):
    """Two-level (window, user) -> window aggregation: exact distinct users
    on a stream, equal to the batch twin for every closed window."""
    root, bronze = messages
    good, _ = _stream(spark, _stage(root, "e1", ["part1", "part2"]))
    q = start_memory_stream(W.funnel(good), "funnel_exact", "append", str(tmp_path / "ck"))
    q.awaitTermination()
    got = spark.table("funnel_exact")
    batch = _batch_good(spark, bronze)
    wm = batch.agg(F.max("event_time")).first()[0] - dt.timedelta(minutes=10)
    want = W.funnel(batch).filter(F.col("window_end") <= F.lit(wm))
    assert got.count() > 0 and sorted(got.collect()) == sorted(want.collect())
