"""Marts kept by upsert from streams of several batches."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lakemart.streaming import parse_events, start_mart_stream, start_upsert_stream, windows as W
from lakemart.streaming.sinks import DAY, upsert
from lakemart.sources import read_event_stream
from lakemart.sources.stream import stream_events_from_bronze
from lakemart.sources.events import bronze_from_tables
from conftest import SMOKE


@pytest.fixture(scope="module")
def in_files(spark, tmp_path_factory):
    """Messages of the first ten days, one file per two days, oldest first."""
    root = tmp_path_factory.mktemp("upsert")
    bronze = bronze_from_tables(spark, SMOKE).filter("event_date < '2024-01-11'").cache()
    for i in range(5):
        part = bronze.filter(F.dayofmonth("event_date").isin(2 * i + 1, 2 * i + 2))
        stream_events_from_bronze(part).select(F.col("value").cast("string")).coalesce(1).write.text(str(root / f"w{i}"))
        (name,) = [f for f in os.listdir(root / f"w{i}") if f.startswith("part-")]
        os.makedirs(root / "in", exist_ok=True)
        os.link(root / f"w{i}" / name, root / "in" / f"{i}.txt")
        os.utime(root / "in" / f"{i}.txt", (1_700_000_000 + i * 100,) * 2)
    return str(root / "in"), bronze


def batch_twin(spark, bronze):
    return parse_events(stream_events_from_bronze(bronze))[0]


@pytest.mark.parametrize("name,keys", [("funnel", ["window_start"]), ("tumbling", ["window_start", "event_type"])])
def test_append_batches_make_the_batch_twin(spark, in_files, tmp_path, name, keys):
    folder, bronze = in_files
    out, ck = str(tmp_path / "mart"), str(tmp_path / "ck")
    good, _ = parse_events(read_event_stream(spark, "text", folder, maxFilesPerTrigger=1))
    build = getattr(W, name)
    q = start_upsert_stream(build(good), out, ck, keys, available_now=True)
    q.awaitTermination()
    assert len(os.listdir(f"{out}.ledger/{q.id}")) >= 5      # many batches
    twin = batch_twin(spark, bronze)
    wm = twin.agg(F.max("event_time")).first()[0] - dt.timedelta(minutes=10)
    want = build(twin).filter(F.col("window_end") <= F.lit(wm))
    got = spark.read.parquet(out).drop(DAY)
    assert got.count() > 50 and sorted(got.select(want.columns).collect()) == sorted(want.collect())
    # nothing new: nothing changes; a replayed batch is in the ledger
    files = {f for d, _, names in os.walk(out) for f in names}
    start_upsert_stream(build(good), out, ck, keys, available_now=True).awaitTermination()
    last = max((int(f) for f in os.listdir(f"{ck}/commits") if f.isdigit()))
    for f in (str(last), f".{last}.crc"):
        if os.path.exists(f"{ck}/commits/{f}"):
            os.remove(f"{ck}/commits/{f}")                   # as if the driver died before the commit
    start_upsert_stream(build(good), out, ck, keys, available_now=True).awaitTermination()
    assert {f for d, _, names in os.walk(out) for f in names} == files


def test_update_mode_keeps_the_last_state_of_a_window(spark, in_files, tmp_path):
    folder, bronze = in_files
    out = str(tmp_path / "mart")
    good, _ = parse_events(read_event_stream(spark, "text", folder, maxFilesPerTrigger=1))
    start_upsert_stream(W.sliding(good), out, str(tmp_path / "ck"), ["window_start", "event_type"], mode="update", available_now=True).awaitTermination()
    want = W.sliding(batch_twin(spark, bronze))
    assert sorted(spark.read.parquet(out).select(want.columns).collect()) == sorted(want.collect())


def test_upsert_replaces_by_key_and_leaves_other_days(spark, tmp_path):
    out = str(tmp_path / "t")

    def rows(*r):
        return spark.createDataFrame([(dt.datetime(2024, 1, d, 5) if d else None, k, v) for d, k, v in r], "window_start timestamp, k string, v int")
    upsert(rows((1, "a", 1), (1, None, 2), (2, "a", 3), (None, "z", 9)), out, ["window_start", "k"], "window_start")
    files = os.listdir(f"{out}/{DAY}=2024-01-02")
    for _ in range(2):
        upsert(rows((1, None, 20), (1, "b", 4), (3, "a", 5), (None, "y", 8)), out, ["window_start", "k"], "window_start")
    got = sorted(((r.window_start.day if r.window_start else 0, r.k, r.v) for r in spark.read.parquet(out).collect()), key=repr)
    assert got == sorted([(1, "a", 1), (1, None, 20), (1, "b", 4), (2, "a", 3), (3, "a", 5), (0, "z", 9), (0, "y", 8)], key=repr)
    assert os.listdir(f"{out}/{DAY}=2024-01-02") == files


def test_replacing_sink_refuses_partial_results(spark, in_files, tmp_path):
    good, _ = parse_events(read_event_stream(spark, "text", in_files[0]))
    for mode in ("append", "update"):
        with pytest.raises(ValueError, match="start_upsert_stream"):
            start_mart_stream(W.sliding(good), str(tmp_path / "x"), str(tmp_path / "c"), mode)
