"""Daily feature snapshots, sessions from a state table, grouped medians and
joint NTILEs against plain Python and Spark's own windows."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import Window, functions as F

from lakemart.operators.windows import medians_in, ntiles_global, sessionize
from lakemart.plans import session_state as SS, snapshots, star

T0 = dt.datetime(2024, 1, 1)
FACT = "user_sk int, event_time timestamp, event_date date, event_type string, user_session string, revenue double"


def _fact(spark, rows):
    return spark.createDataFrame([(u, t, t and t.date(), e, s, r) for u, t, e, s, r in rows], FACT)


def test_daily_features_equal_counts_over_each_window(spark):
    rnd = random.Random(5)
    rows = [(u, T0 + dt.timedelta(days=rnd.choice([0, 1, 6, 7, 13, 29, 30, 31, 59, 60, 75]), hours=rnd.randrange(24)),
             rnd.choice(["view", "purchase"]), rnd.choice(["a", "b", None]), rnd.choice([1.25, 2.0, None])) for u in (1, 2, 3) for _ in range(25)]
    rows += [(4, T0 + dt.timedelta(days=75), "view", "z", None), (5, None, "view", "z", None)]
    got = {(r.user_sk, r.feature_date): r for r in snapshots.user_daily_features(_fact(spark, rows)).collect()}
    last = (T0 + dt.timedelta(days=75)).date()
    want = 0
    for u in (1, 2, 3, 4):
        mine = [r for r in rows if r[0] == u]
        day = min(r[1] for r in mine).date()
        while day <= last:
            want += 1
            past = [(day - r[1].date()).days for r in mine]
            seen = [(a, *r) for a, r in zip(past, mine) if a >= 0]
            row = got[(u, day)]
            assert row.recency_days == min(a for a, *_ in seen)
            for k in (7, 14, 30):
                assert row[f"events_last_{k}d"] == sum(a < k for a, *_ in seen)
            for k in (7, 30):
                assert row[f"sessions_last_{k}d"] == len({s for a, _, _, _, s, _ in seen if a < k and s})
                assert row[f"revenue_last_{k}d"] == sum(r or 0 for a, _, _, e, _, r in seen if a < k and e == "purchase")
            hours = [t.hour for _, _, t, *_ in seen]
            assert row.favorite_shopping_hour == min(set(hours), key=lambda h: (-hours.count(h), h))
            day += dt.timedelta(days=1)
    assert len(got) == want  # undated events give no snapshot


def test_daily_features_of_no_events(spark):
    assert snapshots.user_daily_features(_fact(spark, [])).count() == 0


def test_daily_features_shuffle_days_not_events(spark):
    """Differences are made after the reduction to (user, day); one window a
    user over the days of change, none over events."""
    rows = [(1, T0 + dt.timedelta(minutes=i), "view", "a", None) for i in range(2000)]
    changes = snapshots.user_feature_changes(_fact(spark, rows), "2024-03-01")
    # one active day on 1 and 2 January: changes at 0, 7, 14, 30 and 60 days after each
    assert changes.count() == 9
    assert snapshots.user_daily_features(_fact(spark, rows), "2024-03-01").count() == 61


def test_daily_features_tasks_grow_with_events(spark, monkeypatch):
    """More events, more tasks: no step is left to a fixed number of partitions, a hot user (None) included."""
    rnd = random.Random(7)
    rows = [(rnd.choice([None, *range(40)]) if i % 4 else None, T0 + dt.timedelta(days=rnd.randrange(70), minutes=rnd.randrange(1440)),
             rnd.choice(["view", "purchase", None]), rnd.choice(["a", "b", f"s{i}", None]), rnd.choice([1.25, 2.0, None])) for i in range(2000)]
    fact = _fact(spark, rows)
    small = sorted(map(str, snapshots.user_daily_features(fact).collect()))
    monkeypatch.setattr(star, "EVENTS_PER_TASK", 100)
    daily = snapshots.user_daily_features(fact)
    assert sorted(map(str, daily.collect())) == small
    assert daily.rdd.getNumPartitions() == 20
    plan = daily._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 5
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in "".join(x for x in plan.splitlines() if "ENSURE_REQUIREMENTS" in x)


def test_daily_features_carry_no_totals_past_active_days(spark):
    """Of a cell's columns only the windowed amounts are repeated for the days on which they leave a window."""
    fact = _fact(spark, [(1, T0, "view", "a", None)])
    moved = snapshots._differences(snapshots._with_habits(snapshots.user_day_cells(fact, 1)))
    assert not set(snapshots.TOTALS) & set(moved.columns)
    assert moved.filter("_favorite IS NOT NULL").count() == 1


def test_user_activity_tasks_grow_with_events(spark, monkeypatch):
    """The distincts of a user are counted in tasks dealt by user, not in those left over from the counts before."""
    rows = [(u, (T0 + dt.timedelta(days=d)).date(), e) for u in (None, *range(1, 30)) for d in range(u or 9) for e in ("view", "purchase", None)]
    bronze = spark.createDataFrame(rows, "user_id long, event_date date, event_type string")
    monkeypatch.setattr(star, "EVENTS_PER_TASK", 100)
    users = star.user_activity(bronze)
    plan = users._jdf.queryExecution().sparkPlan().toString()
    assert re.search(rf"hashpartitioning\(user_id#\d+L?, {-(-len(rows) // 100)}\), REPARTITION_BY_NUM", plan)
    got = {r.user_id: (r.total_events, r.event_types_count, r.active_days, r.purchase_count) for r in users.collect()}
    assert got == {u: (3 * u, 2, u, u) for u in range(1, 30)}


EVENTS = "user_sk int, event_id int, event_time timestamp, event_date date"


def _events(spark, rows):
    return spark.createDataFrame([(u, i, t, t and t.date()) for u, i, t in rows], EVENTS)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sessions_from_state_equal_full_sessionization(spark, seed):
    """Three loads in random order of time, null users and times among them."""
    rnd = random.Random(seed)
    rows = [(rnd.choice([1, 2, 3, None]), i, None if rnd.random() < .03 else T0 + dt.timedelta(minutes=rnd.randrange(4000))) for i in range(240)]
    numbers, history, state = {}, None, None
    for part in (rows[:100], rows[100:200], rows[200:]):
        new = _events(spark, part)
        if state is None:
            history, state = SS.start_state(new)
        else:
            load = SS.load_sessions(state, new)
            moved = SS.renumber(history, load.moves).collect()
            for r in moved:
                assert numbers[r.event_id] != r.session_number
                numbers[r.event_id] = r.session_number
            keep = spark.createDataFrame([(u, i, t, t and t.date(), numbers[i]) for u, i, t in rows if i in numbers], EVENTS + ", session_number long")
            history, state = keep.unionByName(load.events.select(*keep.columns)), load.state.checkpoint()
        numbers |= {r.event_id: r.session_number for r in history.collect()}
    want = {r.event_id: r.session_number for r in sessionize(_events(spark, rows)).collect()}
    assert numbers == want
    assert sorted(state.collect()) == sorted(SS.session_state(sessionize(_events(spark, rows))).select(*state.columns).collect())


def test_history_is_read_only_on_the_days_of_moved_sessions(spark, tmp_path):
    rows = [(u, 100 * u + d, T0 + dt.timedelta(days=d)) for u in (1, 2) for d in range(20)]
    numbered, state = SS.start_state(_events(spark, rows))
    path = str(tmp_path / "history")
    numbered.write.partitionBy("event_date").parquet(path)
    history = spark.read.parquet(path)
    # in order: nothing moves, no file is read
    load = SS.load_sessions(state, _events(spark, [(1, 900, T0 + dt.timedelta(days=25))]))
    assert [r.session_number for r in load.events.collect()] == [21]
    none = SS.renumber(history, load.moves)
    assert none.count() == 0 and "FileScan parquet" not in none._jdf.queryExecution().optimizedPlan().toString()
    # late by two days: the sessions after it move, and only their days are read
    load = SS.load_sessions(state, _events(spark, [(1, 901, T0 + dt.timedelta(days=17, hours=5))]))
    moved = SS.renumber(history, load.moves)
    assert sorted((r.event_id, r.session_number) for r in moved.collect()) == [(118, 20), (119, 21)]
    scan = moved._jdf.queryExecution().executedPlan().toString()
    filters = scan[scan.index("PartitionFilters"):]
    assert "event_date" in filters and "2024-01-19" in filters and "2024-01-20" in filters


def test_medians_equal_percentile(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, rnd.randrange(9) / 4])) for _ in range(300)]
    rows += [("one", 2.5), ("none", None), *[("hot", i % 1000 / 8) for i in range(4001)]]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.m for r in medians_in(df, "g", "v", "m").collect()}
    want = {r.g: r.m for r in df.groupBy("g").agg(F.percentile("v", 0.5).alias("m")).collect() if r.m is not None}
    assert got == want and "none" not in got
    assert medians_in(df.limit(0), "g", "v", "m").count() == 0


@pytest.mark.parametrize("rows, n", [(0, 5), (1, 5), (3, 5), (10, 5), (23, 5), (23, 1), (57, 4)])
def test_joint_ntiles_equal_ntile(spark, rows, n):
    rnd = random.Random(rows)
    df = spark.createDataFrame([(i, rnd.choice([None, 1, 2, 3]), rnd.random(), f"x{i}") for i in range(rows)], "id int, a int, b double, other string")
    got = ntiles_global(df, {"ta": ["a", "id"], "tb": ["b", "id"]}, n)
    want = df.select("*", F.ntile(n).over(Window.orderBy("a", "id")).alias("ta"), F.ntile(n).over(Window.orderBy("b", "id")).alias("tb"))
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
