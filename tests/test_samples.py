import datetime as dt
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from railstream import schemas
from railstream.operators import samples as ops
from railstream.plans.registry import PREPARED, SAMPLES
from tests.conftest import plan_of

UTC = dt.timezone.utc
BASE = dt.datetime(2025, 6, 2, 12)


def stop_times(spark, rows):
    """Rows of (trip, stop, arrival[, overrides]) as stop times of route E, southbound."""
    full = []
    for trip, stop, arrival, *more in rows:
        row = {"trip_uid": trip, "start_time_dts": BASE, "route_id": "E", "direction": "S",
               "stop_id": stop, "stop_name": stop, "stop_lat": 1.0, "stop_lon": 2.0,
               "arrival_time": arrival, "departure_time": arrival, **(more[0] if more else {})}
        for name in ("start_time_dts", "arrival_time", "departure_time"):
            row[name] = row[name] and row[name].replace(tzinfo=UTC)
        full.append(tuple(row[f.name] for f in schemas.STOP_TIMES.fields))
    return spark.createDataFrame(full, schemas.STOP_TIMES)


def trip_of(n, target=None, trip="t"):
    """``n`` stops a minute apart; the stop numbers in ``target`` are at the target stop."""
    return [(trip, "X" if i + 1 in (target or ()) else f"s{i + 1:03}",
             BASE + dt.timedelta(minutes=i)) for i in range(n)]


@pytest.mark.parametrize(("hour", "rush"), [
    (6, 0), (7, 1), (9, 1), (10, 0), (15, 0), (16, 1), (19, 1), (20, 0)])
def test_rush_hours_are_local(spark, hour, rush):
    local = dt.datetime(2025, 6, 2, hour, 59)  # four hours behind UTC
    row = ops.prepare_stop_times(
        stop_times(spark, [("t", "a", local + dt.timedelta(hours=4))])).first()
    assert (row["hour_of_day"], row["is_rush_hour"]) == (hour, rush)
    assert row["arrival_time_nyc"] == local


@pytest.mark.parametrize(("day", "number", "weekend"), [(1, 1, 1), (7, 7, 1), (2, 2, 0)])
def test_days_of_week(spark, day, number, weekend):
    row = ops.prepare_stop_times(
        stop_times(spark, [("t", "a", dt.datetime(2025, 6, day, 16))])).first()
    assert (row["day_of_week"], row["is_weekend"]) == (number, weekend)
    assert row["trip_date"] == dt.date(2025, 6, day)


def test_gap_in_minutes_and_filters_before_numbering(spark):
    rows = [("t", "a", BASE), ("t", "b", BASE + dt.timedelta(seconds=30), {"stop_lat": None}),
            ("t", "c", BASE + dt.timedelta(seconds=90)), ("t", "d", None),
            ("t", "e", BASE + dt.timedelta(seconds=80), {"route_id": "A"}),
            ("t", "f", BASE + dt.timedelta(seconds=80), {"direction": "N"})]
    out = ops.prepare_stop_times(stop_times(spark, rows)).orderBy("stop_sequence").collect()
    assert [(r["stop_id"], r["stop_sequence"], r["minutes_since_prev_stop"]) for r in out] == [
        ("a", 1, None), ("c", 2, 1.5)]


@pytest.mark.parametrize("method", ["window", "join"])
def test_context(spark, method):
    prepared = ops.prepare_stop_times(stop_times(
        spark, trip_of(5, {5}, "five") + trip_of(6, {6}, "six") + trip_of(9, {8, 9}, "two")
        + trip_of(9, {9}, None)))
    out = ops.context_windows(prepared, target_stop="X", method=method)
    found = {(r["trip_uid"], r["target_sequence"]): r for r in out.collect()}
    assert set(found) == {("six", 6), ("two", 8), ("two", 9)}
    steps = found["six", 6]["context_stops"]
    assert [s["stop_sequence"] for s in steps] == [1, 2, 3, 4, 5]
    assert [s["minutes_since_prev_stop"] for s in steps] == [None, 1.0, 1.0, 1.0, 1.0]
    assert [s["stop_sequence"] for s in found["two", 8]["context_stops"]] == [3, 4, 5, 6, 7]
    assert found["two", 9]["context_stops"][-1]["stop_name"] == "X"


def test_context_across_slices(spark):
    prepared = ops.prepare_stop_times(stop_times(spark, trip_of(40, set(range(1, 41, 3)))),
                                      blocks=9)
    whole = ops.context_windows(prepared, target_stop="X").orderBy("target_sequence").collect()
    assert len(whole) == 12
    for size in (1, 3, 7):
        cut = ops.context_windows(prepared, target_stop="X", slice_rows=size)
        assert cut.orderBy("target_sequence").collect() == whole
    joined = ops.context_windows(prepared, target_stop="X", method="join")
    assert joined.orderBy("target_sequence").collect() == whole


def skewed_events():
    """Events with one user holding most rows and one event repeated very often."""
    pick = random.Random(5)
    start = dt.datetime(2025, 10, 30)
    rows = [(n, start + dt.timedelta(seconds=pick.randrange(20 * 86400)),
             pick.choice([1, 1, 1, 2, 3]), pick.choice(["purchase", "view", "click"]))
            for n in range(600)]
    rows += [(9999, start + dt.timedelta(days=3), 1, "view")] * 300
    return pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type"])


def numbered_in_spark(spark, events, **options):
    from railstream.plans import adapters
    df = spark.createDataFrame(
        [(int(n), t.to_pydatetime(), int(u), k) for n, t, u, k in events.itertuples(index=False)],
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string")
    return ops.prepare_stop_times(adapters.stop_times(df), **options)


@pytest.mark.parametrize("blocks", [3, 40])
def test_numbering_equals_the_defining_sql_under_skew(spark, blocks, monkeypatch):
    # a small block size sends the copies through the branch for very many copies
    monkeypatch.setattr(ops, "_COPIES_PER_TASK", 7 if blocks == 3 else 1000)
    events = skewed_events()
    ours = numbered_in_spark(spark, events, blocks=blocks)
    columns = ["trip_uid", "stop_sequence", "stop_id", "minutes_since_prev_stop", "hour_of_day"]
    with duckdb.connect() as db:
        db.register("events", events)
        theirs = db.execute(f"SELECT {', '.join(columns)} FROM ({PREPARED})").fetchall()
        theirs_context = db.execute(SAMPLES + """SELECT trip_uid, target_sequence,
          list_transform(context_stops, lambda s: s.stop_name) FROM samples""").fetchall()
    assert sorted(map(str, theirs)) == sorted(str(tuple(r)) for r in ours.select(*columns).collect())
    context = ops.context_windows(ours, target_stop="purchase", slice_rows=50).select(
        "trip_uid", "target_sequence", F.col("context_stops.stop_name")).collect()
    assert sorted(map(str, theirs_context)) == sorted(str(tuple(r)) for r in context)


def test_no_window_holds_a_whole_trip(spark):
    plan = plan_of(numbered_in_spark(spark, skewed_events()), "simple")
    windows = [line for line in plan.splitlines() if "Window [" in line and "arrival_time" in line
               and "lag(arrival_time" in line]
    assert windows and all("_block" in line for line in windows)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_context_window_shuffles_once(spark, tmp_path):
    path = str(tmp_path / "prepared")
    numbered_in_spark(spark, skewed_events()).write.parquet(path)
    prepared = spark.read.parquet(path)
    plan = plan_of(ops.context_windows(prepared, target_stop="purchase"), "simple")
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


@pytest.mark.parametrize(("days", "train", "val"), [(10, 7, 9), (30, 21, 26), (0, 0, 0)])
def test_split_dates(spark, days, train, val):
    first = dt.date(2025, 1, 1)
    df = spark.createDataFrame([(first,), (first + dt.timedelta(days=days),)], "trip_date date")
    row = ops.split_dates(df).first()
    assert row["total_days"] == days
    assert (row["train_end_date"] - first).days == train
    assert (row["val_end_date"] - first).days == val


def samples_over_days(spark):
    rows = []
    for day in range(21):
        for name, seq, at in trip_of(6, {6}, f"trip{day:02}"):
            rows.append((name, seq, at + dt.timedelta(days=day)))
    return ops.context_windows(ops.prepare_stop_times(stop_times(spark, rows)), target_stop="X")


def test_splits_are_complete_and_ordered(spark):
    samples = samples_over_days(spark)
    dates = ops.split_dates(samples)
    counts = {r["split"]: r["n_samples"] for r in ops.split_counts(samples, dates).collect()}
    assert counts == {"train": 15, "val": 3, "test": 3}
    for split, n in counts.items():
        rows = ops.read_split(samples, dates, split)
        assert rows.count() == n and len(rows.columns) == 41
    text = [r["info"] for r in ops.split_summary(samples, dates).collect()]
    assert len(text) == 16 and text[0] == text[15] == "═" * 51
    assert text[4] == "Full date range: 2025-06-02 to 2025-06-22"
    assert text[12:15] == ["Train samples: 15", "Val samples: 3", "Test samples: 3"]


def test_split_bounds_are_no_join(spark):
    samples = samples_over_days(spark)
    plan = plan_of(ops.assign_split(samples, ops.split_dates(samples)), "simple")
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_matrix(spark):
    samples = samples_over_days(spark).limit(1)
    row = ops.to_matrix(samples).first()
    assert [len(step) for step in row["x"]] == [8] * 5
    assert row["x"][0][4] is None and row["y"] == 1.0
    assert ops.to_matrix(samples, fill=0.0).first()["x"][0][4] == 0.0


def test_shuffle_is_repeatable_and_whole(spark):
    samples = samples_over_days(spark)
    def order(seed):
        return [r["trip_uid"] for r in ops.shuffle_samples(samples, seed=seed).collect()]
    assert order(1) == order(1) != order(2)
    assert sorted(order(1)) == sorted(order(2))


def test_raw_stop_times_keep_unknown_stops(spark):
    observed = spark.createDataFrame(
        [("t1", "A", None, BASE, None, None, None), ("t1", "Z", None, BASE, None, None, None),
         ("t9", "A", None, BASE, None, None, None)], schemas.SENSOR_DATA)
    trips = spark.createDataFrame([("t1", BASE, "E", "S")],
                                  "trip_uid string, start_time_dts timestamp, route_id string, "
                                  "direction string")
    stops = spark.createDataFrame([("A", "Name", 1.0, 2.0, None, None)], schemas.STOPS)
    out = ops.build_raw_stop_times(observed, trips, stops)
    assert out.schema.fieldNames() == schemas.STOP_TIMES.fieldNames()
    assert sorted((r["stop_id"], r["stop_name"]) for r in out.collect()) == [
        ("A", "Name"), ("Z", None)]
