import datetime as dt
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from railstream.functions import temporal
from railstream.operators import stations
from railstream.plans.station_queries import _headway_sql, _idle_sql
from tests.conftest import plan_of

SCHEMA = ("stop_name string, stop_lat double, stop_lon double, trip_id string, "
          "vehicle_timestamp timestamp, direction string")
UTC = dt.timezone.utc


def at(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


def reports(spark, times, stop="A", trip="t", direction="Southbound"):
    return spark.createDataFrame(
        [(stop, 1.0, 2.0, trip, at(t), direction) for t in times], SCHEMA)


def spaced(*gaps):
    """Reports from 15:00 UTC on, the given seconds apart."""
    moment, times = dt.datetime(2025, 6, 2, 15), []
    for gap in (0, *gaps):
        moment += dt.timedelta(seconds=gap)
        times.append(moment.isoformat())
    return times


def idle_text(df, **options):
    rows = stations.idle_time(df, **options).collect()
    return rows[0]["avg_idle_time_m_s"] if rows else None


@pytest.mark.parametrize(("gaps", "options", "expected"), [
    ((30, 60), {}, "0:45"),
    ((0,), {}, "1:00"),
    ((300,), {}, "5:00"),
    ((301,), {}, None),
    ((0, 300), {}, "3:00"),
    ((119, 119, 120, 120, 120), {}, "1:00"),
    ((119, 119, 120, 120, 120), {"carry": True}, "2:00"),
    ((0,), {"repeat_s": 400}, None),
])
def test_idle_gaps(spark, gaps, options, expected):
    assert idle_text(reports(spark, spaced(*gaps)), **options) == expected


def test_idle_splits_at_local_midnight(spark):
    # 23:59:50 and 00:00:10 in New York
    assert idle_text(reports(spark, ["2025-06-03T03:59:50", "2025-06-03T04:00:10"])) is None


def test_idle_when_clocks_go_back(spark):
    # both 01:30 in New York
    twice = reports(spark, ["2025-11-02T05:30:00", "2025-11-02T06:30:00"])
    assert idle_text(twice) == "1:00"
    assert idle_text(twice, blocks=3) == "1:00"
    assert idle_text(twice, compare="instant") is None
    # a report in between makes it two gaps, both too long
    assert idle_text(twice.union(reports(spark, ["2025-11-02T06:20:00"])), blocks=3) is None


def test_idle_filters(spark):
    df = (reports(spark, spaced(30), stop="Broad Channel")
          .union(reports(spark, spaced(30), direction="Northbound", stop="B"))
          .union(reports(spark, spaced(30), stop=None))
          .union(reports(spark, spaced(30), stop="C").withColumn("vehicle_timestamp", F.lit(None))))
    assert stations.idle_time(df).count() == 0


def test_headway_counts_ties_with_their_fan_out(spark):
    times = {"A": "10:00", "B": "10:05", "C": "10:05", "D": "10:15"}
    df = spark.createDataFrame(
        [("S", 1.0, 2.0, trip, at(f"2025-06-02T{t}:00"), "x") for trip, t in times.items()]
        # a later report of A does not move its arrival
        + [("S", 1.0, 2.0, "A", at("2025-06-02T10:07:00"), "x")], SCHEMA)
    for day in (None, "2025-06-02"):
        row = stations.headway(df, service_date=day).first()
        assert row["average_min_difference_between_trains"] == 4.00
        assert row["total_unique_trip_ids"] == 3
    assert stations.headway(df, approximate_trips=True).first()["total_unique_trip_ids"] == 3
    apart = stations.headway(df, dedupe_ties=True).first()
    assert apart["average_min_difference_between_trains"] == 7.50


@pytest.mark.parametrize(("second", "expected"), [("10:20:59", 20.0), ("10:21:00", None)])
def test_headway_cap_is_whole_minutes(spark, second, expected):
    df = spark.createDataFrame([("S", 1.0, 2.0, "A", at("2025-06-02T10:00:00"), "x"),
                                ("S", 1.0, 2.0, "B", at(f"2025-06-02T{second}"), "x")], SCHEMA)
    row = stations.headway(df).first()
    assert (row and row["average_min_difference_between_trains"]) == expected


def skewed_positions(seed):
    """A third of all rows is one report, another third one trip at one station."""
    pick = random.Random(seed)
    start = dt.datetime(2025, 11, 1, 20)
    rows = [("hot", 1.0, 2.0, "t", start, "Southbound")] * 300
    for _ in range(300):
        rows.append(("hot", 1.0, 2.0, "t", start + dt.timedelta(seconds=pick.randrange(90000)),
                     "Southbound"))
    for _ in range(300):
        rows.append((pick.choice("abc"), 1.0, 2.0, pick.choice(["u", "v", "w", None]),
                     start + dt.timedelta(seconds=60 * pick.randrange(1500)),
                     pick.choice(["Southbound", "Northbound"])))
    return pd.DataFrame(rows, columns=["stop_name", "stop_lat", "stop_lon", "trip_id",
                                       "vehicle_timestamp", "direction"])


def in_spark(spark, frame):
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)]
    return spark.createDataFrame(
        [(*r[:4], r[4].to_pydatetime().replace(tzinfo=UTC), r[5]) for r in rows], SCHEMA)


@pytest.mark.parametrize(("cap", "blocks"), [(300, None), (300, 40), (3600, 7)])
def test_idle_equals_the_defining_sql_under_skew(spark, cap, blocks):
    frame = skewed_positions(cap)
    ours = stations.idle_time(in_spark(spark, frame), max_gap_s=cap, blocks=blocks).collect()
    with duckdb.connect() as db:
        db.register("p", frame)
        theirs = db.execute(_idle_sql("SELECT * FROM p", cap)).fetchall()
    assert sorted(tuple(r) for r in ours) == sorted(theirs)


@pytest.mark.parametrize(("cap", "blocks", "day"), [
    (20, None, None), (2, 9, None), (20, 3, "2025-11-01"), (60, 30, "2025-11-02")])
def test_headway_equals_the_defining_join_under_skew(spark, cap, blocks, day):
    frame = skewed_positions(cap)
    ours = stations.headway(in_spark(spark, frame), max_minutes=cap, blocks=blocks,
                            service_date=day).collect()
    with duckdb.connect() as db:
        db.register("p", frame)
        theirs = db.execute(_headway_sql("SELECT * FROM p", cap, day)).fetchall()
    assert sorted(tuple(r) for r in ours) == sorted(theirs)


def test_busiest_on_weekdays_and_on_a_day(spark):
    df = (reports(spark, ["2025-06-02T15:00:00", "2025-06-03T15:00:00"], stop="A")
          .union(reports(spark, ["2025-06-01T15:00:00"], stop="A", trip="sunday"))
          .union(reports(spark, ["2025-06-02T15:00:00"], stop="B"))
          .union(reports(spark, ["2025-06-02T16:00:00"], stop="C")))
    assert [tuple(r) for r in stations.busiest(df, top=2).collect()] == [("A", 2), ("B", 1)]
    everyday = stations.busiest(df, weekdays_only=False).first()
    assert tuple(everyday) == ("A", 3)
    one_day = stations.busiest(df, service_date="2025-06-01").collect()
    assert [tuple(r) for r in one_day] == [("A", 1)]


def test_local_day_reaches_the_scan(spark, tiny):
    events = spark.read.parquet(f"{tiny}/events.parquet").withColumn(
        "vehicle_timestamp", F.col("ts").cast("timestamp"))
    day = stations.positions_on_day(events, "2024-01-15")
    pushed = next(line for line in plan_of(day).splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual" in pushed and "LessThan" in pushed
    slow = events.where(temporal.local_date(F.col("vehicle_timestamp")) == "2024-01-15")
    assert day.count() == slow.count() > 0


def test_repeated_seconds(spark):
    days = spark.createDataFrame([("2025-11-02",), ("2025-03-09",), ("2025-06-01",)], "d string")
    out = days.select(temporal.repeated_seconds(F.to_date("d"))).collect()
    assert [r[0] for r in out] == [3600, 0, 0]


def test_one_station_minute_is_cut_by_the_data(spark):
    """A third of all rows in one minute of one station, at microsecond times."""
    from railstream.functions import slices
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("stop"),
        F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.when(F.col("id") % 3 == 0, F.col("id") * 6000)
                           .otherwise(F.col("id") * 10_000_000)).alias("at"), F.lit(1).alias("w"))
    stored = slices.in_blocks(rows, ["stop"], ["at"], blocks=12)
    sizes = [r["n"] for r in stored.groupBy("_block").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 12 and max(sizes) <= 2 * sorted(sizes)[6]
    got = slices.with_previous(stored, ["stop"], ["at"], "w")
    from pyspark.sql import Window
    order = Window.partitionBy("stop").orderBy("at")
    expected = rows.withColumn("_previous", F.lag("at").over(order)).withColumn(
        "_before", F.row_number().over(order) - 1)
    columns = ["stop", "at", "_previous", "_before"]
    assert got.select(columns).exceptAll(expected.select(columns)).count() == 0
