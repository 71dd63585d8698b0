"""Daily sums give the reports that all vehicle reports give."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from railstream.operators import stations
from railstream.plans import rollups
from tests.conftest import plan_of

SCHEMA = ("stop_name string, stop_lat double, stop_lon double, trip_id string, "
          "vehicle_timestamp timestamp, direction string")


@pytest.fixture(scope="module")
def positions(spark):
    """Three weeks around the end of summer time, with repeats, ties and gaps across midnight."""
    rng = random.Random(4)
    start = dt.datetime(2025, 10, 20, 3, tzinfo=dt.timezone.utc)
    rows = []
    for _ in range(1500):
        at = start + dt.timedelta(minutes=rng.randrange(21 * 24 * 12) * 5)
        for second in rng.choice([(0,), (0, 30), (0, 30, 30, 200)]):
            rows.append((rng.choice(["A", "A", "A", "B", "Broad Channel", None]), 1.0, 2.0,
                         rng.choice(["t1", "t2", "t3", None]), at + dt.timedelta(seconds=second),
                         rng.choice(["Southbound", "Northbound"])))
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_reports_from_daily_sums(spark, positions, tmp_path):
    target = str(tmp_path / "daily")
    limits = {"max_gap_s": 20_000, "max_minutes": 300}
    rollups.refresh(positions, target, "2025-10-19", "2025-10-31", **limits)
    rollups.refresh(positions, target, "2025-11-01", "2025-11-20", **limits)
    # Days that are there are replaced, not added.
    daily = rollups.refresh(positions, target, "2025-10-25", "2025-11-03", **limits)
    assert rows_of(rollups.idle_time(daily)) == rows_of(stations.idle_time(positions, max_gap_s=20_000))
    assert rows_of(rollups.busiest(daily)) == rows_of(stations.busiest(positions))
    means = [r[:2] for r in rows_of(rollups.headway(daily))]
    assert means == [r[:2] for r in rows_of(stations.headway(positions, max_minutes=300))]
    day = rollups.read(spark, target, "2025-10-27", "2025-10-27")
    assert rows_of(rollups.headway(day)) == rows_of(
        stations.headway(positions, service_date="2025-10-27", max_minutes=300))
    assert "service_date" in next(x for x in plan_of(day).splitlines() if "PartitionFilters" in x)


def test_a_refresh_takes_new_reports_of_its_days_only(spark, positions, tmp_path):
    target = str(tmp_path / "daily")
    rollups.refresh(positions, target, "2025-10-19", "2025-11-20")
    later = positions.withColumn("trip_id", F.concat(F.lit("x"), "trip_id"))
    daily = rollups.refresh(positions.unionByName(later), target, "2025-10-27", "2025-10-27")
    arrivals = {r.service_date: r.trips for r in daily.where("kind = 'arrivals'")
                .groupBy("service_date").agg(F.sum("trips").alias("trips")).collect()}
    before = {str(r.event_date): r.n for r in stations.first_arrivals(positions)
              .groupBy("event_date").agg(F.count("*").alias("n")).collect()}
    assert arrivals["2025-10-27"] > before["2025-10-27"]
    assert {d: n for d, n in arrivals.items() if d != "2025-10-27"} == {
        d: n for d, n in before.items() if d != "2025-10-27"}


def test_no_reports(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    rollups.daily_sums(empty).write.parquet(str(tmp_path / "none"))
    assert rollups.idle_time(rollups.daily_sums(empty)).count() == 0
