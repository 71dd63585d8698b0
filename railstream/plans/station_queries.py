"""Station analytics over ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from railstream.functions import temporal
from railstream.operators import stations
from railstream.plans import adapters, rollups
from railstream.plans.registry import POSITIONS, VISITS, nyc, query
from railstream.session import scratch_path

_HOURLY = POSITIONS.format(ts="date_trunc('hour', ts)")
_EXACT = POSITIONS.format(ts="ts")
_DAY = "2024-01-15"


def _idle_sql(positions: str, cap: int, same: str = "local_time = lag(local_time) OVER w",
              minutes: str = "seconds / n", order: str = "") -> str:
    return f"""WITH positions AS ({positions}), diffs AS (
  SELECT stop_name, stop_lat, stop_lon,
    CASE WHEN {same} THEN 60
      ELSE date_sub('second', lag(vehicle_timestamp) OVER w, vehicle_timestamp) END AS gap
  FROM (SELECT *, CAST({nyc("vehicle_timestamp")} AS DATE) AS trip_date,
      CAST({nyc("vehicle_timestamp")} AS TIME) AS local_time FROM positions
    WHERE direction = 'Southbound' AND stop_name IS NOT NULL)
  WINDOW w AS (PARTITION BY stop_name, trip_id, trip_date
    ORDER BY vehicle_timestamp NULLS FIRST, stop_lat NULLS FIRST, stop_lon NULLS FIRST))
SELECT stop_name, stop_lat, stop_lon, CAST(CAST(floor(avg(gap) / 60) AS BIGINT) AS VARCHAR) || ':'
  || lpad(CAST(CAST(round(avg(gap)) AS BIGINT) % 60 AS VARCHAR), 2, '0') AS avg_idle_time_m_s
FROM diffs WHERE gap IS NOT NULL AND gap <= {cap} AND stop_name <> 'Broad Channel'
GROUP BY stop_name, stop_lat, stop_lon"""


@query("idle_time_by_station", _idle_sql(_HOURLY, 21600))
def idle_time_by_station(spark, sf_dir):
    events = adapters.table(spark, sf_dir, "events")
    return stations.idle_time(adapters.positions(events), max_gap_s=21600)


@query("idle_time_default_cap", _idle_sql(_HOURLY, 300))
def idle_time_default_cap(spark, sf_dir):
    events = adapters.table(spark, sf_dir, "events")
    return stations.idle_time(adapters.positions(events))


@query("idle_time_exact_instants",
       _idle_sql(_EXACT, 7200, "vehicle_timestamp = lag(vehicle_timestamp) OVER w"))
def idle_time_exact_instants(spark, sf_dir):
    events = adapters.table(spark, sf_dir, "events")
    return stations.idle_time(adapters.positions(events, hourly=False), max_gap_s=7200,
                              compare="instant", order_by="seconds")


def _arrivals_sql(positions: str, day: str | None = None) -> str:
    local = f"CAST({nyc('vehicle_timestamp')} AS DATE)"
    only = f" AND {local} = DATE '{day}'" if day else ""
    return f"""arrivals AS (SELECT stop_name, {local} AS event_date, trip_id,
    min(vehicle_timestamp) AS trip_arrival_time FROM ({positions})
  WHERE vehicle_timestamp IS NOT NULL AND stop_name IS NOT NULL{only} GROUP BY ALL)"""


def _headway_sql(positions: str, cap: int, day: str | None = None) -> str:
    return f"""WITH {_arrivals_sql(positions, day)}, lags AS (
  SELECT stop_name, event_date, trip_arrival_time AS this_time,
    lag(trip_arrival_time) OVER w AS previous,
    date_sub('minute', lag(trip_arrival_time) OVER w, trip_arrival_time) AS minutes
  FROM arrivals WINDOW w AS (PARTITION BY stop_name, event_date ORDER BY trip_arrival_time))
SELECT l.stop_name, round(avg(minutes), 2) AS average_min_difference_between_trains,
  count(DISTINCT a.trip_id) AS total_unique_trip_ids
FROM lags l JOIN arrivals a ON l.stop_name = a.stop_name AND l.event_date = a.event_date
  AND l.this_time = a.trip_arrival_time
WHERE previous IS NOT NULL AND minutes <= {cap} GROUP BY l.stop_name"""


@query("headway_by_station", _headway_sql(_HOURLY, 600))
def headway_by_station(spark, sf_dir):
    events = adapters.table(spark, sf_dir, "events")
    return stations.headway(adapters.positions(events), max_minutes=600)


@query("headway_default_cap", _headway_sql(VISITS, 20))
def headway_default_cap(spark, sf_dir):
    return stations.headway(adapters.visits(adapters.table(spark, sf_dir, "events")))


@query("headway_on_day", _headway_sql(VISITS, 240, _DAY))
def headway_on_day(spark, sf_dir):
    events = adapters.table(spark, sf_dir, "events")
    return stations.headway(adapters.visits(events), service_date=_DAY, max_minutes=240)


@query("first_arrivals", f"WITH {_arrivals_sql(_HOURLY)} SELECT * FROM arrivals",
       dates=("event_date",))
def first_arrivals(spark, sf_dir):
    events = adapters.table(spark, sf_dir, "events")
    return adapters.plain(stations.first_arrivals(adapters.positions(events)))


@query("busiest_stations_top10", f"""WITH {_arrivals_sql(VISITS)}
SELECT stop_name, count(*) AS total_arrivals FROM arrivals
WHERE dayofweek(event_date) BETWEEN 1 AND 5 GROUP BY stop_name
ORDER BY total_arrivals DESC, stop_name LIMIT 10""")
def busiest_stations_top10(spark, sf_dir):
    return stations.busiest(adapters.visits(adapters.table(spark, sf_dir, "events")))


@query("positions_on_local_day", f"""SELECT stop_name, trip_id, vehicle_timestamp,
  strftime({nyc("vehicle_timestamp")}, '%H:%M:%S.%f') AS local_time FROM ({_EXACT})
WHERE CAST({nyc("vehicle_timestamp")} AS DATE) = DATE '{_DAY}'""")
def positions_on_local_day(spark, sf_dir):
    events = adapters.positions(adapters.table(spark, sf_dir, "events"), hourly=False)
    return adapters.plain(
        stations.positions_on_day(events, _DAY)
        .withColumn("local_time", temporal.local_time(events["vehicle_timestamp"]))
        .select("stop_name", "trip_id", "vehicle_timestamp", "local_time"))


def _daily(spark, positions, **limits):
    """Sums of all days, from two refreshes that share a day."""
    path = scratch_path(spark, "daily")
    day = temporal.local_date(F.col("vehicle_timestamp"))
    first, last = positions.agg(F.min(day), F.max(day)).first()
    middle = first + (last - first) // 2
    for dates in ((first, middle), (middle, last)):
        daily = rollups.refresh(positions, path, *map(str, dates), **limits)
    return daily


@query("rollup_idle_time", _idle_sql(_HOURLY, 21600))
def rollup_idle_time(spark, sf_dir):
    positions = adapters.positions(adapters.table(spark, sf_dir, "events"))
    return rollups.idle_time(_daily(spark, positions, max_gap_s=21600))


@query("rollup_headway", f"""WITH days AS (SELECT h.stop_name, count(minutes) AS n, sum(minutes) AS total,
    count(DISTINCT (h.event_date, trip_id)) AS trips FROM (
  WITH {_arrivals_sql(_HOURLY)}, lags AS (SELECT stop_name, event_date, trip_arrival_time AS this_time,
    lag(trip_arrival_time) OVER w AS previous,
    date_sub('minute', lag(trip_arrival_time) OVER w, trip_arrival_time) AS minutes
    FROM arrivals WINDOW w AS (PARTITION BY stop_name, event_date ORDER BY trip_arrival_time))
  SELECT l.stop_name, l.event_date, a.trip_id, l.minutes FROM lags l JOIN arrivals a
    ON l.stop_name = a.stop_name AND l.event_date = a.event_date AND l.this_time = a.trip_arrival_time
  WHERE previous IS NOT NULL AND minutes <= 600) h GROUP BY h.stop_name)
SELECT stop_name, round(total / n, 2) AS average_min_difference_between_trains, trips AS total_trips
FROM days""")
def rollup_headway(spark, sf_dir):
    positions = adapters.positions(adapters.table(spark, sf_dir, "events"))
    return rollups.headway(_daily(spark, positions, max_minutes=600))


@query("rollup_busiest", f"""WITH {_arrivals_sql(_HOURLY)}
SELECT stop_name, CAST(count(*) AS BIGINT) AS total_arrivals FROM arrivals
WHERE dayofweek(event_date) BETWEEN 1 AND 5 GROUP BY stop_name""")
def rollup_busiest(spark, sf_dir):
    positions = adapters.positions(adapters.table(spark, sf_dir, "events"))
    return rollups.busiest(_daily(spark, positions))
