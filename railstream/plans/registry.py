"""Named queries over the given tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railstream.operators.samples import CONTEXT_FIELDS
from railstream.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(
    name: str, sql: str | None = None, *, dates: tuple[str, ...] = ()
) -> Callable[[Query], Query]:
    """Register a function of (session, data folder) under ``name``.

    Columns in ``dates`` are compared as text: the engines' clients return dates as
    different types.
    """
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            result = function(configure(spark), sf_dir)
            return result.withColumns({c: F.col(c).cast("string") for c in dates})

        QUERIES[name] = run
        if sql is not None:
            as_text = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in dates)
            CHECKS[name] = f"SELECT * REPLACE ({as_text}) FROM ({sql})" if dates else sql
        return function
    return register


# Pieces of the checking SQL.

def nyc(column: str) -> str:
    """Wall clock in New York of a UTC timestamp column."""
    return f"(({column} AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')"


POSITIONS = """SELECT event_type AS stop_name, 40.0::DOUBLE + length(event_type) * 0.5::DOUBLE AS stop_lat,
  -74.0::DOUBLE - length(event_type) * 0.25::DOUBLE AS stop_lon,
  CAST(user_id % 10 AS VARCHAR) AS trip_id, {ts} AS vehicle_timestamp,
  CASE WHEN event_id % 2 = 1 THEN 'Southbound' ELSE 'Northbound' END AS direction FROM events"""

VISITS = """SELECT 'Station ' || CAST(user_id % 30 AS VARCHAR) AS stop_name,
  event_type || '-' || CAST(user_id AS VARCHAR) AS trip_id, ts AS vehicle_timestamp FROM events"""

RAW_STOP_ID = """CASE event_id % 5 WHEN 0 THEN 'A' || user_id WHEN 1 THEN 'A' || user_id || 'N'
  WHEN 2 THEN 'a' || user_id WHEN 3 THEN 'a' || user_id || 's' ELSE ' A' || user_id || 'S ' END"""

STOPS = """SELECT 'A' || s_suppkey AS stop_id, s_name || ', "upper" level' AS stop_name,
  40.0::DOUBLE + s_nationkey * 0.5::DOUBLE AS stop_lat,
  -74.0::DOUBLE - s_nationkey * 0.25::DOUBLE AS stop_lon, s_suppkey % 2 AS location_type,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'P' || s_nationkey END AS parent_station FROM supplier"""

STOP_TIMES = """SELECT CAST(user_id AS VARCHAR) AS trip_uid, date_trunc('day', ts) AS start_time_dts,
  'E' AS route_id, 'S' AS direction, CAST(event_id AS VARCHAR) AS stop_id, event_type AS stop_name,
  40.0::DOUBLE + length(event_type) * 0.5::DOUBLE AS stop_lat,
  -74.0::DOUBLE - length(event_type) * 0.25::DOUBLE AS stop_lon, ts AS arrival_time,
  date_trunc('second', ts) + INTERVAL 30 SECOND AS departure_time FROM events"""

PREPARED = f"""SELECT *, CASE WHEN hour_of_day BETWEEN 7 AND 9 OR hour_of_day BETWEEN 16 AND 19
    THEN 1 ELSE 0 END AS is_rush_hour,
  CASE WHEN day_of_week IN (1, 7) THEN 1 ELSE 0 END AS is_weekend FROM (
  SELECT *, date_sub('second', previous, arrival_time) / 60.0::DOUBLE AS minutes_since_prev_stop,
    hour(arrival_time_nyc) AS hour_of_day, dayofweek(arrival_time_nyc) + 1 AS day_of_week,
    CAST(arrival_time_nyc AS DATE) AS trip_date FROM (
    SELECT *, {nyc("arrival_time")} AS arrival_time_nyc,
      row_number() OVER w AS stop_sequence, lag(arrival_time) OVER w AS previous
    FROM ({STOP_TIMES})
    WHERE route_id = 'E' AND direction = 'S' AND arrival_time IS NOT NULL
      AND stop_lat IS NOT NULL AND stop_lon IS NOT NULL
    WINDOW w AS (PARTITION BY trip_uid ORDER BY arrival_time NULLS FIRST, stop_id NULLS FIRST)))"""

# Samples with target stop 'purchase', by the band join that defines them.
_STEP = ", ".join(f"{c} := s.{c}" for c in CONTEXT_FIELDS)
SAMPLES = f"""WITH numbered AS ({PREPARED}), arrivals AS (SELECT trip_uid, start_time_dts,
    stop_name AS target_stop_name, arrival_time AS target_arrival_time,
    stop_sequence AS target_sequence, minutes_since_prev_stop AS target_minutes_from_prev,
    hour_of_day, day_of_week, trip_date, is_rush_hour, is_weekend
  FROM numbered WHERE stop_name = 'purchase'),
samples AS (SELECT * FROM (SELECT a.*, list(struct_pack({_STEP}) ORDER BY s.stop_sequence) AS context_stops
    FROM arrivals a JOIN numbered s ON a.trip_uid = s.trip_uid
      AND s.stop_sequence < a.target_sequence AND s.stop_sequence >= a.target_sequence - 5
    GROUP BY ALL) WHERE len(context_stops) = 5),
stats AS (SELECT min(trip_date) AS min_date, max(trip_date) AS max_date,
    date_diff('day', min(trip_date), max(trip_date)) AS total_days FROM samples),
dates AS (SELECT *, min_date + CAST(round(total_days * 0.70::DOUBLE) AS INTEGER) AS train_end_date,
    min_date + CAST(round(total_days * 0.85::DOUBLE) AS INTEGER) AS val_end_date FROM stats)
"""
