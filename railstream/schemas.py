"""Fixed schemas of messages and tables. Nothing is ever inferred."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import types as T

_TRIP = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("start_time", T.StringType()),
    T.StructField("start_date", T.StringType()),
    T.StructField("route_id", T.StringType()),
])

_ENTITY = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("trip_update", T.StructType([
        T.StructField("trip", _TRIP),
        T.StructField("stop_time_update", T.ArrayType(T.StructType([
            T.StructField("stop_id", T.StringType()),
        ]))),
    ])),
    T.StructField("vehicle", T.StructType([
        T.StructField("trip", _TRIP),
        T.StructField("stop_id", T.StringType()),
        T.StructField("current_status", T.StringType()),
        T.StructField("current_stop_sequence", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ])),
])

# Feed message. Numbers come as JSON strings or numbers; STRING reads both.
FEED_MESSAGE = T.StructType([
    T.StructField("unique_event_id", T.StringType()),
    T.StructField("event_timestamp_unix", T.StringType()),
    T.StructField("header", T.StructType([T.StructField("timestamp", T.StringType())])),
    T.StructField("entity", T.ArrayType(_ENTITY)),
])

# One row per vehicle report.
POSITIONS = T.StructType([
    T.StructField("unique_event_id", T.StringType()),
    T.StructField("feed_header_timestamp", T.TimestampType()),
    T.StructField("entity_id", T.StringType()),
    T.StructField("trip_id", T.StringType()),
    T.StructField("start_time", T.StringType()),
    T.StructField("start_date", T.StringType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("stop_id", T.StringType()),
    T.StructField("vehicle_timestamp", T.TimestampType()),
    T.StructField("current_status", T.StringType()),
    T.StructField("current_stop_sequence", T.LongType()),
    T.StructField("stop_name", T.StringType()),
    T.StructField("stop_lat", T.DoubleType()),
    T.StructField("stop_lon", T.DoubleType()),
    T.StructField("direction", T.StringType()),
])

# Stop reference table.
STOPS = T.StructType([
    T.StructField("stop_id", T.StringType(), nullable=False),
    T.StructField("stop_name", T.StringType()),
    T.StructField("stop_lat", T.DoubleType()),
    T.StructField("stop_lon", T.DoubleType()),
    T.StructField("location_type", T.LongType()),
    T.StructField("parent_station", T.StringType()),
])

# Historical stop observations as found in the monthly CSV files.
SENSOR_DATA = T.StructType([
    T.StructField("trip_uid", T.StringType()),
    T.StructField("stop_id", T.StringType()),
    T.StructField("track", T.StringType()),
    T.StructField("arrival_time", T.TimestampType()),
    T.StructField("departure_time", T.TimestampType()),
    T.StructField("last_observed", T.TimestampType()),
    T.StructField("marked_past", T.TimestampType()),
])

# Trips as found in the monthly CSV files.
TRIPS = T.StructType([
    T.StructField("trip_uid", T.StringType(), nullable=False),
    T.StructField("start_time_dts", T.TimestampType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("direction", T.StringType()),
])

# Input of the training-data steps: stop times with trip and stop attributes.
STOP_TIMES = T.StructType([
    T.StructField("trip_uid", T.StringType()),
    T.StructField("start_time_dts", T.TimestampType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("direction", T.StringType()),
    T.StructField("stop_id", T.StringType()),
    T.StructField("stop_name", T.StringType()),
    T.StructField("stop_lat", T.DoubleType()),
    T.StructField("stop_lon", T.DoubleType()),
    T.StructField("arrival_time", T.TimestampType()),
    T.StructField("departure_time", T.TimestampType()),
])

# Warehouse type names used in schema files (fixed values).
_FIELD_TYPES = {
    "STRING": T.StringType(),
    "BYTES": T.BinaryType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampType(),
}


def from_json_fields(fields: str | Iterable[Mapping[str, str]]) -> T.StructType:
    """Schema from a list of ``{name, type, mode, description}``, given as objects or JSON text."""
    items = json.loads(fields) if isinstance(fields, str) else list(fields)
    columns = []
    for item in items:
        text = item.get("description", "")
        columns.append(T.StructField(
            item["name"],
            _FIELD_TYPES[item["type"].upper()],
            nullable=item.get("mode", "NULLABLE").upper() != "REQUIRED",
            metadata={"comment": text} if text else {},
        ))
    return T.StructType(columns)
