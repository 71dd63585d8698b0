"""Feed messages made from ``events`` and ``lineitem``, stops made from ``supplier``."""

from __future__ import annotations

from pyspark.sql import functions as F

from railstream.operators import binary_feed, feed
from railstream.plans import adapters
from railstream.plans.registry import RAW_STOP_ID, STOPS, query
from railstream.session import scratch_path
from railstream.sources import stops as stop_files
from railstream.sources.tables import replace_table

VEHICLE_ROWS = f"""SELECT 'm' || event_id AS unique_event_id,
  to_timestamp(floor(epoch_us(ts) / 1000000 / 30) * 30) AT TIME ZONE 'UTC' AS feed_header_timestamp,
  'v' || event_id AS entity_id, CAST(user_id AS VARCHAR) AS trip_id,
  CAST(NULL AS VARCHAR) AS start_time, CAST(NULL AS VARCHAR) AS start_date, 'E' AS route_id,
  {RAW_STOP_ID} AS stop_id, date_trunc('second', ts) AS vehicle_timestamp,
  event_type AS current_status, event_id % 40 AS current_stop_sequence FROM events"""

_FLAT = ("unique_event_id", "feed_header_timestamp", "entity_id", "trip_id", "start_time",
         "start_date", "route_id", "stop_id", "vehicle_timestamp", "current_status",
         "current_stop_sequence")


def enriched_sql(rows: str) -> str:
    """``rows`` (with ``stop_id``) joined to the stops by the four keys in turn."""
    stem = r"CASE WHEN regexp_matches(key, '\p{L}$') THEN left(key, -1) END"
    names = ", ".join(f"coalesce(a.{c}, b.{c}, c.{c}, d.{c}) AS {c}"
                      for c in ("stop_name", "stop_lat", "stop_lon"))
    return f"""WITH stops AS ({STOPS}), keyed AS (SELECT *, {stem} AS stem FROM
  (SELECT *, trim(stop_id) AS key FROM ({rows})))
SELECT keyed.* EXCLUDE (key, stem), {names},
  CASE WHEN key IS NULL OR keyed.stop_id = '' THEN NULL
    WHEN contains(key, 'S') THEN 'Southbound' ELSE 'Northbound' END AS direction
FROM keyed LEFT JOIN stops a ON a.stop_id = key LEFT JOIN stops b ON b.stop_id = upper(key)
  LEFT JOIN stops c ON c.stop_id = stem LEFT JOIN stops d ON d.stop_id = upper(stem)"""


@query("flatten_vehicle_messages", VEHICLE_ROWS)
def flatten_vehicle_messages(spark, sf_dir):
    messages = adapters.messages(adapters.table(spark, sf_dir, "events"))
    parsed = feed.good_messages(feed.parse_messages(messages))
    reports = feed.vehicle_positions(feed.flatten_messages(parsed))
    return adapters.plain(reports.select(*_FLAT))


@query("flatten_all_entities", f"""SELECT entity_id, trip_id, stop_id, current_status,
  vehicle_timestamp FROM ({VEHICLE_ROWS}) UNION ALL
SELECT 't' || event_id, CAST(user_id AS VARCHAR), 'T' || i, NULL, NULL
FROM events, (VALUES (1), (2), (3)) AS v(i) WHERE i <= user_id % 4""")
def flatten_all_entities(spark, sf_dir):
    messages = adapters.messages(adapters.table(spark, sf_dir, "events"))
    reports = feed.flatten_messages(feed.good_messages(feed.parse_messages(messages)))
    return adapters.plain(reports.select("entity_id", "trip_id", "stop_id", "current_status",
                                         "vehicle_timestamp"))


@query("flatten_trip_updates", """SELECT l_shipdate AS feed_header_timestamp,
  CAST(l_partkey AS VARCHAR) AS entity_id, CAST(l_orderkey AS VARCHAR) AS trip_id,
  l_suppkey || '-' || i AS stop_id
FROM (SELECT *, unnest(generate_series(1, l_linenumber)) AS i FROM lineitem)""")
def flatten_trip_updates(spark, sf_dir):
    messages = adapters.trip_messages(adapters.table(spark, sf_dir, "lineitem"))
    reports = feed.flatten_messages(feed.good_messages(feed.parse_messages(messages)))
    return adapters.plain(reports.select("feed_header_timestamp", "entity_id", "trip_id", "stop_id"))


# What the feed itself sends: statuses are numbers, every seventh report has none.
_STATUS = """CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'INCOMING_AT'
  WHEN event_id % 3 = 1 THEN 'STOPPED_AT' ELSE 'IN_TRANSIT_TO' END"""
BINARY_ROWS = (f"SELECT * EXCLUDE (unique_event_id) REPLACE ({_STATUS} AS current_status) "
               f"FROM (SELECT *, CAST(substr(entity_id, 2) AS BIGINT) AS event_id FROM ({VEHICLE_ROWS}))")


@query("flatten_binary_messages", f"""SELECT * EXCLUDE (event_id)
  REPLACE (CAST(current_stop_sequence AS VARCHAR) AS current_stop_sequence) FROM ({BINARY_ROWS}) UNION ALL
SELECT to_timestamp(floor(epoch_us(ts) / 1000000 / 30) * 30) AT TIME ZONE 'UTC', 't' || event_id,
  CAST(user_id AS VARCHAR), NULL, NULL, 'E', 'T' || i, NULL, NULL, NULL
FROM events, (VALUES (1), (2), (3)) AS v(i) WHERE i <= user_id % 4""")
def flatten_binary_messages(spark, sf_dir):
    messages = adapters.binary_messages(adapters.table(spark, sf_dir, "events"))
    decoded = feed.good_messages(binary_feed.decode_messages(messages))
    return adapters.plain(feed.flatten_messages(decoded).select(*_FLAT[1:]).withColumn(
        "current_stop_sequence", F.col("current_stop_sequence").cast("string")))


@query("malformed_binary_messages", """SELECT event_id, event_id % 10 = 0 AS rejected FROM events""")
def malformed_binary_messages(spark, sf_dir):
    """Every tenth message is cut short."""
    messages = adapters.binary_messages(adapters.table(spark, sf_dir, "events"))
    cut = messages.withColumn("value", F.when(
        F.col("event_id") % 10 == 0, F.expr("substring(value, 1, octet_length(value) - 1)"))
        .otherwise(F.col("value")))
    decoded = binary_feed.decode_messages(cut, vehicles_only=True)
    return decoded.select("event_id", F.col("_bad_payload").isNotNull().alias("rejected"))


@query("published_binary_messages", f"""SELECT CAST(epoch_us(ts) // 30000000 * 30 AS VARCHAR)
    AS header_timestamp, epoch_us(ts) // 30000000 * 30 AS event_timestamp_unix, 2 AS entities,
  {_STATUS} AS current_status, event_id % 40 AS current_stop_sequence, user_id % 4 AS stops
FROM events""")
def published_binary_messages(spark, sf_dir):
    """Protocol buffers in, JSON with an envelope out, and read again."""
    messages = adapters.binary_messages(adapters.table(spark, sf_dir, "events"))
    published = binary_feed.published_json(binary_feed.decode_messages(messages))
    parsed = feed.good_messages(feed.parse_messages(published))
    vehicle = F.col("entity")[0]["vehicle"]
    return parsed.select(
        F.col("header.timestamp").alias("header_timestamp"), "event_timestamp_unix",
        F.size("entity").alias("entities"), vehicle["current_status"].alias("current_status"),
        vehicle["current_stop_sequence"].cast("bigint").alias("current_stop_sequence"),
        F.coalesce(F.size(F.col("entity")[1]["trip_update"]["stop_time_update"]), F.lit(0))
         .cast("bigint").alias("stops"))


@query("malformed_messages", """SELECT event_id, event_id % 10 = 0 AS rejected, CASE
  WHEN event_id % 10 = 0 THEN left('{"header":{"timestamp":"' || CAST(epoch_us(ts) // 1000000
    AS VARCHAR) || '"},"entity":[{"id":"' || event_id || '"}]}', -1) END AS bad_payload
FROM events""")
def malformed_messages(spark, sf_dir):
    payloads = adapters.short_payloads(adapters.table(spark, sf_dir, "events"))
    cut = payloads.withColumn("value", F.when(
        F.col("event_id") % 10 == 0, F.expr("left(value, length(value) - 1)"))
        .otherwise(F.col("value")))
    parsed = feed.parse_messages(cut)
    rejected = F.col("_bad_payload").isNotNull()
    return parsed.select("event_id", rejected.alias("rejected"),
                         F.col("_bad_payload").alias("bad_payload"))


@query("message_envelope", """SELECT event_id, epoch_us(ts) // 1000000 AS event_timestamp_unix,
  CAST(epoch_us(ts) // 1000000 AS VARCHAR) || '-' || sha256('{"header":{"timestamp":"'
    || CAST(epoch_us(ts) // 1000000 AS VARCHAR) || '"},"entity":[{"id":"' || event_id || '"}]}')
    AS unique_event_id FROM events""")
def message_envelope(spark, sf_dir):
    payloads = adapters.short_payloads(adapters.table(spark, sf_dir, "events"))
    return feed.add_envelope(payloads).drop("value")


@query("enrich_positions", enriched_sql(f"""SELECT CAST(event_id AS VARCHAR) AS entity_id,
  {RAW_STOP_ID} AS stop_id, event_type AS current_status FROM events"""))
def enrich_positions(spark, sf_dir):
    reports = adapters.reports(adapters.table(spark, sf_dir, "events"))
    lookup = stop_files.stop_lookup(adapters.stops(adapters.table(spark, sf_dir, "supplier")))
    return feed.enrich_with_stops(reports, lookup).select(
        "entity_id", "stop_id", "current_status", "stop_name", "stop_lat", "stop_lon", "direction")


@query("stops_reference_load", STOPS)
def stops_reference_load(spark, sf_dir):
    path = scratch_path(spark, "stops")
    stops = adapters.stops(adapters.table(spark, sf_dir, "supplier"))
    stops.write.option("header", True).option("escape", '"').csv(f"{path}/csv")
    return replace_table(stop_files.read_stops(spark, f"{path}/csv"), f"{path}/table",
                         as_path=True)


@query("stop_lookup_load", f"""SELECT stop_id, stop_name, stop_lat, stop_lon FROM (
  SELECT stop_id, stop_name, CAST(stop_lat AS VARCHAR) AS stop_lat,
    CAST(stop_lon AS VARCHAR) AS stop_lon FROM ({STOPS}))""")
def stop_lookup_load(spark, sf_dir):
    path = scratch_path(spark, "lookup")
    stops = adapters.stops(adapters.table(spark, sf_dir, "supplier"))
    (stops.select("stop_id", F.concat(F.lit("  "), "stop_name"), "stop_lat", "stop_lon",
                  "parent_station")
          .write.option("header", True).option("escape", '"').csv(path))
    return stop_files.read_stop_lookup(spark, path)
