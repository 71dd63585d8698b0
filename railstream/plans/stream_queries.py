"""Structured Streaming over ``events``; each query runs its stream to the end of the input."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railstream.operators import feed
from railstream.plans import adapters
from railstream.plans.feed_queries import BINARY_ROWS, VEHICLE_ROWS, enriched_sql
from railstream.plans.registry import query
from railstream.session import scratch_path
from railstream.sources import stops as stop_files
from railstream.sources.feed_stream import read_feed_stream
from railstream.streaming import permanent, streams

_ALL = {"availableNow": True}
_CLOSING = "closing"


def _closed(spark: SparkSession, sf_dir: str, label: str, make, log: bool = False):
    """Run ``make(events)`` to the end, then once more on the same checkpoint for a row a day later.

    The late row lets the last window close. It comes after all batches of the input, however
    many, so no batch is late. Returns the rows, and the stored progress if ``log``.
    """
    path = scratch_path(spark, label)
    events = adapters.table(spark, sf_dir, "events")
    closing = (events.agg((F.max("ts") + F.expr("interval 1 day")).alias("ts"))
               .select(*[F.col("ts") if f.name == "ts" else
                         (F.lit(_CLOSING) if f.name == "event_type" else F.lit(None))
                         .cast(f.dataType).alias(f.name) for f in events.schema.fields]))
    closing.limit(0).write.parquet(f"{path}/closing")
    later = spark.readStream.schema(events.schema).parquet(f"{path}/closing")
    rows = make(adapters.stream(spark, sf_dir, "events").unionByName(later)
                .withColumn("publish_time", adapters.instant("ts")))
    name = f"{label}-{path[-12:]}"
    with streams.ProgressLog(spark, f"{path}/progress", name) if log else nullcontext():
        for turn in range(2):
            if turn:
                closing.write.mode("append").parquet(f"{path}/closing")
            streams.finish(streams.append_stream(rows, f"{path}/rows", f"{path}/checkpoint",
                                                 trigger=_ALL, name=name))
    stored = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    return (stored, streams.progress_table(spark, f"{path}/progress")) if log else stored


def _collected(spark: SparkSession, df: DataFrame, label: str, partition_by=()) -> DataFrame:
    """Append the stream to a fresh folder and read that back."""
    path = scratch_path(spark, label)
    streams.finish(streams.append_stream(df, f"{path}/rows", f"{path}/checkpoint", trigger=_ALL,
                                         partition_by=partition_by))
    return spark.read.schema(df.schema).parquet(f"{path}/rows")


_WINDOWS_SQL = """SELECT to_timestamp(floor(epoch_us(ts) / 1000000 / 30) * 30) AT TIME ZONE 'UTC'
    AS window_start, to_timestamp(floor(epoch_us(ts) / 1000000 / 30) * 30 + 30) AT TIME ZONE 'UTC'
    AS window_end, event_type, count(*) AS n FROM events GROUP BY ALL"""


@query("stream_windowed_counts", _WINDOWS_SQL)
def stream_windowed_counts(spark, sf_dir):
    rows = _closed(spark, sf_dir, "windows",
                   lambda events: streams.windowed_counts(events, keys=["event_type"]))
    return adapters.plain(rows.where(F.col("event_type") != _CLOSING))


@query("stream_delta_counts", _WINDOWS_SQL)
def stream_delta_counts(spark, sf_dir):
    path = scratch_path(spark, "deltas")
    events = (adapters.stream(spark, sf_dir, "events")
              .withColumn("publish_time", adapters.instant("ts")))
    streams.finish(streams.write_delta_counts(events, f"{path}/rows", f"{path}/checkpoint",
                                              keys=["event_type"], trigger=_ALL))
    deltas = spark.read.schema("window_start timestamp, window_end timestamp, event_type string, "
                               "n bigint, batch int").parquet(f"{path}/rows")
    return adapters.plain(deltas.groupBy("window_start", "window_end", "event_type")
                                .agg(F.sum("n").alias("n")))


@query("stream_assigned_windows", """SELECT event_id,
  to_timestamp(floor(epoch_us(ts) / 1000000 / 30) * 30) AT TIME ZONE 'UTC' AS window_start,
  to_timestamp(floor(epoch_us(ts) / 1000000 / 30) * 30 + 30) AT TIME ZONE 'UTC' AS window_end
FROM events""")
def stream_assigned_windows(spark, sf_dir):
    events = (adapters.stream(spark, sf_dir, "events")
              .withColumn("publish_time", adapters.instant("ts")))
    rows = streams.assign_window(events).select("event_id", "window_start", "window_end")
    return adapters.plain(_collected(spark, rows, "assigned"))


_LIVE = ("unique_event_id", "feed_header_timestamp", "entity_id", "trip_id", "route_id", "stop_id",
         "vehicle_timestamp", "current_status", "current_stop_sequence", "stop_name", "stop_lat",
         "stop_lon", "direction")


@query("stream_live_positions",
       f"SELECT * EXCLUDE (start_time, start_date) FROM ({enriched_sql(VEHICLE_ROWS)})")
def stream_live_positions(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    adapters.messages(adapters.table(spark, sf_dir, "events")).select("value").write.text(landing)
    lookup = stop_files.stop_lookup(adapters.stops(adapters.table(spark, sf_dir, "supplier")))
    live = feed.live_positions(read_feed_stream(spark, landing), lookup)
    return adapters.plain(_collected(spark, live, "live").select(*_LIVE))


@query("stream_binary_positions", f"""SELECT * EXCLUDE (start_time, start_date, event_id)
FROM ({enriched_sql(BINARY_ROWS)}) WHERE current_status IS NOT NULL""")
def stream_binary_positions(spark, sf_dir):
    """The live chain on what the feed itself sends."""
    messages = adapters.binary_messages(adapters.stream(spark, sf_dir, "events"))
    lookup = stop_files.stop_lookup(adapters.stops(adapters.table(spark, sf_dir, "supplier")))
    live = feed.live_positions(messages, lookup, form="protobuf")
    return adapters.plain(_collected(spark, live, "binary").select(*_LIVE[1:]))


@query("stream_flushed_rows", """SELECT event_id, event_type, ts, CAST(ts AS DATE) AS day, 1 AS copies
FROM events""", dates=("day",))
def stream_flushed_rows(spark, sf_dir):
    """A stream's output, flushed to permanent storage between its two runs and after them."""
    path = scratch_path(spark, "buffer")
    events = adapters.table(spark, sf_dir, "events")
    rows = events.select("event_id", "event_type", "ts", F.to_date("ts").alias("day"))
    half = F.col("event_id") % 2
    for turn in range(2):
        rows.where(half == turn).write.mode("append").parquet(f"{path}/landing")
        live = (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
                .parquet(f"{path}/landing"))
        streams.finish(streams.append_stream(live, f"{path}/rows", f"{path}/checkpoint", trigger=_ALL,
                                             partition_by=["day"]))
        buffer = spark.read.schema(rows.schema).parquet(f"{path}/rows")
        if not turn:
            permanent.flush(buffer, f"{path}/store", "first", partition_by=["day"],
                            sort_by=["event_type", "ts"])
    stored = permanent.read(buffer, f"{path}/store")
    return stored.groupBy(*rows.columns).agg(F.count("*").alias("copies"))


@query("stream_publish_messages", """SELECT CAST(epoch_us(ts) // 1000000 AS VARCHAR) || '-'
  || sha256('{"header":{"timestamp":"' || CAST(epoch_us(ts) // 1000000 AS VARCHAR)
    || '"},"entity":[{"id":"' || event_id || '"}]}') AS unique_event_id,
  epoch_us(ts) // 1000000 AS event_timestamp_unix,
  CAST(epoch_us(ts) // 1000000 AS VARCHAR) AS header_timestamp,
  CAST(event_id AS VARCHAR) AS entity_id FROM events""")
def stream_publish_messages(spark, sf_dir):
    path = scratch_path(spark, "published")
    payloads = adapters.short_payloads(adapters.stream(spark, sf_dir, "events"))
    streams.finish(streams.publish_messages(feed.enveloped_json(payloads), f"{path}/rows",
                                            f"{path}/checkpoint", trigger=_ALL))
    parsed = feed.good_messages(feed.parse_messages(spark.read.text(f"{path}/rows")))
    return parsed.select("unique_event_id", "event_timestamp_unix",
                         F.col("header.timestamp").alias("header_timestamp"),
                         F.col("entity")[0]["id"].alias("entity_id"))


@query("stream_dedupe_positions", """SELECT DISTINCT CAST(event_id AS VARCHAR) AS entity_id,
  'A' || user_id AS stop_id, date_trunc('second', ts) AS vehicle_timestamp,
  event_type AS current_status FROM events""")
def stream_dedupe_positions(spark, sf_dir):
    """Every report comes in twice."""
    rows = adapters.stream(spark, sf_dir, "events").withColumn(
        "publish_time", adapters.instant("ts")).select(
        F.col("event_id").cast("string").alias("entity_id"),
        F.concat(F.lit("A"), F.col("user_id").cast("string")).alias("stop_id"),
        F.timestamp_seconds(F.unix_seconds("publish_time")).alias("vehicle_timestamp"),
        F.col("event_type").alias("current_status"), "publish_time",
        F.explode(F.array(F.lit(1), F.lit(2))).alias("poll"))
    # The horizon covers the table: its files are not in the order of arrival.
    distinct = _collected(spark, streams.dedupe_positions(rows, horizon="3650 days"), "distinct")
    return adapters.plain(distinct.select("entity_id", "stop_id", "vehicle_timestamp",
                                          "current_status"))


@query("stream_rejects", """SELECT CASE WHEN event_id % 10 = 0 THEN 'reject' ELSE 'position' END
  AS kind, count(*) AS n, sum(event_id) AS events FROM events GROUP BY ALL""")
def stream_rejects(spark, sf_dir):
    """Messages in, positions and rejects out of one write; every tenth is cut short."""
    landing = scratch_path(spark, "landing")
    events = adapters.table(spark, sf_dir, "events")
    (adapters.messages(events).select(F.when(F.col("event_id") % 10 == 0, F.expr(
        "left(value, length(value) - 1)")).otherwise(F.col("value")).alias("value"))
     .write.text(landing))
    lookup = stop_files.stop_lookup(adapters.stops(adapters.table(spark, sf_dir, "supplier")))
    rows = _collected(spark, feed.live_rows(read_feed_stream(spark, landing, files_per_trigger=4),
                                            lookup), "rejects", ["kind", "service_date"])
    event = F.coalesce(F.substring("entity_id", 2, 20),
                       F.regexp_extract("bad_payload", r'"id": ?"v(\d+)"', 1)).cast("bigint")
    return rows.groupBy("kind").agg(F.count("*").alias("n"), F.sum(event).alias("events"))


@query("stream_progress", """SELECT count(*) + 1 AS input_rows, 0 AS dropped_late_rows,
  date_trunc('milliseconds', max(ts)) + INTERVAL 1 DAY - INTERVAL 10 SECOND AS watermark FROM events""")
def stream_progress(spark, sf_dir):
    _, progress = _closed(spark, sf_dir, "progress", streams.windowed_counts, log=True)
    return adapters.plain(progress.agg(F.sum("input_rows").alias("input_rows"),
                                       F.sum("dropped_late_rows").alias("dropped_late_rows"),
                                       F.max("watermark").alias("watermark")))
