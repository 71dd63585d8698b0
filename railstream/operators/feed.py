"""Nested feed messages -> one row per vehicle report, enriched with stop data.

Every function is stateless and works on batch and streaming DataFrames alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railstream import constants, schemas
from railstream.functions import temporal, text
from railstream.operators.binary_feed import decode_messages

_BAD = "_bad_payload"


def add_envelope(df: DataFrame, payload: str = "value") -> DataFrame:
    """Adds ``unique_event_id`` and ``event_timestamp_unix`` to raw JSON messages.

    Event time is the header's time, or the current time when it has none. The id is that
    time and a SHA-256 of the payload: equal in every task and every attempt.
    """
    header = F.get_json_object(F.col(payload), "$.header.timestamp").try_cast("bigint")
    return (df.withColumn("event_timestamp_unix",
                          F.coalesce(header, F.unix_seconds(F.current_timestamp())))
              .withColumn("unique_event_id",
                          F.concat_ws("-", F.col("event_timestamp_unix").cast("string"),
                                      F.sha2(F.col(payload), 256))))


def enveloped_json(df: DataFrame, payload: str = "value") -> DataFrame:
    """Raw JSON messages -> the JSON text to publish, one column ``value``.

    The two envelope fields are put at the end of the object and the rest of the text stays
    as it is. A payload that is not an object is passed on unchanged, to be rejected by
    ``parse_messages``.
    """
    body = F.regexp_extract(F.col(payload), r"(?s)^\s*(\{.*)\}\s*$", 1)
    fields = F.to_json(F.struct("unique_event_id", "event_timestamp_unix"))
    comma = F.when(body.rlike(r"^\{\s*$"), "").otherwise(",")
    return add_envelope(df, payload).select(
        F.when(body != "", F.concat(body, comma, F.substring(fields, F.lit(2), F.length(fields))))
         .otherwise(F.col(payload)).alias("value"))


def parse_messages(
    df: DataFrame, payload: str = "value", *, on_bad: str = "reject"
) -> DataFrame:
    """JSON payloads -> typed message columns beside the input's own, and a processing time.

    A payload that is not a JSON object is kept with all message fields NULL
    (``on_bad="reject"``; see ``good_messages`` and ``rejected_messages``) or stops the
    query (``on_bad="fail"``).
    """
    if on_bad not in ("reject", "fail"):
        raise ValueError("on_bad must be 'reject' or 'fail'")
    raw = F.col(payload).cast("string")
    # Blank text and a bare null are no objects, but are not reported as corrupt.
    blank = raw.rlike(r"^\s*(null)?\s*$")
    fields = list(schemas.FEED_MESSAGE.fields)
    columns = {"event_timestamp_unix": F.col("event_timestamp_unix").try_cast("bigint")}
    if on_bad == "fail":
        parsed = F.when(blank, F.raise_error("Malformed message: blank payload")).otherwise(
            F.from_json(raw, schemas.FEED_MESSAGE, {"mode": "FAILFAST"}))
    else:
        fields.append(T.StructField(_BAD, T.StringType()))
        parsed = F.from_json(raw, T.StructType(fields), {
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
        columns[_BAD] = F.coalesce(F.col(_BAD), F.when(blank, raw))
    names = [f.name for f in fields]
    kept = [c for c in df.columns if c not in names]
    # Generated as a one-element array: filters on the result then do not parse once more.
    rows = df.select(*kept, F.inline(F.array(parsed)))
    return rows.select(*kept, *[columns.get(n, F.col(n)).alias(n) for n in names],
                       F.current_timestamp().alias("processing_time"))


def good_messages(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(_BAD).isNull()).drop(_BAD)


def rejected_messages(parsed: DataFrame) -> DataFrame:
    """Payload text of the messages that could not be parsed, column ``bad_payload``."""
    return parsed.where(F.col(_BAD).isNotNull()).select(F.col(_BAD).alias("bad_payload"))


def flatten_messages(
    messages: DataFrame, *, vehicles_only: bool = False, keep_rejects: bool = False
) -> DataFrame:
    """Parsed messages -> the 15 fields of ``schemas.POSITIONS``, one row per report.

    An entity with a trip update gives a row per stop in it; otherwise one with a vehicle
    gives one row; otherwise none. Stop attributes are NULL until enrichment.

    ``vehicles_only`` makes no rows for trip updates. Most rows of a feed are such, and none
    has a status: use it where only rows with a status are kept.

    ``keep_rejects`` takes parsed messages before ``good_messages``: a message that could not be
    parsed gives one row with its text in the further column ``bad_payload``.
    """
    entity = F.col("entity")
    if vehicles_only:
        entity = F.filter(entity, lambda e: e["trip_update"].isNull() & e["vehicle"].isNotNull())
    also = []
    if keep_rejects:
        nobody = F.array(F.lit(None).cast(messages.schema["entity"].dataType.elementType))
        entity = F.when(F.col(_BAD).isNotNull(), nobody).otherwise(entity)
        also = [F.col(_BAD).alias("bad_payload")]
    entities = messages.select(
        "unique_event_id",
        temporal.epoch_text(F.col("header.timestamp")).alias("feed_header_timestamp"),
        F.explode(entity).alias("e"), *also)
    also = ["bad_payload"] if keep_rejects else []
    update, vehicle = F.col("e.trip_update"), F.col("e.vehicle")
    updated = F.lit(False) if vehicles_only else update.isNotNull()

    def trip(name: str) -> Column:
        return F.when(updated, update["trip"][name]).otherwise(vehicle["trip"][name])

    def of_vehicle(value: Column) -> Column:
        return F.when(~updated, value)

    # All fields but the stop before the stops become rows, so that no row carries its entity.
    flat = [F.col("e.id").alias("entity_id"),
            *[trip(n).alias(n) for n in ("trip_id", "start_time", "start_date", "route_id")],
            of_vehicle(vehicle["timestamp"].cast("string")).alias("ts"),
            of_vehicle(vehicle["current_status"].cast("string")).alias("current_status"),
            of_vehicle(vehicle["current_stop_sequence"].try_cast("bigint")).alias("current_stop_sequence")]
    stop = vehicle["stop_id"].alias("stop_id")
    if not vehicles_only:
        stops = (F.when(updated, update["stop_time_update"]["stop_id"])
                 .when(vehicle.isNotNull(), F.array(vehicle["stop_id"])))
        if keep_rejects:
            stops = F.when(F.col("bad_payload").isNotNull(), F.array(vehicle["stop_id"])).otherwise(stops)
        stop = stops.alias("stops")
    rows = entities.select("unique_event_id", "feed_header_timestamp", *flat, stop, *also)
    if not vehicles_only:
        rows = rows.select("*", F.explode("stops").alias("stop_id")).drop("stops")
    given = {"vehicle_timestamp": temporal.epoch_text(F.col("ts")),
             **{c: F.lit(None) for c in ("stop_name", "stop_lat", "stop_lon", "direction")}}
    return rows.select(*[given.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
                         for f in schemas.POSITIONS.fields], *also)


def vehicle_positions(reports: DataFrame) -> DataFrame:
    """Reports with a status; trip updates have none."""
    return reports.where(F.col("current_status") != "")


def direction_of(stop_id: Column, *, by_suffix: bool = False) -> Column:
    """Travel direction from a raw stop id.

    Any capital S in the id means southbound, also inside the station part. With
    ``by_suffix`` only a final S counts.
    """
    key = text.strip(stop_id)
    south = key.endswith("S") if by_suffix else key.contains("S")
    return (F.when(stop_id.isNull() | (stop_id == ""), None)
             .when(south, "Southbound").otherwise("Northbound"))


def enrich_with_stops(
    reports: DataFrame, lookup: DataFrame, *, by_suffix: bool = False, also: Sequence[str] = ()
) -> DataFrame:
    """Add name, coordinates and direction; at most one stop per report, none is dropped.

    Columns in ``also`` are kept beside the 15 fields.

    ``lookup`` has ``stop_id``, ``stop_name``, ``stop_lat``, ``stop_lon`` as text with unique
    ids (``sources.stops.stop_lookup``). Keys are tried in order: the trimmed id, its upper
    case, then, if it ends with a letter, the id without that letter and its upper case.

    The id and its upper case share the upper-case form, so the lookup is grouped by that
    form (a handful of spellings each) and joined twice instead of four times. No broadcast
    is forced: Spark broadcasts a lookup below ``spark.sql.autoBroadcastJoinThreshold``
    and otherwise uses a shuffled join, with hot stops split at run time. Reports without a
    key get a made-up one each, so that a shuffled join does not gather them in one task.
    """
    spellings = F.map_from_entries(F.collect_list(
        F.struct("stop_id", F.struct("stop_name", "stop_lat", "stop_lon"))))
    by_upper = lookup.groupBy(F.upper("stop_id").alias("key")).agg(spellings.alias("found"))
    # Spark splits a hot key only where both sides come straight from a shuffle. The length as
    # a second key says nothing new, but has the grouped (small) lookup shuffled once more.
    def side(key: str, found: str) -> DataFrame:
        return by_upper.select(F.col("key").alias(key), F.length("key").alias(f"{key}_length"),
                               F.col("found").alias(found))

    raw = F.col("stop_id")
    key = text.strip(raw)
    known = raw.isNotNull() & (raw != "")
    stem = text.without_last(F.col("_key"))
    # The number of the input partition is the same in every attempt and tells copies apart.
    nobody = F.concat_ws("-", F.lit("\0"), F.spark_partition_id().cast("string"),
                         F.xxhash64("entity_id", "trip_id", "vehicle_timestamp").cast("string"))
    keyed = (reports.drop("stop_name", "stop_lat", "stop_lon", "direction")
                    .withColumn("_key", F.when(known, key))
                    .withColumn("_stem", F.when(text.ends_with_letter(F.col("_key")), stem))
                    .withColumn("_upper", F.coalesce(F.upper("_key"), nobody))
                    .withColumn("_short_upper", F.coalesce(F.upper("_stem"), nobody))
                    .withColumn("_upper_length", F.length("_upper"))
                    .withColumn("_short_upper_length", F.length("_short_upper")))
    # The stop is taken by the true keys: a made-up one finds nothing, whatever it meets.
    found = (keyed.join(side("_upper", "_exact"), ["_upper", "_upper_length"], "left")
                  .join(side("_short_upper", "_short"), ["_short_upper", "_short_upper_length"],
                        "left")
                  .withColumn("_stop", F.coalesce(
                      F.try_element_at("_exact", F.col("_key")),
                      F.try_element_at("_exact", F.upper("_key")),
                      F.try_element_at("_short", F.col("_stem")),
                      F.try_element_at("_short", F.upper("_stem")))))
    enriched = (found.withColumn("stop_name", F.col("_stop.stop_name"))
                     .withColumn("stop_lat", text.float_text(F.col("_stop.stop_lat")))
                     .withColumn("stop_lon", text.float_text(F.col("_stop.stop_lon")))
                     .withColumn("direction", direction_of(raw, by_suffix=by_suffix)))
    return enriched.select(*[f.name for f in schemas.POSITIONS.fields], *also)


def _vehicle_messages(messages: DataFrame, payload: str, form: str) -> DataFrame:
    """Messages parsed for their vehicles, from JSON text or from protocol buffers."""
    if form == "protobuf":
        return decode_messages(messages, payload, vehicles_only=True)
    if form != "json":
        raise ValueError("form must be 'json' or 'protobuf'")
    return parse_messages(messages, payload)


def live_positions(
    messages: DataFrame, lookup: DataFrame, payload: str = "value", *, form: str = "json"
) -> DataFrame:
    """The whole live chain: parse, flatten, keep reports with a status, enrich.

    Payloads are JSON text or, with ``form="protobuf"``, what the feed itself sends.
    """
    parsed = good_messages(_vehicle_messages(messages, payload, form))
    reports = flatten_messages(parsed, vehicles_only=True)
    return enrich_with_stops(vehicle_positions(reports), lookup)


def live_rows(
    messages: DataFrame, lookup: DataFrame, payload: str = "value",
    *, time_zone: str = constants.LOCAL_ZONE, form: str = "json"
) -> DataFrame:
    """The live chain with its rejects: ``kind`` is ``position`` or ``reject``.

    Each payload is parsed once. A reject has its text in ``bad_payload`` and no other field;
    for ``form="protobuf"`` that is the payload in base64.
    ``service_date`` is the local date of the report, else of its message, as text; rows with
    neither time have "none".
    """
    rows = flatten_messages(_vehicle_messages(messages, payload, form), vehicles_only=True,
                            keep_rejects=True)
    rejected = F.col("bad_payload").isNotNull()
    enriched = enrich_with_stops(rows.where(rejected | (F.col("current_status") != "")), lookup,
                                 also=["bad_payload"])
    local = F.from_utc_timestamp(F.coalesce("vehicle_timestamp", "feed_header_timestamp"), time_zone)
    return (enriched.withColumn("kind", F.when(rejected, "reject").otherwise("position"))
            .withColumn("service_date", F.coalesce(F.date_format(local, "yyyy-MM-dd"), F.lit("none"))))
