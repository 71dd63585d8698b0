"""Feed messages as the feed sends them, GTFS-realtime protocol buffers, -> typed messages.

``decode_messages`` stands where ``feed.parse_messages`` does for JSON and makes the same columns, so
that everything behind it is shared. ``published_json`` makes the JSON text of a message with its
envelope. Both work on batch and streaming DataFrames.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from railstream import schemas

# Python workers get the functions below by value: they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Field numbers of the public GTFS-realtime message definition, for the fields of
# ``schemas.FEED_MESSAGE``. A field is text, a whole number, a status, or a message of its own.
_FIELDS = {
    "feed": {1: ("header", "header"), 2: ("entity", "entities")},
    "header": {3: ("timestamp", "number")},
    "entity": {1: ("id", "text"), 3: ("trip_update", "update"), 4: ("vehicle", "vehicle")},
    "update": {1: ("trip", "trip"), 2: ("stop_time_update", "stops")},
    "trip": {1: ("trip_id", "text"), 2: ("start_time", "text"), 3: ("start_date", "text"),
             5: ("route_id", "text")},
    "stop": {4: ("stop_id", "text")},
    "vehicle": {1: ("trip", "trip"), 3: ("current_stop_sequence", "number"),
                4: ("current_status", "status"), 5: ("timestamp", "number"), 7: ("stop_id", "text")},
}
_STATUS = ("INCOMING_AT", "STOPPED_AT", "IN_TRANSIT_TO")
_REPEATED = {"entities": "entity", "stops": "stop"}

_MESSAGE = T.StructType([schemas.FEED_MESSAGE["header"], schemas.FEED_MESSAGE["entity"]])
_BAD = "_bad_payload"


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value & 0xFFFFFFFFFFFFFFFF, at
        shift += 7
        if shift > 63:
            raise ValueError("a number of more than ten bytes")


def _message(data: bytes, at: int, end: int, kind: str, skipped: frozenset, into: dict) -> dict:
    """The fields of one message; unknown ones are passed over, the last of several counts, and
    parts of a message that comes in several are merged."""
    fields = _FIELDS[kind]
    while at < end:
        # Most numbers fit one byte.
        key, at = (data[at], at + 1) if data[at] < 0x80 else _varint(data, at)
        field = fields.get(key >> 3)
        wire = key & 7
        if wire == 2:
            size, at = (data[at], at + 1) if data[at] < 0x80 else _varint(data, at)
            upto = at + size
            if upto > end:
                raise ValueError("a field beyond the end of its message")
            if field is not None:
                name, what = field
                if what == "text":
                    into[name] = data[at:upto].decode("utf-8", "replace")
                elif what in _REPEATED:
                    into.setdefault(name, []).append(
                        _message(data, at, upto, _REPEATED[what], skipped, {}))
                elif what in _FIELDS:
                    part = into.setdefault(name, {})
                    if what not in skipped:
                        _message(data, at, upto, what, skipped, part)
            at = upto
        elif wire == 0:
            value, at = (data[at], at + 1) if data[at] < 0x80 else _varint(data, at)
            if field is not None:
                name, what = field
                if what == "number":
                    into[name] = str(value)
                elif what == "status" and value < len(_STATUS):
                    into[name] = _STATUS[value]
        elif wire in (1, 5):
            at += 8 if wire == 1 else 4
        else:
            raise ValueError(f"wire type {wire}")
    if at > end:
        raise ValueError("a field beyond the end of its message")
    return into


def _decoded(skipped: frozenset):
    """``_message`` of each payload, NULL where it is none."""
    kind = to_arrow_type(_MESSAGE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for payload in batch.column("_payload"):
                data = payload.as_py()
                try:
                    message = _message(data or b"", 0, len(data or b""), "feed", skipped, {})
                except (ValueError, IndexError):
                    message = {}
                # A header is required.
                found.append(message if "header" in message else None)
            columns = [*batch.columns, pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "_message"])
    return run


def decode_messages(
    df: DataFrame, payload: str = "value", *, on_bad: str = "reject", vehicles_only: bool = False
) -> DataFrame:
    """Binary payloads -> typed message columns beside the input's own, and a processing time.

    Event time is the header's, or the current time when it has none; the event id is that time
    and a SHA-256 of the payload. A payload that is no feed message is kept with all message fields
    NULL and its bytes in base64 (``on_bad="reject"``; see ``feed.good_messages`` and
    ``feed.rejected_messages``) or stops the query (``on_bad="fail"``).

    ``vehicles_only`` notes that an entity has a trip update but does not open it.
    """
    if on_bad not in ("reject", "fail"):
        raise ValueError("on_bad must be 'reject' or 'fail'")
    skipped = frozenset({"update"} if vehicles_only else ())
    made = {f.name for f in schemas.FEED_MESSAGE} | {_BAD, "processing_time"}
    kept = [c for c in df.columns if c not in made]
    rows = df.select(*kept, F.col(payload).cast("binary").alias("_payload"))
    schema = T.StructType([*rows.schema.fields, T.StructField("_message", _MESSAGE)])
    rows = rows.mapInArrow(_decoded(skipped), schema)
    message = F.col("_message")
    if on_bad == "fail":
        message = F.when(message.isNull(), F.raise_error("Malformed message")).otherwise(message)
    header = message["header"]
    seconds = F.coalesce(header["timestamp"].try_cast("bigint"), F.unix_seconds(F.current_timestamp()))
    text = F.coalesce(F.base64("_payload"), F.lit(""))
    good = message.isNotNull()
    return rows.select(
        *kept,
        F.when(good, F.concat_ws("-", seconds.cast("string"), F.sha2(F.col("_payload"), 256)))
         .alias("unique_event_id"),
        F.when(good, seconds).alias("event_timestamp_unix"), header.alias("header"),
        message["entity"].alias("entity"),
        *([F.when(message.isNull(), text).alias(_BAD)] if on_bad == "reject" else []),
        F.current_timestamp().alias("processing_time"))


def published_json(decoded: DataFrame) -> DataFrame:
    """Decoded messages -> the JSON text to publish, one column ``value``.

    Fields that are not set are left out; 64-bit numbers are text, the stop sequence is a number.
    Rejects are left out.
    """
    def numbered(entity: Column) -> Column:
        sequence = entity["vehicle"]["current_stop_sequence"].try_cast("bigint")
        return entity.withField("vehicle.current_stop_sequence", sequence)

    message = F.struct("header", F.transform("entity", numbered).alias("entity"), "unique_event_id",
                       "event_timestamp_unix")
    good = decoded.where(F.col("unique_event_id").isNotNull())
    return good.select(F.to_json(message).alias("value"))
