"""Protocol buffers of the feed: decoding, rejects, publishing, and the live job on them."""

import base64
import hashlib
import json

import pytest

from railstream import schemas
from railstream.operators import binary_feed, feed
from railstream.plans import jobs


def varint(n):
    out = b""
    while n >= 128:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def field(number, value):
    """A number, or text, bytes or a message as one piece."""
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    value = value.encode() if isinstance(value, str) else value
    return varint(number << 3 | 2) + varint(len(value)) + value


def header(timestamp=1700000000):
    return field(1, field(1, "2.0") + (b"" if timestamp is None else field(3, timestamp)))


def vehicle(**given):
    numbers = {"trip": 1, "sequence": 3, "status": 4, "timestamp": 5, "stop_id": 7}
    return b"".join(field(numbers[k], v) for k, v in given.items())


TRIP = field(1, "T1") + field(2, "10:00:00") + field(3, "20231114") + field(5, "E")


def decoded(spark, payloads, **options):
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "n int, value binary")
    return binary_feed.decode_messages(frame, **options)


def rows_of(spark, payload):
    return [r.asDict() for r in
            feed.flatten_messages(feed.good_messages(decoded(spark, [payload]))).collect()]


def test_a_vehicle(spark):
    payload = header() + field(2, field(1, "e1") + field(4, vehicle(
        trip=TRIP, sequence=300, status=1, timestamp=1700000001, stop_id="A01S")))
    row, = rows_of(spark, payload)
    assert {k: row[k] for k in ("entity_id", "trip_id", "start_time", "start_date", "route_id",
                                "stop_id", "current_status", "current_stop_sequence")} == {
        "entity_id": "e1", "trip_id": "T1", "start_time": "10:00:00", "start_date": "20231114",
        "route_id": "E", "stop_id": "A01S", "current_status": "STOPPED_AT",
        "current_stop_sequence": 300}
    assert row["vehicle_timestamp"].isoformat() == "2023-11-14T22:13:21"
    assert row["feed_header_timestamp"].isoformat() == "2023-11-14T22:13:20"
    assert row["unique_event_id"] == f"1700000000-{hashlib.sha256(payload).hexdigest()}"


def test_unset_and_unknown_fields(spark):
    odd = field(99, "extension") + varint(98 << 3 | 1) + b"12345678" + varint(97 << 3 | 5) + b"1234"
    body = vehicle(stop_id="é字") + odd + field(2, b"\x0d1234")
    row, = rows_of(spark, header() + odd + field(2, field(1, "e") + odd + field(4, body)))
    assert (row["stop_id"], row["current_status"], row["vehicle_timestamp"], row["trip_id"]) == (
        "é字", None, None, None)
    # A number that no status has is as if unset; the last of several values counts.
    row, = rows_of(spark, header() + field(2, field(1, "e") + field(4, vehicle(status=7))))
    assert row["current_status"] is None
    twice = field(4, vehicle(trip=field(1, "a"), status=0)) + field(4, vehicle(
        trip=field(5, "E"), status=2))
    row, = rows_of(spark, header() + field(2, field(1, "x") + field(1, "y") + twice))
    assert (row["entity_id"], row["trip_id"], row["route_id"], row["current_status"]) == (
        "y", "a", "E", "IN_TRANSIT_TO")


def test_trip_updates(spark):
    stops = b"".join(field(2, field(4, s)) for s in ("A01N", "A02N")) + field(2, b"")
    update = field(3, field(1, TRIP) + stops)
    rows = rows_of(spark, header() + field(2, field(1, "u") + update + field(4, vehicle(status=1)))
                   + field(2, field(1, "empty") + field(3, field(1, TRIP))) + field(2, field(1, "none")))
    assert [(r["entity_id"], r["stop_id"], r["current_status"]) for r in rows] == [
        ("u", "A01N", None), ("u", "A02N", None), ("u", None, None)]
    # Not opened, the update still comes before the vehicle of its entity.
    message = header() + field(2, field(1, "u") + update + field(4, vehicle(status=1)))
    parsed = feed.good_messages(decoded(spark, [message], vehicles_only=True))
    assert feed.flatten_messages(parsed, vehicles_only=True).count() == 0


BAD = [None, b"", b"{}", header()[:-1], field(2, field(1, "e")), header() + b"\x12\x7f", b"\xff" * 11,
       header() + varint(5 << 3 | 3), header() + varint(9 << 3 | 1) + b"123", header() + b"\x80"]


def test_malformed_payloads(spark):
    good = [header(), header() + field(2, b""), header(None)]
    parsed = decoded(spark, BAD + good)
    assert sorted(r.n for r in feed.good_messages(parsed).select("n").collect()) == [
        len(BAD), len(BAD) + 1, len(BAD) + 2]
    texts = [r.bad_payload for r in feed.rejected_messages(parsed).collect()]
    assert sorted(base64.b64decode(t) for t in texts) == sorted(p or b"" for p in BAD)
    with pytest.raises(Exception, match="Malformed"):
        decoded(spark, [BAD[3]], on_bad="fail").collect()
    assert decoded(spark, [good[0]], on_bad="fail").count() == 1
    with pytest.raises(ValueError):
        decoded(spark, [], on_bad="skip")


def test_a_message_without_a_time_gets_the_current_one(spark):
    row = decoded(spark, [header(None)]).first()
    assert row.event_timestamp_unix > 1_700_000_000
    assert row.unique_event_id.startswith(f"{row.event_timestamp_unix}-")


def test_own_columns_of_the_input(spark):
    frame = spark.createDataFrame([(header(), "x", "y")], "value binary, entity string, kept string")
    row = binary_feed.decode_messages(frame).first()
    assert row.kept == "y" and row.entity is None and row.header.timestamp == "1700000000"
    assert decoded(spark, []).count() == 0


def test_published_text(spark):
    payload = header() + field(2, field(1, "e") + field(4, vehicle(sequence=3, timestamp=1700000001)))
    text, = (r.value for r in binary_feed.published_json(decoded(spark, [payload, b"x"])).collect())
    assert json.loads(text) == {
        "header": {"timestamp": "1700000000"}, "event_timestamp_unix": 1700000000,
        "entity": [{"id": "e", "vehicle": {"current_stop_sequence": 3, "timestamp": "1700000001"}}],
        "unique_event_id": f"1700000000-{hashlib.sha256(payload).hexdigest()}"}


def test_live_feed_of_fetched_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    report = field(1, "e1") + field(4, vehicle(status=1, timestamp=1700000001, stop_id="A01S"))
    (tmp_path / "in" / "1.pb").write_bytes(header() + field(2, report))
    (tmp_path / "in" / "2.pb").write_bytes(b"<html>busy</html>")
    (tmp_path / "stops.csv").write_text("stop_id,stop_name,stop_lat,stop_lon\nA01,One,1,2\n")
    jobs.run_live_feed(spark, str(tmp_path / "in"), str(tmp_path / "stops.csv"),
                       str(tmp_path / "out"), str(tmp_path / "cp"), form="protobuf",
                       trigger={"availableNow": True}).awaitTermination()
    assert [(r["entity_id"], r["stop_name"], r["direction"], r["service_date"])
            for r in jobs.live_table(spark, str(tmp_path / "out")).collect()] == [
        ("e1", "One", "Southbound", "2023-11-14")]
    rejects = jobs.live_table(spark, str(tmp_path / "out"), "reject")
    assert [base64.b64decode(r["bad_payload"]) for r in rejects.collect()] == [b"<html>busy</html>"]
    jobs.run_publish(spark, str(tmp_path / "in"), str(tmp_path / "json"), str(tmp_path / "cp2"),
                     form="protobuf", trigger={"availableNow": True}).awaitTermination()
    row = json.loads(spark.read.text(str(tmp_path / "json")).first()[0])
    assert row["event_timestamp_unix"] == 1700000000 and row["entity"][0]["id"] == "e1"


def test_unknown_form(spark):
    frame = spark.createDataFrame([("x",)], "value string")
    lookup = spark.createDataFrame([], "stop_id string, stop_name string, stop_lat string, stop_lon string")
    with pytest.raises(ValueError):
        feed.live_positions(frame, lookup, form="avro")


def test_columns_match_those_of_json(spark):
    frame = spark.createDataFrame([("{}",)], "value string")
    assert binary_feed.decode_messages(frame).dtypes == feed.parse_messages(frame).dtypes
    assert set(schemas.FEED_MESSAGE.names) < set(binary_feed.decode_messages(frame).columns)
