import json
import re
import time

import pytest
from pyspark.sql import functions as F

from railstream import schemas
from railstream.functions import temporal, text
from railstream.operators import feed
from railstream.plans import adapters
from railstream.sources import stops as stop_files
from tests.conftest import plan_of

TRIP = {"trip_id": "t", "start_time": "10:00:00", "start_date": "20250602", "route_id": "E"}
VEHICLE = {"trip": TRIP, "stop_id": "A01S", "current_status": "STOPPED_AT",
           "current_stop_sequence": 7, "timestamp": "1700000001"}


def messages(spark, *entities, header="1700000000"):
    body = {"header": {"timestamp": header}, "entity": list(entities), "unique_event_id": "u"}
    return spark.createDataFrame([(json.dumps(body),)], "value string")


def flat(df):
    return feed.flatten_messages(feed.good_messages(feed.parse_messages(df)))


def test_vehicle_gives_one_row(spark):
    rows = flat(messages(spark, {"id": "1", "vehicle": VEHICLE}))
    assert rows.schema.fieldNames() == schemas.POSITIONS.fieldNames()
    assert [f.dataType for f in rows.schema] == [f.dataType for f in schemas.POSITIONS]
    row = rows.withColumn("h", F.col("feed_header_timestamp").cast("string")).first()
    assert row["h"] == "2023-11-14 22:13:20"
    assert (row["entity_id"], row["trip_id"], row["route_id"]) == ("1", "t", "E")
    assert (row["current_stop_sequence"], row["stop_name"]) == (7, None)


@pytest.mark.parametrize(("entity", "rows", "with_status"), [
    ({"id": "1", "vehicle": {**VEHICLE, "timestamp": "abc"}}, 1, 1),
    ({"id": "1", "vehicle": {"trip": TRIP}}, 1, 0),
    ({"id": "1", "vehicle": {**VEHICLE, "current_status": ""}}, 1, 0),
    ({"id": "1", "trip_update": {"trip": TRIP, "stop_time_update":
      [{"stop_id": "a"}, {"stop_id": "b"}, {"stop_id": "c"}]}}, 3, 0),
    ({"id": "1", "trip_update": {"trip": TRIP}}, 0, 0),
    ({"id": "1", "trip_update": {"trip": TRIP, "stop_time_update": [{"stop_id": "a"}]},
      "vehicle": VEHICLE}, 1, 0),
    ({"id": "1"}, 0, 0),
])
def test_flatten_cases(spark, entity, rows, with_status):
    df = messages(spark, entity)
    out = flat(df)
    assert out.count() == rows
    kept = feed.vehicle_positions(out)
    assert kept.count() == with_status
    short = feed.flatten_messages(feed.good_messages(feed.parse_messages(df)), vehicles_only=True)
    assert short.schema == out.schema
    assert feed.vehicle_positions(short).collect() == kept.collect()


def test_message_without_entities(spark):
    df = spark.createDataFrame([('{"header": {"timestamp": "1"}}',)], "value string")
    assert flat(df).count() == 0


def test_malformed_payload_is_rejected_or_fails(spark):
    bad = ["{bad", "", "  ", "null", "[1]", "7", '{"entity": 5}']
    df = spark.createDataFrame([(b,) for b in [*bad, '{"entity": []}']], "value string")
    parsed = feed.parse_messages(df)
    assert sorted(r[0] for r in feed.rejected_messages(parsed).collect()) == sorted(bad)
    assert feed.good_messages(parsed).count() == 1
    for payload in bad:
        one = spark.createDataFrame([(payload,)], "value string")
        with pytest.raises(Exception, match="MALFORMED|Malformed"):
            feed.parse_messages(one, on_bad="fail").collect()


def test_payload_is_parsed_once(spark):
    plan = plan_of(flat(messages(spark, {"id": "1", "vehicle": VEHICLE})), "simple")
    assert plan.count("from_json(") == 1


def test_envelope_keeps_the_message(spark):
    df = spark.createDataFrame([
        ('{"header": {"timestamp": "12"}, "other": [1]}',), ("{}",), ("{bad",)], "value string")
    out = [r[0] for r in feed.enveloped_json(df).collect()]
    first, second = json.loads(out[0]), json.loads(out[1])
    assert first["other"] == [1] and first["event_timestamp_unix"] == 12
    assert first["unique_event_id"].startswith("12-")
    assert set(second) == {"unique_event_id", "event_timestamp_unix"}
    assert out[2] == "{bad"
    # the id depends on the payload only
    again = feed.enveloped_json(df.limit(1)).first()[0]
    assert json.loads(again)["unique_event_id"] == first["unique_event_id"]


LOOKUP = [("A01", "One", "40.1", "-74"), ("A02", "Two", "", "-73"), ("A03S", "Three", "1", "2")]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_enrichment_keys_and_direction(spark, threshold):
    lookup = stop_files.stop_lookup(spark.createDataFrame(
        LOOKUP, "stop_id string, stop_name string, stop_lat string, stop_lon string"))
    expected = {
        "A01": ("One", "Northbound"), "A01N": ("One", "Northbound"),
        "a01s": ("One", "Northbound"), " A01S ": ("One", "Southbound"),
        "A03S": ("Three", "Southbound"), "S01N": (None, "Southbound"),
        "A02N": ("Two", "Northbound"), "X9": (None, "Northbound"),
        None: (None, None), "": (None, None), "  ": (None, "Northbound"),
    }
    ids = spark.createDataFrame([(i,) for i in expected], "stop_id string")
    rows = ids.select(*[F.col("stop_id") if f.name == "stop_id"
                        else F.lit(None).cast(f.dataType).alias(f.name)
                        for f in schemas.POSITIONS.fields])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        out = feed.enrich_with_stops(rows, lookup).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r["stop_id"]: (r["stop_name"], r["direction"]) for r in out} == expected
    by_id = {r["stop_id"]: r for r in out}
    assert (by_id["A01N"]["stop_lat"], by_id["A02N"]["stop_lat"]) == (40.1, None)


def test_shuffled_lookup_can_split_hot_stops(spark):
    lookup = stop_files.stop_lookup(spark.createDataFrame(
        LOOKUP, "stop_id string, stop_name string, stop_lat string, stop_lon string"))
    rows = flat(messages(spark, {"id": "1", "vehicle": VEHICLE}))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(feed.enrich_with_stops(rows, lookup), "simple").splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # each side of each join comes straight from a shuffle on the join keys
    for key in ("_upper", "_short_upper"):
        shuffles = [x for x in plan if "Exchange hashpartitioning(" + key + "#" in x
                    and key + "_length#" in x]
        assert len(shuffles) == 2


def test_direction_by_suffix(spark):
    ids = spark.createDataFrame([("S01N",), ("A01S",)], "i string")
    out = ids.select(feed.direction_of(F.col("i"), by_suffix=True)).collect()
    assert [r[0] for r in out] == ["Northbound", "Southbound"]


def test_epoch_text(spark):
    cases = {"0": 0, "": None, None: None, "abc": None, "-5": -5, "99999999999999": None,
             "253402300799": 253402300799}
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    out = df.select("t", F.unix_seconds(temporal.epoch_text(F.col("t"))).alias("s")).collect()
    assert {r["t"]: r["s"] for r in out} == cases


def test_float_text(spark):
    cases = {"1.5": 1.5, " -2e3 ": -2000.0, "": None, "x": None, "1d": None, "0x1p3": None,
             "1_0": 10.0, ".5": 0.5, "5.": 5.0, "Infinity": float("inf"), "__1": None}
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    out = df.select("t", text.float_text(F.col("t")).alias("x")).collect()
    assert {r["t"]: r["x"] for r in out} == cases
    nan = spark.sql("select 'NaN' as t").select(text.float_text(F.col("t"))).first()[0]
    assert nan != nan


def test_strip_takes_any_white_space(spark):
    df = spark.createDataFrame([(" \t a b\x1f \n",)], "t string")
    assert df.select(text.strip(F.col("t"))).first()[0] == "a b"


def test_lookup_file(spark, tmp_path):
    path = tmp_path / "stops.csv"
    path.write_text('stop_id,stop_name,stop_lat,stop_lon\n A01 ,"Main, ""North""",40.1,-74,x,y\n'
                    "short,row\n\nSTOP_ID,a,b,c\nA02,Old,1,2\nA02,New,3,\n,Nameless,5,6\n"
                    'A05,Five,40.1,,1,P\n"A,6","a ""b"", c",,,\n"no,t",four,"x,y"\n')
    out = {r[0]: tuple(r)[1:] for r in stop_files.read_stop_lookup(spark, str(path)).collect()}
    assert out == {"A01": ('Main, "North"', "40.1", "-74"), "A02": ("New", "3", ""),
                   "": ("Nameless", "5", "6"), "A05": ("Five", "40.1", ""),
                   "A,6": ('a "b", c', "", "")}


def test_stop_table_file(spark, tmp_path):
    path = tmp_path / "stops.csv"
    path.write_text("stop_id,stop_name,stop_lat,stop_lon,location_type,parent_station\n"
                    'A01,"Two\nlines",40.5,-74.25,1,\nA01N,x,,,,A01\n')
    out = [tuple(r) for r in stop_files.read_stops(spark, str(path)).orderBy("stop_id").collect()]
    assert out == [("A01", "Two\nlines", 40.5, -74.25, 1, None),
                   ("A01N", "x", None, None, None, "A01")]


def test_stop_table_needs_ids(spark, tmp_path):
    path = tmp_path / "stops.csv"
    path.write_text("stop_id,stop_name,stop_lat,stop_lon,location_type,parent_station\n,x,,,,\n")
    with pytest.raises(Exception, match="Row without stop_id"):
        stop_files.read_stops(spark, str(path)).collect()


def test_envelope_without_a_header_takes_the_current_time(spark):
    before = int(time.time())
    row = feed.add_envelope(spark.createDataFrame([('{"entity": []}',)], "value string")).first()
    assert before <= row["event_timestamp_unix"] <= int(time.time()) + 1
    assert row["unique_event_id"].startswith(f"{row['event_timestamp_unix']}-")


def test_stops_become_rows_without_their_entity(spark):
    """A row per stop that carried its trip update would grow with the square of the stops."""
    update = {"trip": {"trip_id": "T"}, "stop_time_update": [{"stop_id": str(i)} for i in range(3)] + [{}]}
    both = {"id": "b", "trip_update": update, "vehicle": {"stop_id": "V", "timestamp": "1700000000",
                                                          "current_status": "STOPPED_AT"}}
    text = json.dumps({"header": {"timestamp": "1700000000"}, "entity": [both]})
    parsed = feed.parse_messages(spark.createDataFrame([(text,), ("{",)], "value string"))
    reports = feed.flatten_messages(parsed, keep_rejects=True)
    found = reports.select("entity_id", "trip_id", "stop_id", "current_status", "vehicle_timestamp", "bad_payload")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [*[("b", "T", s, None, None, None) for s in ("0", "1", "2", None)],
         (None, None, None, None, None, "{")], key=str)
    plan = plan_of(feed.flatten_messages(feed.good_messages(parsed)), "simple")
    assert "lambdafunction" not in plan
    carried = re.findall(r"explode\(stops#\d+\), \[(.*?)\]", plan)
    assert carried and not any(re.search(r"\be#", c) for c in carried)


def test_trip_messages_are_dealt_finely(spark, tiny):
    """Narrow rows would meet in a few parts of the advised size."""
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "32")
    try:
        messages = adapters.trip_messages(adapters.table(spark, tiny, "lineitem"))
        sizes = [r["count"] for r in messages.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set(setting, before)
    assert len(sizes) == 32 and max(sizes) <= min(sizes) + 32
