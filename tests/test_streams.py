import json
import os

import pytest
from pyspark.sql import functions as F

from railstream.operators import feed
from railstream.plans import adapters
from railstream.sources import stops as stop_files
from railstream.sources.feed_stream import read_feed_stream
from railstream.streaming import streams

ALL = {"availableNow": True}
SCHEMA = "publish_time timestamp, k string"


def land(folder, *files):
    """One file per list of seconds, with file times an hour apart so that order is fixed."""
    folder.mkdir(exist_ok=True)
    for number, seconds in enumerate(files):
        path = folder / f"{number}.json"
        path.write_text("".join(json.dumps(
            {"publish_time": f"2024-01-01T00:{s // 60:02}:{s % 60:02}Z", "k": str(s)}) + "\n"
            for s in seconds))
        os.utime(path, (1_700_000_000 + 3600 * number,) * 2)


def source(spark, folder):
    return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder)))


def first_window(df):
    row = df.where(F.col("window_start") == "2024-01-01 00:00:00").select("n").first()
    return row and row[0]


@pytest.mark.parametrize(("files", "count", "dropped"), [
    (([1, 20], [120], [5, 121], [300]), 3, 0),
    (([1, 20], [120], [121], [5, 122], [300]), 2, 1),
])
def test_late_rows(spark, tmp_path, files, count, dropped):
    land(tmp_path / "in", *files)
    counts = streams.windowed_counts(source(spark, tmp_path / "in"))
    with streams.ProgressLog(spark, str(tmp_path / "log"), "late"):
        streams.finish(streams.append_stream(
            counts, str(tmp_path / "out"), str(tmp_path / "cp"), trigger=ALL, name="late"))
    assert first_window(spark.read.parquet(str(tmp_path / "out"))) == count
    progress = streams.progress_table(spark, str(tmp_path / "log"))
    total = progress.agg(F.sum("dropped_late_rows"), F.sum("input_rows")).first()
    assert tuple(total) == (dropped, sum(map(len, files)))
    assert progress.where("lag_seconds is not null").count() > 0
    assert progress.count() >= len(files)


def test_delta_counts_hold_each_row_once(spark, tmp_path):
    land(tmp_path / "in", [1, 20], [5, 40], [7])
    streams.finish(streams.write_delta_counts(
        source(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), trigger=ALL))
    deltas = spark.read.parquet(str(tmp_path / "out"))
    per_firing = deltas.where(F.col("window_start") == "2024-01-01 00:00:00").orderBy("batch")
    assert [r["n"] for r in per_firing.collect()] == [2, 1, 1]


def test_window_assignment_changes_no_row(spark, tmp_path):
    land(tmp_path / "in", [1, 31, 59])
    out = streams.assign_window(source(spark, tmp_path / "in"))
    streams.finish(streams.append_stream(out, str(tmp_path / "o"), str(tmp_path / "cp"), trigger=ALL))
    starts = spark.read.parquet(str(tmp_path / "o")).orderBy("publish_time").select(
        F.unix_seconds("window_start") % 3600).collect()
    assert [r[0] for r in starts] == [0, 30, 30]


def reports(spark, folder):
    """The seconds of a file are the reports' own times; a file comes in an hour after the last."""
    return source(spark, folder).select(
        F.col("k").alias("entity_id"), F.col("publish_time").alias("vehicle_timestamp"),
        F.lit("s").alias("stop_id"), F.lit("x").alias("current_status"),
        F.col("_metadata.file_modification_time").alias("publish_time"))


def test_dedupe_keeps_reports_that_are_minutes_old(spark, tmp_path):
    land(tmp_path / "in", [100, 160], [400], [401], [200, 400], [500], [9999])
    rows = streams.dedupe_positions(reports(spark, tmp_path / "in"), horizon="1 day")
    streams.finish(streams.append_stream(rows, str(tmp_path / "o"), str(tmp_path / "cp"), trigger=ALL))
    out = spark.read.parquet(str(tmp_path / "o")).collect()
    assert sorted(int(r["entity_id"]) for r in out) == [100, 160, 200, 400, 401, 500, 9999]
    # The first seen is the one that stays.
    first = {r["entity_id"]: r["publish_time"] for r in out}
    assert first["400"] < first["401"] < first["200"] < first["500"]


def test_dedupe_forgets_after_the_horizon(spark, tmp_path):
    land(tmp_path / "in", [1, 1, 1], [2], [3], [4], [1])
    rows = streams.dedupe_positions(reports(spark, tmp_path / "in"), horizon="30 minutes")
    streams.finish(streams.append_stream(rows, str(tmp_path / "o"), str(tmp_path / "cp"), trigger=ALL))
    out = spark.read.parquet(str(tmp_path / "o"))
    assert sorted(r["entity_id"] for r in out.collect()) == ["1", "1", "2", "3", "4"]


def test_default_trigger(spark, tmp_path):
    (tmp_path / "in").mkdir()
    query = streams.append_stream(source(spark, tmp_path / "in"), str(tmp_path / "o"),
                                  str(tmp_path / "cp"))
    try:
        land(tmp_path / "in", [1, 2])
        query.processAllAvailable()
        assert query.isActive and spark.read.parquet(str(tmp_path / "o")).count() == 2
    finally:
        query.stop()


def test_stream_gives_what_the_batch_gives(spark, tiny, tmp_path):
    messages = adapters.messages(spark.read.parquet(f"{tiny}/events.parquet")).select("value")
    lookup = stop_files.stop_lookup(adapters.stops(spark.read.parquet(f"{tiny}/supplier.parquet")))
    messages.repartition(3).write.text(str(tmp_path / "in"))
    live = feed.live_positions(
        read_feed_stream(spark, str(tmp_path / "in"), files_per_trigger=1), lookup)
    for _ in range(2):  # a restart finds nothing new
        streams.finish(streams.append_stream(live, str(tmp_path / "out"), str(tmp_path / "cp"),
                                             partition_by=["direction"], trigger=ALL))
    batch = feed.live_positions(messages, lookup)
    stream = spark.read.parquet(str(tmp_path / "out")).select(*batch.columns)
    assert stream.count() == batch.count() == 1000
    assert stream.exceptAll(batch).count() == 0


def test_publish_rows_as_json(spark, tmp_path):
    land(tmp_path / "in", [1, 2])
    rows = source(spark, tmp_path / "in").select("k")
    streams.finish(streams.publish_messages(rows, str(tmp_path / "out"), str(tmp_path / "cp"),
                                            trigger=ALL))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "out")).collect()) == [
        '{"k":"1"}', '{"k":"2"}']


def test_publish_time_of_a_landing_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = tmp_path / "in" / "m.txt"
    path.write_text("{}\n")
    os.utime(path, (1_700_000_000,) * 2)
    rows = read_feed_stream(spark, str(tmp_path / "in"))
    streams.finish(streams.append_stream(rows, str(tmp_path / "o"), str(tmp_path / "cp"), trigger=ALL))
    row = spark.read.parquet(str(tmp_path / "o")).select(
        "value", F.unix_seconds("publish_time").alias("at")).first()
    assert tuple(row) == ("{}", 1_700_000_000)
