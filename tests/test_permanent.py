"""Buffer to permanent storage: each row once, before, between and after flushes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from railstream.plans import jobs
from railstream.streaming import permanent
from tests.conftest import plan_of

SCHEMA = "n int, day string"


def add(spark, path, numbers, day="a"):
    """One file of the buffer."""
    frame = spark.createDataFrame([(n, day) for n in numbers], SCHEMA).coalesce(1)
    frame.write.mode("append").partitionBy("day").parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def seen(buffer, store):
    return sorted((r.n, r.day) for r in permanent.read(buffer, store).collect())


def test_rows_come_once(spark, tmp_path):
    path, store = str(tmp_path / "buffer"), str(tmp_path / "store")
    buffer = add(spark, path, [1, 2])
    assert seen(buffer, store) == [(1, "a"), (2, "a")]
    moved = permanent.flush(buffer, store, "1", partition_by=["day"], sort_by=["n"])
    assert [(r.cut, r.n) for r in moved.collect()] == [("1", 2)]
    assert seen(buffer, store) == [(1, "a"), (2, "a")]
    buffer = add(spark, path, [2, 3])
    buffer = add(spark, path, [4], day="b")
    assert seen(buffer, store) == [(1, "a"), (2, "a"), (2, "a"), (3, "a"), (4, "b")]
    assert permanent.flush(buffer, store, "2", partition_by=["day"]).agg(F.sum("n")).first()[0] == 3
    assert permanent.flush(buffer, store, "3", partition_by=["day"]).count() == 0
    assert seen(buffer, store) == [(1, "a"), (2, "a"), (2, "a"), (3, "a"), (4, "b")]
    # All of it is in the store.
    rest = permanent._waiting(buffer, permanent.flushed_files(spark, store), "1 hour")
    assert rest.count() == 0
    with pytest.raises(ValueError):
        permanent.flush(buffer, store, "2")


def test_a_flush_that_failed_is_not_read(spark, tmp_path):
    path, store = str(tmp_path / "buffer"), str(tmp_path / "store")
    buffer = add(spark, path, [1, 2])
    # Rows were written, the list of files was not.
    rows = permanent._waiting(buffer, permanent.flushed_files(spark, store), "1 hour")
    rows.write.partitionBy("day").parquet(f"{store}/rows/_cut=broken")
    assert seen(buffer, store) == [(1, "a"), (2, "a")]
    permanent.flush(buffer, store, "again", partition_by=["day"])
    assert seen(buffer, store) == [(1, "a"), (2, "a")]


def test_files_of_long_ago_are_not_opened(spark, tmp_path):
    path, store = str(tmp_path / "buffer"), str(tmp_path / "store")
    permanent.flush(add(spark, path, [1]), store, "1", partition_by=["day"])
    late = permanent.flushed_files(spark, store).withColumn(
        "file_time", F.col("file_time") + F.expr("interval 2 hours"))
    rows = permanent._waiting(add(spark, path, [2], day="b"), late, "1 hour")
    assert "file_modification_time" in plan_of(rows, "extended")
    assert rows.count() == 0
    assert permanent._waiting(rows.sparkSession.read.schema(SCHEMA).parquet(path), late,
                              "3 hours").count() == 1


def test_live_feed_with_flushes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "stops.csv").write_text("stop_id,stop_name,stop_lat,stop_lon\nA01,One,1,2\n")
    out, store = str(tmp_path / "out"), str(tmp_path / "store")

    def poll(number, second):
        (tmp_path / "in" / f"{number}.txt").write_text(
            f'{{"header": {{"timestamp": "{second}"}}, "entity": [{{"id": "{number}", "vehicle": '
            f'{{"stop_id": "A01S", "current_status": "STOPPED_AT", "timestamp": "{second}"}}}}]}}\n{{bad\n')
        jobs.run_live_feed(spark, str(tmp_path / "in"), str(tmp_path / "stops.csv"), out,
                           str(tmp_path / "cp"), trigger={"availableNow": True}).awaitTermination()

    day = int(dt.datetime(2023, 11, 14, 12, tzinfo=dt.timezone.utc).timestamp())
    poll(1, day)
    moved = jobs.flush_live_feed(spark, out, store, "1")
    assert moved.count() == 2
    poll(2, day + 86400)
    positions = jobs.live_table(spark, out, store=store)
    assert sorted((r["entity_id"], r["service_date"]) for r in positions.collect()) == [
        ("1", "2023-11-14"), ("2", "2023-11-15")]
    assert positions.columns == jobs.live_table(spark, out).columns
    assert jobs.live_table(spark, out, "reject", store=store).count() == 2
    assert jobs.flush_live_feed(spark, out, store, "2").agg(F.sum("n")).first()[0] == 2
    assert jobs.live_table(spark, out, store=store).count() == 2
