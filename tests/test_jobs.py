import datetime as dt
import json

import pytest

from railstream import schemas
from railstream.operators import samples as ops
from railstream.operators import stations
from railstream.plans import jobs
from tests.conftest import plan_of
from tests.test_archives import pack
from tests.test_samples import stop_times, trip_of


def test_live_feed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    message = {"header": {"timestamp": "1700000000"}, "entity": [
        {"id": "1", "vehicle": {"stop_id": "A01S", "current_status": "STOPPED_AT",
                                "timestamp": "1700000001"}},
        {"id": "2", "trip_update": {"stop_time_update": [{"stop_id": "A01N"}]}}]}
    (tmp_path / "in" / "1.txt").write_text(json.dumps(message) + "\n{bad\n")
    (tmp_path / "stops.csv").write_text("stop_id,stop_name,stop_lat,stop_lon\nA01,One,1,2\n")
    query = jobs.run_live_feed(spark, str(tmp_path / "in"), str(tmp_path / "stops.csv"),
                               str(tmp_path / "out"), str(tmp_path / "cp"),
                               trigger={"availableNow": True})
    query.awaitTermination()
    positions = jobs.live_table(spark, str(tmp_path / "out"))
    assert [(r["entity_id"], r["stop_name"], r["direction"], r["service_date"])
            for r in positions.collect()] == [("1", "One", "Southbound", "2023-11-14")]
    rejects = jobs.live_table(spark, str(tmp_path / "out"), "reject")
    assert [r["bad_payload"] for r in rejects.collect()] == ["{bad"]
    # Other days are skipped as files, also for the operators that take a date.
    daily = stations.first_arrivals(positions, service_date="2023-11-14")
    line = next(x for x in plan_of(daily).splitlines() if "PartitionFilters" in x)
    assert "service_date" in line and "kind" in line


def test_publish(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text('{"header": {"timestamp": "1700000000"}}\n')
    jobs.run_publish(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"),
                     files_per_trigger=1, trigger={"availableNow": True}).awaitTermination()
    row = json.loads(spark.read.text(str(tmp_path / "out")).first()[0])
    assert row["event_timestamp_unix"] == 1700000000 and row["unique_event_id"].startswith("1700000000-")


def day_archive(folder, day, *lines, trips=()):
    header = ",".join(schemas.SENSOR_DATA.fieldNames())
    head = ",".join(schemas.TRIPS.fieldNames())
    pack(folder / f"feed_{day}_csv.tar.xz", {
        f"feed_{day}_stop_times.csv": "\n".join([header, *lines]) + "\n",
        f"feed_{day}_trips.csv": "\n".join([head, *trips]) + "\n"})


def test_history(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    day_archive(raw, "2024-01-31", "t,A01,1,2024-01-31 10:00:00,,,", "t,A02,1,x,,,")
    day_archive(raw, "2024-03-01", "t,A01,1,2024-03-01 10:00:00,,,")

    def load():
        return jobs.load_history(spark, str(raw), str(tmp_path / "months"), str(tmp_path / "out"),
                                 first_month="2024-01", last_month="2024-02")

    done = load()
    # March is expanded but not loaded.
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    assert {(r["year_month"], r["status"], r["bad_rows"]) for r in done.months.collect()} == {
        ("2024-01", "success", 1), ("2024-02", "empty", 0)}
    assert [r["status"] for r in done.expansion.collect()] == ["DECOMPRESSED"] * 2
    assert done.report.count() == 2
    # Days that are there are not read again; this one could not be.
    (raw / "feed_2024-01-31_csv.tar.xz").write_bytes(b"broken")
    day_archive(raw, "2024-02-01", "t,A01,1,2024-02-01 10:00:00,,,")
    again = load()
    assert {r["service_date"]: r["status"] for r in again.expansion.collect()} == {
        "2024-01-31": "SKIPPED", "2024-03-01": "SKIPPED", "2024-02-01": "DECOMPRESSED"}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_history_without_archives(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    done = jobs.load_history(spark, str(tmp_path / "raw"), str(tmp_path / "months"),
                             str(tmp_path / "out"), first_month="2024-01", last_month="2024-01")
    assert done.expansion.count() == 0
    assert [r["status"] for r in done.months.collect()] == ["empty"]


def test_history_feeds_the_training_tables(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for day in range(10, 21):
        stops = [f"t{day},S{i},1,2024-01-{day} 15:{i:02}:00,,," for i in range(7)]
        day_archive(raw, f"2024-01-{day}", *stops, f",S1,1,2024-01-{day} 15:00:00,,,",
                    trips=[f"t{day},2024-01-{day} 15:00:00,E,S", ",,E,S"])
    (tmp_path / "stops.csv").write_text(
        "stop_id,stop_name,stop_lat,stop_lon,location_type,parent_station\n"
        + "".join(f"S{i},{'X' if i in (5, 6) else 'Y'},40.5,-73.5,0,\n" for i in range(7)))
    months = {"first_month": "2024-01", "last_month": "2024-01"}
    jobs.load_history(spark, str(raw), str(tmp_path / "months"), str(tmp_path / "out"), **months)
    rows = jobs.load_training_input(spark, str(tmp_path / "months"), str(tmp_path / "stops.csv"),
                                    str(tmp_path / "input"), **months)
    assert rows.count() == 77 and rows.columns == schemas.STOP_TIMES.fieldNames()
    tables = jobs.build_training_tables(rows, str(tmp_path / "t"), target_stop="X")
    assert (tables.prepared.count(), tables.samples.count()) == (77, 22)


def test_training_tables(spark, tmp_path):
    rows = [(name, stop, at + dt.timedelta(days=day)) for day in range(11)
            for name, stop, at in trip_of(7, {6, 7}, f"trip{day}")]
    tables = jobs.build_training_tables(stop_times(spark, rows), str(tmp_path / "t"),
                                        target_stop="X")
    assert (tables.prepared.count(), tables.samples.count(), tables.dates.count()) == (77, 22, 1)
    test = ops.read_split(tables.samples, tables.dates, "test")
    assert test.count() == 2
    # the dates of other splits are skipped as files
    line = next(x for x in plan_of(test).splitlines() if "PartitionFilters" in x)
    assert "trip_date" in line


def test_scratch_is_under_the_shared_folder(spark):
    from railstream import scratch_path
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(shared)


class Elsewhere:
    """A session of a cluster that names no shared folder."""

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)


def test_a_cluster_without_a_shared_folder_is_refused():
    from railstream import scratch_path
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Elsewhere, "x")
    assert scratch_path(Elsewhere, "x", "/shared").startswith("/shared/")
