import io
import tarfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railstream import schemas
from railstream.sources import archives
from railstream.sources.tables import replace_table

FILE = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()),
                     T.StructField("c", T.TimestampType())])


def pack(path, members):
    with tarfile.open(path, "w:xz") as archive:
        for name, text in members.items():
            body = text.encode()
            info = tarfile.TarInfo(name)
            info.size = len(body)
            archive.addfile(info, io.BytesIO(body))


def month_file(root, name, *lines):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("a,b,c\n" + "".join(line + "\n" for line in lines))


def test_jagged_surplus_and_bad_records(spark, tmp_path):
    month_file(tmp_path, "2024-01/m_2024-01-01_stop_times.csv", "1,x",
               "2,y,2024-01-01 00:00:00,extra", "bad,z,2024-01-01 00:00:00",
               '3,"q, ""r""",1704067200', "4,,12:30:00")
    month_file(tmp_path, "2024-01/m_2024-01-01_trips.csv", "9,x,2024-01-01 00:00:00")
    month_file(tmp_path, "elsewhere/m_stop_times.csv", "9,x,2024-01-01 00:00:00")
    rows = archives.read_months(spark, str(tmp_path), FILE)
    assert rows.where("bad_record").count() == 2
    good = (archives.accepted_rows(rows, max_bad=2)
            .select("a", "b", F.col("c").cast("string")).orderBy("a"))
    assert [tuple(r) for r in good.collect()] == [
        (1, "x", None), (2, "y", "2024-01-01 00:00:00"), (3, 'q, "r"', "2024-01-01 00:00:00")]
    assert archives.accepted_rows(rows, max_bad=1).count() == 0


def test_months_fail_and_reload_one_by_one(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    month_file(source, "2024-01/x_stop_times.csv", "1,x,2024-01-01 00:00:00")
    month_file(source, "year_month=2024-02/x_stop_times.csv", "bad,,", "worse,,", "2,x,")
    rows = archives.read_months(spark, str(source), FILE)
    for _ in range(2):  # a second load does not double rows
        archives.append_months(rows, target, max_bad=1)
    assert spark.read.parquet(target).count() == 1
    spine = archives.month_spine(spark, "2023-12", "2024-02")
    outcomes = archives.month_outcomes(spine, archives.month_files(spark, str(source)), rows,
                                       max_bad=1)
    assert {r["year_month"]: tuple(r)[1:] for r in outcomes.collect()} == {
        "2023-12": ("empty", 0, 0), "2024-01": ("success", 1, 0), "2024-02": ("failed", 0, 2)}
    report = {r["status"]: tuple(r)[1:] for r in archives.load_report(outcomes).collect()}
    assert report["success"] == (1, 1, "2024-01")
    spine = archives.month_spine(spark, "2023-12", "2024-01")
    only = archives.read_months(spark, str(source), FILE, months=spine)
    assert only.count() == 1 and not any("2024-02" in f for f in only.inputFiles())
    nothing = archives.read_months(spark, str(source), FILE,
                                   months=archives.month_spine(spark, "2020-01", "2020-02"))
    assert nothing.count() == 0 and nothing.columns == only.columns


def test_files_are_parsed_once(spark, tmp_path):
    month_file(tmp_path / "in", "2024-01/x_stop_times.csv", "1,x,2024-01-01 00:00:00", "bad,,")
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = archives.read_months(spark, str(tmp_path / "in"), FILE)
    counted = rows.mapInArrow(seen, rows.schema)
    parsed = archives.append_months(counted, str(tmp_path / "out"))
    files = archives.month_files(spark, str(tmp_path / "in"))
    outcome = archives.month_outcomes(archives.month_spine(spark, "2024-01", "2024-01"), files, parsed)
    assert tuple(outcome.first()) == ("2024-01", "success", 1, 1)
    assert read.value == 2


def test_archives_are_expanded_once(spark, tmp_path):
    pack(tmp_path / "feed_2024-01-31_csv.tar.xz", {"a_2024-01-31_stop_times.csv": "h\n1\n"})
    opened = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            opened.add(batch.num_rows)
            yield batch

    given = archives.read_archives(spark, str(tmp_path))
    expanded = archives.expand_archives(given.mapInArrow(seen, given.schema))
    archives.write_month_files(expanded, str(tmp_path / "months"))
    assert archives.expansion_report(expanded).first()["bytes"] == 4
    assert expanded.where("line is not null").count() == 2 and opened.value == 1


def test_too_large_archives_are_reported(spark):
    given = spark.createDataFrame([("raw/feed_2024-01-31_csv.tar.xz", None)], "path string, content binary")
    row = archives.expansion_report(archives.expand_archives(given)).first()
    assert (row["status"], row["service_date"]) == ("DECOMPRESS_ERROR", "2024-01-31")
    assert "larger" in row["message"]


def test_archives_become_month_folders(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    header = ",".join(schemas.SENSOR_DATA.fieldNames())
    for day, n in (("2024-01-31", 3), ("2024-02-01", 2)):
        lines = [f"t{i},A0{i},1,{day} 10:0{i}:00,,," for i in range(n)]
        pack(raw / f"feed_{day}_csv.tar.xz", {
            f"deep/feed_{day}_stop_times.csv": "\n".join([header, *lines]) + "\n",
            f"feed_{day}_trips.csv": "trip_uid\nx\n", "readme.txt": "no"})
    (raw / "feed_2024-02-02_csv.tar.xz").write_bytes(b"broken")
    whole = (raw / "feed_2024-02-01_csv.tar.xz").read_bytes()
    (raw / "feed_2024-02-03_csv.tar.xz").write_bytes(whole[:len(whole) // 2])

    expanded = archives.expand_archives(archives.read_archives(spark, str(raw)))
    report = archives.expansion_report(expanded)
    status = {r["service_date"]: (r["status"], r["csv_files"]) for r in report.collect()}
    assert status == {"2024-01-31": ("DECOMPRESSED", 2), "2024-02-01": ("DECOMPRESSED", 2),
                      "2024-02-02": ("DECOMPRESS_ERROR", 0), "2024-02-03": ("DECOMPRESS_ERROR", 0)}
    tally = {r["status"]: r["items"] for r in archives.status_tally(report).collect()}
    assert tally == {"DECOMPRESSED": 2, "DECOMPRESS_ERROR": 2}

    root = str(tmp_path / "months")
    for _ in range(2):
        archives.write_month_files(expanded, root)
    rows = archives.read_months(spark, root)
    assert {(r["year_month"], r["n"]) for r in rows.groupBy("year_month")
            .agg(F.count("*").alias("n")).collect()} == {("2024-01", 3), ("2024-02", 2)}
    assert rows.where("bad_record").count() == 0
    counts = archives.monthly_counts(archives.accepted_rows(rows)).collect()
    assert [tuple(r) for r in counts] == [(2024, 1, 3), (2024, 2, 2)]

    days = archives.day_spine(spark, "2024-01-30", "2024-02-02")
    loaded = (expanded.where(F.col("line").isNotNull())
              .select(F.col("service_date").cast("date").alias("service_date")))
    missing = archives.missing_days(days, loaded).orderBy("service_date").collect()
    assert [str(r[0]) for r in missing] == ["2024-01-30", "2024-02-02"]


def test_month_spine_has_56_months(spark):
    months = [r[0] for r in archives.month_spine(spark, "2021-04", "2025-11").collect()]
    assert len(months) == 56 and (months[0], months[-1]) == ("2021-04", "2025-11")


def test_schema_from_fields():
    schema = schemas.from_json_fields(
        '[{"name": "a", "type": "STRING", "mode": "REQUIRED", "description": "key"},'
        ' {"name": "b", "type": "TIMESTAMP"}, {"name": "c", "type": "INTEGER"}]')
    assert schema == T.StructType([
        T.StructField("a", T.StringType(), False, {"comment": "key"}),
        T.StructField("b", T.TimestampType()), T.StructField("c", T.LongType())])


@pytest.mark.parametrize("as_path", [True, False])
def test_replace_table(spark, tmp_path, as_path):
    target = str(tmp_path / "t") if as_path else "replaced"
    df = spark.range(100).select("id", (F.col("id") % 3).alias("part"))
    for rows in (df, df.limit(50)):
        out = replace_table(rows, target, partition_by=["part"], sort_by=["id"], as_path=as_path)
    assert out.count() == 50
