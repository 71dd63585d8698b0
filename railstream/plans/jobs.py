"""The three jobs a user runs: the live feed, the history load, the training tables."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from railstream import constants, schemas
from railstream.operators import binary_feed, feed, samples
from railstream.session import scratch_path
from railstream.sources import archives
from railstream.sources.feed_stream import read_feed_stream
from railstream.sources.stops import read_stop_lookup, read_stops
from railstream.sources.tables import replace_table
from railstream.streaming import permanent, streams


def run_live_feed(
    spark: SparkSession,
    landing: str,
    stops_file: str,
    target: str,
    checkpoint: str,
    *,
    files_per_trigger: int | None = None,
    trigger: Mapping[str, object] | None = None,
    form: str = "json",
) -> StreamingQuery:
    """Landed feed messages -> enriched vehicle positions and rejects, appended to ``target``.

    Messages are lines of JSON or, with ``form="protobuf"``, files as fetched from the feed. One write, parted by ``kind`` and local ``service_date``; read it with ``live_table``. A
    message that cannot be parsed is stored as a reject, from the same parse. The stop lookup
    is read when the query starts; a restart refreshes it. ``files_per_trigger`` bounds a batch.
    """
    messages = _landed(spark, landing, files_per_trigger, form)
    live = feed.live_rows(messages, read_stop_lookup(spark, stops_file), form=form)
    return streams.append_stream(live, target, checkpoint, trigger=trigger, name="live_positions",
                                 partition_by=["kind", "service_date"])


def _landed(spark: SparkSession, landing: str, files_per_trigger: int | None, form: str) -> DataFrame:
    source = {"json": "text", "protobuf": "binaryFile"}[form]
    return read_feed_stream(spark, landing, source=source, files_per_trigger=files_per_trigger,
                            form=form)


def flush_live_feed(spark: SparkSession, target: str, store: str, cut: str) -> DataFrame:
    """Move what ``run_live_feed`` has appended since the last flush to permanent storage.

    To run every 90 minutes or so, beside the stream, each time with another ``cut``. Returns one
    row per file that was moved. Rows are stored by kind and service date, sorted by station and
    time.
    """
    return permanent.flush(spark.read.schema(_LIVE).parquet(target), store, cut,
                           partition_by=["kind", "service_date"],
                           sort_by=["stop_name", "vehicle_timestamp"])


def live_table(
    spark: SparkSession, target: str, kind: str = "position", *, store: str | None = None
) -> DataFrame:
    """Positions (with ``service_date``), or with ``kind="reject"`` the rejected payloads.

    With the ``store`` of ``flush_live_feed``, rows that were moved there are read from it.
    """
    rows = spark.read.schema(_LIVE).parquet(target)
    if store:
        rows = permanent.read(rows, store)
    rows = rows.where(F.col("kind") == kind)
    if kind == "reject":
        return rows.select("bad_payload")
    return rows.drop("kind", "bad_payload")


_LIVE = T.StructType([*schemas.POSITIONS.fields,
                      *(T.StructField(n, T.StringType()) for n in
                        ("bad_payload", "kind", "service_date"))])


def run_publish(
    spark: SparkSession,
    landing: str,
    target: str | None,
    checkpoint: str,
    *,
    sink: str = "text",
    options: Mapping[str, str] | None = None,
    files_per_trigger: int | None = None,
    trigger: Mapping[str, object] | None = None,
    form: str = "json",
) -> StreamingQuery:
    """Landed raw messages -> JSON messages with an envelope, published to ``sink``.

    With ``form="protobuf"`` the landed files are as fetched from the feed; one that is no feed
    message is left out, and found again with ``binary_feed.decode_messages``.
    """
    messages = _landed(spark, landing, files_per_trigger, form).select("value")
    published = (binary_feed.published_json(binary_feed.decode_messages(messages))
                 if form == "protobuf" else feed.enveloped_json(messages))
    return streams.publish_messages(published, target, checkpoint, sink=sink, options=options,
                                    trigger=trigger)


class HistoryLoad(NamedTuple):
    expansion: DataFrame  # one row per archive
    months: DataFrame  # one row per expected month
    report: DataFrame  # one row per status


def load_history(
    spark: SparkSession,
    archive_path: str,
    month_root: str,
    target: str,
    *,
    first_month: str,
    last_month: str,
    max_bad: int = constants.MAX_BAD_RECORDS,
) -> HistoryLoad:
    """Archives -> month folders -> ``target`` by month; reports come from the stored tables.

    Archives of days that have files in ``month_root`` are skipped, without being read. Only the
    months from ``first_month`` to ``last_month`` are opened and loaded.
    """
    names = archives.archive_names(spark, archive_path)
    present = _days(spark, month_root)
    skipped = replace_table(archives.skipped_archives(names, present),
                            scratch_path(spark, "skipped"), as_path=True)
    # One path for each new day.
    new = [r[0] for r in names.join(skipped.select("archive"), "archive", "left_anti")
           .select("archive").orderBy("archive").collect()]
    expanded = archives.expand_archives(archives.read_archives(spark, new))
    archives.write_month_files(expanded, month_root)
    expansion = archives.expansion_report(expanded).unionByName(skipped)
    spine = archives.month_spine(spark, first_month, last_month)
    if not _has_files(spark, month_root):
        files = spark.createDataFrame([], "year_month string, file_name string, bytes bigint")
        rows = spark.createDataFrame([], "year_month string, bad_record boolean")
    else:
        files = archives.month_files(spark, month_root)
        rows = archives.append_months(
            archives.read_months(spark, month_root, schemas.SENSOR_DATA, months=spine), target,
            max_bad=max_bad)
    months = archives.month_outcomes(spine, files, rows, max_bad=max_bad)
    return HistoryLoad(expansion, months, archives.load_report(months))


def _has_files(spark: SparkSession, root: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _days(spark: SparkSession, month_root: str) -> DataFrame:
    """Days that have data files in the month folders."""
    if not _has_files(spark, month_root):
        return spark.createDataFrame([], "service_date string")
    return (archives.month_files(spark, month_root)
            .select(archives.file_date(F.col("file_name")).alias("service_date")).distinct())


def load_training_input(
    spark: SparkSession,
    month_root: str,
    stops_file: str,
    target: str,
    *,
    first_month: str,
    last_month: str,
    max_bad: int = constants.MAX_BAD_RECORDS,
) -> DataFrame:
    """Stop observations and trips of the month folders, and a stop file -> ``schemas.STOP_TIMES``.

    Stored under ``target`` and returned; the input of ``build_training_tables``. A month whose
    files of either kind have too many bad records is left out of that kind.
    """
    spine = archives.month_spine(spark, first_month, last_month)

    def accepted(schema: T.StructType, wanted) -> DataFrame:
        rows = archives.read_months(spark, month_root, schema, months=spine, wanted=wanted)
        parsed = replace_table(rows, scratch_path(spark, "parsed"), as_path=True)
        return archives.accepted_rows(parsed, max_bad=max_bad)

    trips = accepted(schemas.TRIPS, archives.is_trips_file).dropDuplicates(["trip_uid"])
    seen = accepted(schemas.SENSOR_DATA, archives.is_data_file)
    return replace_table(samples.build_raw_stop_times(seen, trips, read_stops(spark, stops_file)),
                         target, as_path=True)


class TrainingTables(NamedTuple):
    prepared: DataFrame
    samples: DataFrame
    dates: DataFrame


def build_training_tables(
    stop_times: DataFrame,
    target: str,
    *,
    route_id: str = constants.SAMPLE_ROUTE,
    direction: str = constants.SAMPLE_DIRECTION,
    target_stop: str = constants.SAMPLE_TARGET_STOP,
    k: int = constants.SAMPLE_CONTEXT_STOPS,
) -> TrainingTables:
    """Prepared stop times, samples and split dates as Parquet folders under ``target``.

    Each step reads the stored result of the one before, so nothing is computed twice. The
    two large tables are stored by date: reading a split skips the other dates' files.
    """
    prepared = replace_table(
        samples.prepare_stop_times(stop_times, route_id=route_id, direction=direction),
        f"{target}/prepared", partition_by=["trip_date"], sort_by=["trip_uid", "stop_sequence"],
        as_path=True)
    made = replace_table(
        samples.context_windows(prepared, target_stop=target_stop, k=k),
        f"{target}/samples", partition_by=["trip_date"], sort_by=["trip_uid", "target_sequence"],
        as_path=True)
    dates = replace_table(samples.split_dates(made), f"{target}/split_dates", as_path=True)
    return TrainingTables(prepared, made, dates)
