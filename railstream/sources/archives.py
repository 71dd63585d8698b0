"""Historical archive: daily ``.tar.xz`` files -> monthly CSV folders -> typed rows."""

from __future__ import annotations

import io
import itertools
import lzma
import sys
import tarfile
from collections.abc import Callable, Iterator, Sequence
from typing import BinaryIO

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railstream import constants, schemas
from railstream.functions import temporal
from railstream.session import scratch_path
from railstream.sources.tables import replace_table

# Python workers get the functions below by value: they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows handed to Spark at a time while an archive is being read.
_LINES_PER_BATCH = 10_000

# Longest value that a row can hold.
_LARGEST_ARCHIVE = 2_147_483_632

_LINES = T.StructType([
    T.StructField("archive", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("file_bytes", T.LongType()),
    T.StructField("line_no", T.LongType()),
    T.StructField("line", T.StringType()),
    T.StructField("error", T.StringType()),
])
_ARROW = pa.schema([("archive", pa.string()), ("file_name", pa.string()),
                    ("file_bytes", pa.int64()), ("line_no", pa.int64()),
                    ("line", pa.string()), ("error", pa.string())])


def file_date(name: Column) -> Column:
    """Date in an archive or member name, as text ``YYYY-MM-DD``; NULL without one."""
    found = F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1)
    return F.when(found != "", found)


def is_data_file(name: Column) -> Column:
    """CSV files with stop times; ``*_trips.csv`` files are left out."""
    return name.endswith(".csv") & ~name.endswith("_trips.csv")


def is_trips_file(name: Column) -> Column:
    """CSV files with trips."""
    return name.endswith("_trips.csv")


def read_archives(spark: SparkSession, path: str | Sequence[str],
                  pattern: str = "*.tar.xz") -> DataFrame:
    """Archive files as ``path`` and ``content``, one row per file, or of a list of files.

    A file is one value of a row, so the content is held in memory and ends at 2 GiB. Larger
    files are not read: their content is NULL, and expanding them gives an error row.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if not isinstance(path, str) and not path:
        return spark.createDataFrame([], "path string, content binary")
    small = files.load(path).where(F.col("length") <= _LARGEST_ARCHIVE).select("path", "content")
    large = files.load(path).where(F.col("length") > _LARGEST_ARCHIVE)
    return small.unionByName(large.select("path", F.lit(None).cast("binary").alias("content")))


def archive_names(spark: SparkSession, path: str, pattern: str = "*.tar.xz") -> DataFrame:
    """Archive files by name only: ``archive`` and ``service_date``. No content is read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
            .select(F.col("path").alias("archive"), _date_of_path(F.col("path")).alias("service_date")))


def _date_of_path(path: Column) -> Column:
    return file_date(F.element_at(F.split(path, "/"), -1))


def _members(content: bytes) -> Iterator[tuple[str, int, BinaryIO]]:
    """Name, size and open content of each CSV member, in the order of the archive."""
    with tarfile.open(fileobj=io.BytesIO(content), mode="r|xz") as archive:
        for member in archive:
            if member.isfile() and member.name.endswith(".csv"):
                yield member.name.rsplit("/", 1)[-1], member.size, archive.extractfile(member)


def _rows(n: int, **columns) -> pa.RecordBatch:
    """``n`` rows; a column is a list of values, one value for all rows, or left out (NULL)."""
    arrays = []
    for field in _ARROW:
        value = columns.get(field.name)
        values = value if isinstance(value, (list, range)) else [value] * n
        arrays.append(pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)


def _archive_rows(path: str, content: bytes | None) -> Iterator[pa.RecordBatch]:
    """Rows of one archive as they are read: the lines of each member and its size, at the end
    the archive's own. An archive that cannot be read to its end has an error in its last row."""
    try:
        if content is None:
            raise ValueError("archive is larger than a row can hold")
        for name, size, member in _members(content):
            number = 1
            while chunk := list(itertools.islice(member, _LINES_PER_BATCH)):
                lines = [raw.decode("utf-8", "replace").rstrip("\r\n") for raw in chunk]
                yield _rows(len(lines), archive=path, file_name=name, line=lines,
                            line_no=range(number, number + len(lines)))
                number += len(lines)
            yield _rows(1, archive=path, file_name=name, file_bytes=size)
    except (tarfile.TarError, lzma.LZMAError, EOFError, OSError, ValueError) as problem:
        yield _rows(1, archive=path, error=str(problem) or type(problem).__name__)
    else:
        yield _rows(1, archive=path)


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            yield from _archive_rows(path.as_py(), content.as_py())


def expand_archives(archives: DataFrame, staging: str | None = None) -> DataFrame:
    """``path``, ``content`` -> the text lines of all CSV members, with their date and month.

    Besides lines (``line_no`` from 1, the header being 1) there is a row per member with
    its size and a row per archive, which holds the error of an unreadable one; both have
    ``line`` NULL. An archive is the unit of work: it is decompressed once, as a stream, by one
    task, and its lines are stored under ``staging`` (or in the scratch folder) as they come. An
    archive counts only as a whole: the lines of one that turned out unreadable are left out.
    """
    spark = archives.sparkSession
    rows = replace_table(archives.select("path", "content").mapInArrow(_expand, _LINES),
                         staging or scratch_path(spark, "expanded"), as_path=True)
    # One short text for each unreadable archive.
    failed = (rows.where(F.col("error").isNotNull())
              .agg(F.collect_set("archive").alias("archives")).scalar())
    return (rows.where(F.col("error").isNotNull() | ~F.array_contains(failed, F.col("archive")))
            .withColumn("service_date", _date_of_path(F.col("archive")))
            .withColumn("year_month", F.substring("service_date", 1, 7)))


def expansion_report(expanded: DataFrame) -> DataFrame:
    """Per archive: date, ``DECOMPRESSED`` or ``DECOMPRESS_ERROR``, members, bytes, message.

    ``skipped_archives`` has the same columns for those that were not expanded.
    """
    return (expanded.where(F.col("line").isNull())
            .groupBy("archive", "service_date")
            .agg(F.when(F.max("error").isNull(), "DECOMPRESSED")
                  .otherwise("DECOMPRESS_ERROR").alias("status"),
                 F.count("file_name").alias("csv_files"),
                 F.coalesce(F.sum("file_bytes"), F.lit(0)).alias("bytes"),
                 F.max("error").alias("message")))


def skipped_archives(names: DataFrame, present: DataFrame) -> DataFrame:
    """Report rows, status ``SKIPPED``, of the archives whose day is in ``present`` already."""
    return (names.join(present.select("service_date").distinct(), "service_date", "left_semi")
            .select("archive", "service_date", F.lit("SKIPPED").alias("status"),
                    F.lit(0).cast("bigint").alias("csv_files"), F.lit(0).cast("bigint").alias("bytes"),
                    F.lit(None).cast("string").alias("message")))


def status_tally(report: DataFrame, statuses: Sequence[str] = ()) -> DataFrame:
    """Number of items and bytes per status.

    Those of ``statuses`` have a row also without items: their count is 0, their bytes are NULL.
    """
    rows = report.select("status", F.lit(1).alias("item"), "bytes")
    if statuses:
        rows = rows.unionByName(report.sparkSession.range(1).select(
            F.explode(F.array(*[F.lit(s) for s in statuses])).alias("status"),
            F.lit(None).cast("int").alias("item"), F.lit(None).cast("bigint").alias("bytes")))
    return rows.groupBy("status").agg(F.count("item").alias("items"), F.sum("bytes").alias("bytes"))


def write_month_files(expanded: DataFrame, root: str) -> None:
    """Store the members as CSV text under ``root/year_month=.../file_name=.../``.

    All lines of a member come from one task, so it becomes one file with its header first.
    Writing a member again replaces it.
    """
    (expanded.where(F.col("line").isNotNull())
     .sortWithinPartitions("year_month", "file_name", "line_no")
     .select("year_month", "file_name", F.col("line").alias("value"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year_month", "file_name").text(root))


def _month_of(path: Column) -> Column:
    return F.regexp_extract(path, r"/(?:year_month=)?(\d{4}-\d{2})/", 1)


def _member_of(path: Column) -> Column:
    stored = F.regexp_extract(path, r"/file_name=([^/]+)/", 1)
    return F.when(stored != "", stored).otherwise(F.element_at(F.split(path, "/"), -1))


def month_files(
    spark: SparkSession, root: str, wanted: Callable[[Column], Column] = is_data_file
) -> DataFrame:
    """Data files under ``root`` by month: ``year_month``, ``file_name``, ``bytes``.

    Month folders may be named ``YYYY-MM`` or ``year_month=YYYY-MM``. File contents are
    not read.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
             .select(_month_of(F.col("path")).alias("year_month"),
                     _member_of(F.col("path")).alias("file_name"),
                     F.col("length").alias("bytes")))
    return files.where((F.col("year_month") != "") & wanted(F.col("file_name")))


def month_folders(spark: SparkSession, root: str, months: DataFrame) -> list[str]:
    """Folders of those ``months`` that have one; at most two names for each month."""
    folder = F.regexp_extract("path", r"^(.*/(?:year_month=)?\d{4}-\d{2})/", 1)
    return [r[0] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
            .select(folder.alias("folder"), _month_of(F.col("path")).alias("year_month"))
            .where("folder <> ''").distinct().join(months, "year_month", "left_semi")
            .select("folder").orderBy("folder").collect()]


def _typed(raw: Column, field: T.StructField) -> Column:
    if isinstance(field.dataType, T.StringType):
        return raw
    if isinstance(field.dataType, T.TimestampType):
        return temporal.csv_timestamp(raw)
    return raw.try_cast(field.dataType)


def read_months(
    spark: SparkSession,
    root: str,
    schema: T.StructType = schemas.SENSOR_DATA,
    *,
    months: DataFrame | None = None,
    header: bool = True,
    wanted: Callable[[Column], Column] = is_data_file,
) -> DataFrame:
    """CSV rows of all month folders, with ``year_month`` and the flag ``bad_record``.

    With ``months`` (column ``year_month``) only the folders of these are opened. ``wanted``
    chooses files by name.

    Missing trailing fields become NULL, surplus fields are dropped. A record is bad when a
    value does not fit its type or a required one is missing.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    path = F.col("_metadata.file_path")
    folders = root if months is None else month_folders(spark, root, months)
    reader = (spark.read.schema(text).option("header", header).option("enforceSchema", True)
              .option("mode", "PERMISSIVE").option("escape", "\"").option("recursiveFileLookup", True))
    files = (reader.csv(folders).withColumn("year_month", _month_of(path))
             .withColumn("_member", _member_of(path)) if folders else
             spark.createDataFrame([], T.StructType([
                 *text.fields, *(T.StructField(n, T.StringType()) for n in ("year_month", "_member"))])))
    raw = files.where((F.col("year_month") != "") & wanted(F.col("_member")))
    bad = F.lit(False)
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            bad = bad | (F.col(f.name).isNotNull() & _typed(F.col(f.name), f).isNull())
        if not f.nullable:
            bad = bad | F.col(f.name).isNull()
    return raw.select("year_month", *[_typed(F.col(f.name), f).alias(f.name) for f in schema.fields],
                      bad.alias("bad_record"))


def _month_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("year_month").agg(
        F.count_if(~F.col("bad_record")).alias("good_rows"),
        F.count_if("bad_record").alias("bad_rows"))


def accepted_rows(rows: DataFrame, *, max_bad: int = constants.MAX_BAD_RECORDS) -> DataFrame:
    """Good rows of the months with at most ``max_bad`` bad records.

    The months over the limit are found first and compared as a list (one short text per
    failed month), so rows are neither joined nor shuffled.
    """
    failed = (_month_counts(rows).where(F.col("bad_rows") > max_bad)
              .agg(F.collect_list("year_month").alias("months")).scalar())
    return (rows.where(~F.col("bad_record") & ~F.array_contains(failed, F.col("year_month")))
                .drop("bad_record"))


def append_months(
    rows: DataFrame, target: str, *, max_bad: int = constants.MAX_BAD_RECORDS,
    staging: str | None = None
) -> DataFrame:
    """Store accepted rows by month. A month loaded again replaces itself.

    The files are parsed once, into a table with the flag under ``staging`` (or in the scratch
    folder), which is returned: bad records are counted in it, and reports are made from it.
    """
    parsed = replace_table(rows, staging or scratch_path(rows.sparkSession, "parsed"), as_path=True)
    (accepted_rows(parsed, max_bad=max_bad).hint("rebalance", "year_month")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year_month").parquet(target))
    return parsed


def month_outcomes(
    months: DataFrame, files: DataFrame, rows: DataFrame, *, max_bad: int = constants.MAX_BAD_RECORDS
) -> DataFrame:
    """Per expected month: ``success``, ``failed`` or ``empty``, loaded and bad rows.

    ``months`` is a month spine, ``files`` comes from ``month_files`` and ``rows`` from
    ``read_months``. A month is empty when it has no file.
    """
    present = files.select("year_month").distinct()
    with_files = months.join(present, "year_month", "left_semi")
    without = months.join(present, "year_month", "left_anti")
    none = F.lit(0).cast("bigint")
    bad = F.coalesce(F.col("bad_rows"), none)
    loaded = (with_files.join(_month_counts(rows), "year_month", "left")
              .select("year_month",
                      F.when(bad > max_bad, "failed").otherwise("success").alias("status"),
                      F.when(bad > max_bad, none)
                       .otherwise(F.coalesce("good_rows", none)).alias("rows_loaded"),
                      bad.alias("bad_rows")))
    return loaded.unionByName(without.select(
        "year_month", F.lit("empty").alias("status"), none.alias("rows_loaded"),
        none.alias("bad_rows")))


def load_report(outcomes: DataFrame) -> DataFrame:
    """Months and rows per status, with the months as sorted text."""
    return outcomes.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_months"),
        F.sum("rows_loaded").alias("total_rows"),
        F.array_join(F.sort_array(F.collect_list("year_month")), ", ").alias("months"))


def day_spine(spark: SparkSession, start: str | Column, end: str | Column) -> DataFrame:
    """All dates from ``start`` to ``end``, both included, as ``service_date``."""
    first, last = (F.lit(d) if isinstance(d, str) else d for d in (start, end))
    return spark.range(1).select(F.explode(F.sequence(
        first.cast("date"), last.cast("date"), F.expr("interval 1 day"))).alias("service_date"))


def month_spine(spark: SparkSession, start: str | Column, end: str | Column) -> DataFrame:
    """All months ``YYYY-MM`` from ``start`` to ``end``, both included."""
    first, last = (F.trunc((F.concat(F.lit(d), F.lit("-01")) if isinstance(d, str) else d)
                           .cast("date"), "month") for d in (start, end))
    months = spark.range(1).select(F.explode(F.sequence(
        first, last, F.expr("interval 1 month"))).alias("month"))
    return months.select(F.date_format("month", "yyyy-MM").alias("year_month"))


def missing_days(spine: DataFrame, loaded: DataFrame) -> DataFrame:
    """Dates of the spine without a row in ``loaded`` (column ``service_date``)."""
    return spine.join(loaded.select("service_date").distinct(), "service_date", "left_anti")


def monthly_counts(df: DataFrame, ts: str = "arrival_time") -> DataFrame:
    """Rows per year and month of ``ts``, in order."""
    return (df.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month"))
              .agg(F.count(F.lit(1)).alias("records"))
              .orderBy("year", "month"))
