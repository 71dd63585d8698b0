"""From the buffer of a stream to permanent storage.

A stream that fires every few seconds appends thousands of small files a day. ``flush`` moves what
has come since the last time into a permanent folder, as few and sorted files; run it every hour or
two. ``read`` gives the rows of both, each once, whatever has been flushed.

A buffer file counts as flushed when the list of files says so, and that list is written last, from
the rows as they are stored. So a flush that fails leaves rows that no reader takes, and the next
one starts from the same files. Nothing is deleted here: flushed files of the buffer may go once no
query reads them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FILES = "cut string, file string, file_time timestamp, n bigint"
_FILE, _TIME, _CUT = "_file", "_file_time", "_cut"
# How far the clocks of the machines that write the buffer may be apart.
CLOCK_SLACK = "1 hour"


def _parts(store: str) -> tuple[str, str]:
    return f"{store.rstrip('/')}/rows", f"{store.rstrip('/')}/files"


def flushed_files(spark: SparkSession, store: str) -> DataFrame:
    """cut, file, file_time and n (rows) of each buffer file that has been flushed."""
    path = _parts(store)[1]
    empty = spark.createDataFrame([], _FILES)
    return spark.read.schema(_FILES).parquet(path) if _exists(spark, path) else empty


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _waiting(buffer: DataFrame, done: DataFrame, slack: str) -> DataFrame:
    """Buffer rows of files that are not flushed, with the file's name and time.

    Files older than the last flushed one, by more than the slack of clocks, are skipped unread.
    """
    since = done.agg((F.max("file_time") - F.expr(f"interval {slack}")).alias("since"))
    rows = buffer.select("*", F.col("_metadata.file_path").alias(_FILE),
                         F.col("_metadata.file_modification_time").alias(_TIME))
    first = since.first()[0]
    if first is not None:
        rows = rows.where(F.col("_metadata.file_modification_time") >= F.lit(first))
    known = done.select(F.col("file").alias("_known"))
    return rows.join(known, F.col(_FILE) == F.col("_known"), "left_anti")


def flush(
    buffer: DataFrame,
    store: str,
    cut: str,
    *,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    slack: str = CLOCK_SLACK,
) -> DataFrame:
    """Store the buffer's rows that are not flushed yet and return their files, as ``flushed_files``.

    ``buffer`` is a folder read as a DataFrame. ``cut`` names the flush and has to be new, e.g. its
    time. Rows are dealt out evenly by ``partition_by``, so a large value fills several files and a
    small one a single file, and sorted by ``sort_by``, for row groups to be skipped.
    """
    spark = buffer.sparkSession
    rows_path, files_path = _parts(store)
    done = flushed_files(spark, store)
    target = f"{rows_path}/{_CUT}={cut}"
    if _exists(spark, target):
        raise ValueError(f"cut {cut!r} is there already")
    waiting = _waiting(buffer, done, slack)
    rows = waiting.hint("rebalance", *partition_by)
    if sort_by:
        rows = rows.sortWithinPartitions(*partition_by, *sort_by)
    rows.write.partitionBy(*partition_by).parquet(target)
    stored = spark.read.schema(waiting.schema).parquet(target)
    found = stored.groupBy(F.lit(cut).alias("cut"), F.col(_FILE).alias("file")).agg(
        F.max(_TIME).alias("file_time"), F.count("*").alias("n"))
    found.write.mode("append").parquet(files_path)
    return flushed_files(spark, store).where(F.col("cut") == cut)


def read(buffer: DataFrame, store: str, *, slack: str = CLOCK_SLACK) -> DataFrame:
    """All rows of the buffer, flushed or not, with the buffer's columns.

    What has been flushed is read from ``store``; of the buffer only the rest is opened.
    """
    spark = buffer.sparkSession
    done = flushed_files(spark, store)
    waiting = _waiting(buffer, done, slack).select(*buffer.columns)
    path = _parts(store)[0]
    if not _exists(spark, path):
        return waiting
    schema = T.StructType([*buffer.schema.fields, T.StructField(_CUT, T.StringType())])
    cuts = done.select(F.col("cut").alias("_done")).distinct()
    rows = spark.read.schema(schema).option("basePath", path).parquet(path)
    kept = rows.join(cuts, F.col(_CUT) == F.col("_done"), "left_semi").select(*buffer.columns)
    return kept.unionByName(waiting)
