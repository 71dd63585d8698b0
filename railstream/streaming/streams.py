"""Structured Streaming: event-time windows, late rows, sinks and progress."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from railstream.constants import (
    DEDUPE_HORIZON,
    DEDUPE_SPREAD,
    STREAM_EVERY,
    STREAM_LATENESS,
    STREAM_WINDOW,
)

# Fields that tell one report from another.
REPORT_KEY = ("entity_id", "vehicle_timestamp", "stop_id")


def assign_window(df: DataFrame, ts: str = "publish_time", length: str = STREAM_WINDOW) -> DataFrame:
    """Add ``window_start`` and ``window_end``; changes no row and keeps no state."""
    window = F.window(ts, length)
    return (df.withColumn("_w", window)
              .withColumn("window_start", F.col("_w.start"))
              .withColumn("window_end", F.col("_w.end")).drop("_w"))


def _count_by_window(df: DataFrame, ts: str, keys: Sequence[str], length: str) -> DataFrame:
    return (df.groupBy(F.window(ts, length).alias("w"), *keys)
              .agg(F.count(F.lit(1)).alias("n"))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *keys, "n"))


def windowed_counts(
    df: DataFrame,
    ts: str = "publish_time",
    *,
    keys: Sequence[str] = (),
    length: str = STREAM_WINDOW,
    lateness: str = STREAM_LATENESS,
) -> DataFrame:
    """Rows per window, final: a window comes out once, when ``lateness`` after its end has passed.

    Rows that are later still are dropped. Counts are combined before the shuffle.
    """
    return _count_by_window(df.withWatermark(ts, lateness), ts, keys, length)


def write_delta_counts(
    df: DataFrame,
    target: str,
    checkpoint: str,
    *,
    ts: str = "publish_time",
    keys: Sequence[str] = (),
    length: str = STREAM_WINDOW,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Rows per window and firing: each micro-batch adds the counts of its own rows only.

    A batch is stored in a folder of its own, so a repeated batch replaces itself and every
    row is counted once. Summing over batches gives the total of a window.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        (_count_by_window(batch, ts, keys, length)
         .write.mode("overwrite").parquet(f"{target}/batch={batch_id}"))

    writer = df.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(trigger)).start()


def dedupe_positions(
    df: DataFrame,
    *,
    keys: Sequence[str] = REPORT_KEY,
    seen: str = "publish_time",
    horizon: str = DEDUPE_HORIZON,
    spread: int = DEDUPE_SPREAD,
) -> DataFrame:
    """One row per distinct ``keys``, the first seen; a report repeated within ``horizon`` is left out.

    The feed repeats a report until the next one, so the time a report was made says nothing
    about when it comes in. Repeats and late rows are judged by ``seen``, the time of arrival:
    a report that is minutes old is kept, in the batch that brings it. Only a row that arrives
    more than ``horizon`` behind the newest arrival is dropped, and counted in the progress.
    NULL keys are equal to each other; add a column to tell such rows apart.

    Repeats are first left out in ``spread`` parts, by a hash of their arrival time and values,
    then among the parts: a report repeated very often loads no single task.
    """
    part = F.pmod(F.xxhash64(*df.columns), F.lit(spread))
    return (df.withColumn("_part", part).withWatermark(seen, horizon)
              .dropDuplicatesWithinWatermark([*keys, "_part"])
              .dropDuplicatesWithinWatermark([*keys]).drop("_part"))


def _trigger(trigger: Mapping[str, object] | None) -> dict:
    """A batch starts as soon as there is data, at most every five seconds."""
    return dict(trigger) if trigger else {"processingTime": STREAM_EVERY}


def _start(writer: DataStreamWriter, checkpoint: str, trigger, name: str | None) -> StreamingQuery:
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**_trigger(trigger)).start()


def append_stream(
    df: DataFrame,
    target: str,
    checkpoint: str,
    *,
    partition_by: Sequence[str] = (),
    trigger: Mapping[str, object] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet folder, each row exactly once; the folder is made if needed."""
    writer = df.writeStream.format("parquet").option("path", target)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _start(writer, checkpoint, trigger, name)


def publish_messages(
    df: DataFrame,
    target: str | None,
    checkpoint: str,
    *,
    sink: str = "text",
    options: Mapping[str, str] | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Publish each row as JSON: a single text column ``value`` as it is, others as an object.

    ``text`` writes to the folder ``target``; any other sink (``kafka`` where its connector is
    installed) gets ``value`` and its ``options``.
    """
    value: Column = F.col("value") if df.columns == ["value"] else F.to_json(F.struct("*"))
    writer = df.select(value.alias("value")).writeStream.format(sink).options(**dict(options or {}))
    if target:
        writer = writer.option("path", target)
    return _start(writer, checkpoint, trigger, None)


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query with an ``availableNow`` trigger; its failure is raised here."""
    query.awaitTermination()
    return query


_PROGRESS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("input_rows", T.LongType()),
    T.StructField("watermark", T.StringType()),
    T.StructField("max_event_time", T.StringType()),
    T.StructField("dropped_late_rows", T.LongType()),
])


class ProgressLog(StreamingQueryListener):
    """Stores one row per micro-batch under ``path``, of the query named ``name`` or of all.

    Use as a context manager around the run. A query itself remembers its last batches only.
    """

    def __init__(self, spark: SparkSession, path: str, name: str | None = None) -> None:
        self.spark, self.path, self.name = spark, path, name

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        # Events of the last batch may still be on their way.
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)

    def onQueryProgress(self, event) -> None:  # noqa: N802  (the listener's own name)
        p = event.progress
        if self.name is not None and p.name != self.name:
            return
        times = p.eventTime or {}
        row = (str(p.runId), p.batchId, p.numInputRows, times.get("watermark"), times.get("max"),
               sum(s.numRowsDroppedByWatermark for s in p.stateOperators))
        (self.spark.createDataFrame([row], _PROGRESS).coalesce(1)
             .write.mode("append").parquet(self.path))

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """Every micro-batch in a ``ProgressLog``: input rows, watermark, newest event time, late rows dropped."""
    return (spark.read.schema(_PROGRESS).parquet(path)
                 .withColumn("watermark", F.col("watermark").cast("timestamp"))
                 .withColumn("max_event_time", F.col("max_event_time").cast("timestamp"))
                 .withColumn("lag_seconds", F.unix_seconds("max_event_time")
                             - F.unix_seconds("watermark")))
