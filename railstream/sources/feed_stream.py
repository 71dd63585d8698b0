"""Streaming sources of feed messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_feed_stream(
    spark: SparkSession,
    path: str | None = None,
    *,
    source: str = "text",
    files_per_trigger: int | None = None,
    options: Mapping[str, str] | None = None,
    form: str = "json",
) -> DataFrame:
    """Unbounded messages: ``value`` and ``publish_time``.

    ``text`` reads a landing folder, one JSON message per line, and ``binaryFile`` one of
    protocol buffers, one message per file; the file's time is the publish time. Any other source
    (``kafka`` where its connector is installed) has to provide ``value`` and ``timestamp``.
    ``value`` is text, or bytes with ``form="protobuf"``.
    """
    reader = spark.readStream.format(source).options(**dict(options or {}))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if source == "binaryFile":
        rows = reader.schema(_BINARY_FILE).load(path)
        return rows.select(F.col("content").alias("value"),
                           F.col("modificationTime").alias("publish_time"))
    rows = reader.load(path) if path else reader.load()
    if source == "text":
        return rows.select("value", F.col("_metadata.file_modification_time").alias("publish_time"))
    return rows.select(F.col("value").cast("binary" if form == "protobuf" else "string").alias("value"),
                       F.col("timestamp").alias("publish_time"))


_BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"
