"""Reading the given tables, and intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railstream.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once in the shared scratch folder and return the table read back.

    Cuts the lineage: a lost executor costs one read of the file, not the work before it. The
    folder is the session's ``spark.checkpoint.dir``; whoever sets it clears it after the run.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rejoined(columns: list[str], text_col: str) -> list[Column]:
    """The given columns in their order, from ``text`` and the struct ``row`` with the others."""
    return [(F.col("text") if c == text_col else F.col("row")[c]).alias(c) for c in columns]
