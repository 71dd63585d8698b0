"""Stop reference files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railstream import schemas
from railstream.functions import text
from railstream.session import scratch_path
from railstream.sources.tables import replace_table

_LOOKUP = T.StructType([T.StructField(n, T.StringType()) for n in
                        ("stop_id", "stop_name", "stop_lat", "stop_lon")])
# A field is quoted, with doubled quotes inside, or free of commas; four at least make a record.
_FIELD = r'(?:"(?:[^"]|"")*"[^,]*|(?!")[^,]*)'
_FOUR_FIELDS = rf"^{_FIELD}(?:,{_FIELD}){{3}}"


def read_stop_lookup(spark: SparkSession, path: str, table_path: str | None = None) -> DataFrame:
    """Lookup CSV, one record per line: the first four fields as trimmed text.

    Lines with fewer than four fields and header lines (wherever they occur) are left out; empty
    and surplus fields are no fault. For a repeated id the last line wins. The file is read when
    this is called and the lookup kept as a table, at ``table_path`` or in the scratch folder: a
    stream joined to it uses that state in every batch until it is restarted.
    """
    lines = spark.read.text(path).select("value", F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id()).alias("_place"))
    record = F.from_csv(F.col("value"), _LOOKUP.simpleString()[7:-1].replace(":", " "),
                        {"escape": '"', "mode": "PERMISSIVE"})
    rows = (lines.where(F.col("value").rlike(_FOUR_FIELDS))
            .select(record.alias("r"), "_place").select("r.*", "_place")
            .withColumn("stop_id", F.coalesce("stop_id", F.lit("")))
            .where(F.lower("stop_id") != "stop_id"))
    return replace_table(stop_lookup(rows, place="_place"),
                         table_path or scratch_path(spark, "stop-lookup"), as_path=True)


def stop_lookup(stops: DataFrame, *, place: str | None = None) -> DataFrame:
    """Any stop table -> lookup with unique ids and all fields as trimmed text.

    ``place`` names a column that orders rows of the same id; the greatest is kept.
    Without it the greatest record is.
    """
    fields = [F.coalesce(text.strip(F.col(n).cast("string")), F.lit("")).alias(n)
              for n in ("stop_id", "stop_name", "stop_lat", "stop_lon")]
    record = F.struct("stop_name", "stop_lat", "stop_lon")
    rows = stops.select(*fields, *([F.col(place).alias("_place")] if place else []))
    best = F.max_by(record, "_place") if place else F.max(record)
    return rows.groupBy("stop_id").agg(best.alias("r")).select("stop_id", "r.*")


def read_stops(spark: SparkSession, path: str) -> DataFrame:
    """Stop table CSV: one header line, fixed schema, quoted line breaks allowed.

    A field that does not fit its type stops the load, as does a row without ``stop_id``.
    """
    rows = (spark.read.schema(schemas.STOPS)
            .option("header", True).option("enforceSchema", True)
            .option("multiLine", True).option("escape", "\"").option("mode", "FAILFAST")
            .csv(path))
    # The reader takes no notice of fields that must not be null.
    return rows.withColumn("stop_id", F.coalesce(
        "stop_id", F.raise_error(F.lit("Row without stop_id")).cast("string")))
