"""Daily sums of the station analytics, kept beside the reports and brought up to date day by day.

Idle time, headway and arrivals are compared within a local date only, so their sums by station and
date add up to those of any range of dates. A report over years then reads a row per station and
date instead of every vehicle report, and a day's new reports cost the work of that day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railstream import constants
from railstream.operators import stations
from railstream.session import scratch_path
from railstream.sources.tables import replace_table

# ``total`` is in seconds for idle times and in minutes for headways; ``trips`` counts train arrivals.
DAILY = ("kind string, stop_name string, stop_lat double, stop_lon double, n double, total double, "
         "trips bigint, service_date string")


def daily_sums(
    positions: DataFrame,
    *,
    max_gap_s: int = constants.IDLE_MAX_GAP_S,
    max_minutes: int = constants.HEADWAY_MAX_MINUTES,
    direction: str = constants.IDLE_DIRECTION,
    tz: str = constants.LOCAL_ZONE,
) -> DataFrame:
    """Rows of ``DAILY``: kinds ``idle``, ``headway`` and ``arrivals`` by station and local date."""
    none = F.lit(None)
    idle = stations.idle_parts(positions, (*stations.STATION, "trip_date"), max_gap_s=max_gap_s,
                               direction=direction, tz=tz).select(
        F.lit("idle").alias("kind"), *stations.STATION, "n", F.col("seconds").alias("total"),
        none.alias("trips"), F.col("trip_date").alias("service_date"))
    headway = stations.headway_parts(positions, max_minutes=max_minutes, tz=tz).select(
        F.lit("headway").alias("kind"), "stop_name", none.alias("stop_lat"), none.alias("stop_lon"),
        "n", "total", "trips", F.col("event_date").alias("service_date"))
    arrivals = stations.first_arrivals(positions, tz=tz).groupBy("stop_name", "event_date").agg(
        F.count("*").alias("trips")).select(
        F.lit("arrivals").alias("kind"), "stop_name", none.alias("stop_lat"), none.alias("stop_lon"),
        none.alias("n"), none.alias("total"), "trips", F.col("event_date").alias("service_date"))
    rows = idle.unionByName(headway).unionByName(arrivals)
    names = [field.split() for field in DAILY.split(", ")]
    return rows.select(*[F.col(n).cast(kind).alias(n) for n, kind in names])


def refresh(
    positions: DataFrame, target: str, first_date: str, last_date: str, **limits
) -> DataFrame:
    """Make the sums of the local dates from ``first_date`` to ``last_date`` anew, and return all.

    ``target`` is stored by date: days that have reports replace their folder, others stay. Of
    ``positions`` only these days are read. ``limits`` are those of ``daily_sums`` and should not
    change between refreshes. The reports of a refresh that is repeated are not counted twice.
    """
    spark = positions.sparkSession
    days = stations.positions_between(positions, first_date, last_date,
                                      tz=limits.get("tz", constants.LOCAL_ZONE))
    # Read for each kind; stored so that the days are read from the source once.
    days = replace_table(days, scratch_path(spark, "days"), as_path=True)
    (daily_sums(days, **limits).hint("rebalance", "service_date").sortWithinPartitions("kind", "stop_name")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("service_date").parquet(target))
    return read(spark, target)


def read(
    spark: SparkSession, target: str, first_date: str | None = None, last_date: str | None = None
) -> DataFrame:
    """The stored sums, of all dates or of a range of them; other dates are skipped as folders."""
    rows = spark.read.schema(DAILY).parquet(target)
    if first_date:
        rows = rows.where(F.col("service_date") >= first_date)
    if last_date:
        rows = rows.where(F.col("service_date") <= last_date)
    return rows


def idle_time(daily: DataFrame, **options) -> DataFrame:
    """``stations.idle_time`` over the dates of ``daily``."""
    parts = daily.where("kind = 'idle'").groupBy(*stations.STATION).agg(
        F.sum("n").alias("n"), F.sum("total").alias("seconds"))
    return stations.idle_report(parts, **options)


def headway(daily: DataFrame) -> DataFrame:
    """``stations.headway`` over the dates of ``daily``, with the trips of each date added up."""
    return (daily.where("kind = 'headway'").groupBy("stop_name")
            .agg(F.round(F.sum("total") / F.sum("n"), 2).alias("average_min_difference_between_trains"),
                 F.sum("trips").alias("total_trips"))
            .orderBy(F.desc("average_min_difference_between_trains"), "stop_name"))


def busiest(
    daily: DataFrame, *, weekdays_only: bool = True, top: int = constants.BUSIEST_TOP
) -> DataFrame:
    """``stations.busiest`` over the dates of ``daily``."""
    rows = daily.where("kind = 'arrivals'")
    if weekdays_only:
        rows = rows.where(F.dayofweek(F.col("service_date").cast("date")).between(2, 6))
    return (rows.groupBy("stop_name").agg(F.sum("trips").alias("total_arrivals"))
            .orderBy(F.desc("total_arrivals"), "stop_name").limit(top))
