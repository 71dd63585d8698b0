"""Station analytics: idle time, headway, busiest stations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railstream import constants
from railstream.functions import temporal
from railstream.functions.slices import in_blocks, with_previous
from railstream.session import scratch_path
from railstream.sources.tables import replace_table

STATION = ("stop_name", "stop_lat", "stop_lon")


def idle_time(
    positions: DataFrame,
    *,
    max_gap_s: int = constants.IDLE_MAX_GAP_S,
    repeat_s: int = constants.IDLE_REPEAT_S,
    direction: str = constants.IDLE_DIRECTION,
    excluded: Sequence[str] = constants.IDLE_EXCLUDED,
    tz: str = constants.LOCAL_ZONE,
    compare: str = "local",
    carry: bool = False,
    order_by: str = "text",
    blocks: int | None = None,
) -> DataFrame:
    """Mean time between consecutive reports of a train at one station, as ``M:SS``.

    Reports of a trip at a station are compared within a local date. Two reports with the
    same local time count as ``repeat_s``; gaps over ``max_gap_s`` are ignored.
    ``compare="instant"`` treats only equal instants as repeats, which differs in the hour
    that occurs twice when clocks go back. ``order_by`` is ``text`` or ``seconds``.

    Identical reports are counted before the shuffle, and a large (station, trip, date) group is
    cut into ``blocks`` of the data (see ``functions.slices``), whatever the cap.
    """
    parts = idle_parts(positions, STATION, max_gap_s=max_gap_s, repeat_s=repeat_s,
                       direction=direction, excluded=excluded, tz=tz, compare=compare, blocks=blocks)
    return idle_report(parts, carry=carry, order_by=order_by)


def idle_parts(
    positions: DataFrame,
    by: Sequence[str],
    *,
    max_gap_s: int = constants.IDLE_MAX_GAP_S,
    repeat_s: int = constants.IDLE_REPEAT_S,
    direction: str = constants.IDLE_DIRECTION,
    excluded: Sequence[str] = constants.IDLE_EXCLUDED,
    tz: str = constants.LOCAL_ZONE,
    compare: str = "local",
    blocks: int | None = None,
) -> DataFrame:
    """Number ``n`` and sum ``seconds`` of the gaps that count, by ``STATION`` and also ``trip_date``."""
    if compare not in ("local", "instant"):
        raise ValueError("compare must be 'local' or 'instant'")
    ts = F.col("vehicle_timestamp")
    kept = positions.where(
        (F.col("direction") == direction) & F.col("stop_name").isNotNull() & ts.isNotNull())
    if excluded:
        kept = kept.where(~F.col("stop_name").isin(*excluded))
    reports = (kept.groupBy("stop_name", "stop_lat", "stop_lon", "trip_id", "vehicle_timestamp")
                   .agg(F.count(F.lit(1)).alias("copies"))
                   .withColumn("trip_date", temporal.local_date(ts, tz)))

    keys, order = ("stop_name", "trip_id", "trip_date"), ("vehicle_timestamp", "stop_lat", "stop_lon")
    lagged = with_previous(in_blocks(reports, keys, order, blocks=blocks), keys, order)
    previous = F.col("_previous")
    if compare == "local":
        # Same local date, so equal wall clocks are equal times of day.
        same = temporal.wall_clock(ts, tz) == temporal.wall_clock(previous, tz)
    else:
        same = ts == previous
    gaps = lagged.withColumn("gap", F.when(same, repeat_s)
                             .otherwise(temporal.whole_units("SECOND", ts, previous)))
    # The first copy of a report has the gap before it, each further copy is a repeat.
    first = F.col("gap") <= max_gap_s
    repeats = F.col("copies") - 1 if repeat_s <= max_gap_s else F.lit(0).cast("bigint")
    return (gaps.withColumn("n", F.when(first, 1).otherwise(0) + repeats)
                .withColumn("seconds", F.when(first, F.col("gap")).otherwise(0) + repeats * repeat_s)
                .groupBy(*by).agg(F.sum("n").alias("n"), F.sum("seconds").alias("seconds"))
                .where("n > 0"))


def idle_report(parts: DataFrame, *, carry: bool = False, order_by: str = "text") -> DataFrame:
    """``idle_parts`` by station as mean idle times."""
    per_station = (
        parts.withColumn("mean_s", F.col("seconds").cast("double") / F.col("n"))
             .withColumn("avg_idle_time_m_s",
                         temporal.minutes_seconds(F.col("mean_s"), carry=carry)))
    ordering = "mean_s" if order_by == "seconds" else "avg_idle_time_m_s"
    return (per_station.orderBy(F.desc(ordering), "stop_name")
                       .select("stop_name", "stop_lat", "stop_lon", "avg_idle_time_m_s"))


def positions_on_day(
    positions: DataFrame, service_date: str, *, tz: str = constants.LOCAL_ZONE
) -> DataFrame:
    """Reports whose local date is ``service_date``; the range is pushed to the scan.

    In a table stored by ``service_date``, as the live job writes it, other days' files are skipped.
    """
    if "service_date" in positions.columns and tz == constants.LOCAL_ZONE:
        positions = positions.where(F.col("service_date") == service_date)
    return positions.where(temporal.on_local_day(F.col("vehicle_timestamp"), service_date, tz))


def positions_between(
    positions: DataFrame, first_date: str, last_date: str, *, tz: str = constants.LOCAL_ZONE
) -> DataFrame:
    """Reports of the local dates from ``first_date`` to ``last_date``, both included."""
    if "service_date" in positions.columns and tz == constants.LOCAL_ZONE:
        positions = positions.where(F.col("service_date").between(first_date, last_date))
    return positions.where(
        temporal.on_local_day(F.col("vehicle_timestamp"), first_date, tz, last=last_date))


def first_arrivals(
    positions: DataFrame, *, service_date: str | None = None, tz: str = constants.LOCAL_ZONE
) -> DataFrame:
    """Earliest report per (station, local date, trip), whatever its status or direction."""
    if service_date is not None:
        positions = positions_on_day(positions, service_date, tz=tz)
    ts = F.col("vehicle_timestamp")
    return (positions.where(ts.isNotNull() & F.col("stop_name").isNotNull())
                     .groupBy("stop_name", temporal.local_date(ts, tz).alias("event_date"),
                              "trip_id")
                     .agg(F.min(ts).alias("trip_arrival_time")))


def _weighed(
    arrivals: DataFrame, *, max_minutes: int, dedupe_ties: bool = False, blocks: int | None = None
) -> DataFrame:
    """Instants of arrival that count: sum ``total`` and number ``n`` of their gaps, trips ``named``."""
    instants = (arrivals.groupBy("stop_name", "event_date", "trip_arrival_time")
                        .agg(F.count(F.lit(1)).cast("double").alias("k"),
                             F.count("trip_id").alias("named")))
    keys, order = ("stop_name", "event_date"), ("trip_arrival_time",)
    lagged = with_previous(in_blocks(instants, keys, order, blocks=blocks), keys, order)
    minutes = temporal.whole_units("MINUTE", F.col("trip_arrival_time"), F.col("_previous"))
    passes = F.col("minutes") <= max_minutes
    weight = F.lit(1.0) if dedupe_ties else F.col("k")
    ties = F.lit(0.0) if dedupe_ties or max_minutes < 0 else F.col("k") * (F.col("k") - 1)
    return (
        lagged.withColumn("minutes", minutes)
              .withColumn("n", F.when(passes, weight).otherwise(0.0) + ties)
              .where("n > 0")
              .withColumn("total", F.when(passes, F.col("minutes") * weight).otherwise(0.0)))


def headway_parts(
    positions: DataFrame,
    *,
    max_minutes: int = constants.HEADWAY_MAX_MINUTES,
    tz: str = constants.LOCAL_ZONE,
    dedupe_ties: bool = False,
    blocks: int | None = None,
) -> DataFrame:
    """Number ``n`` and sum ``total`` of the minutes between arrivals, and ``trips`` counted, by
    station and ``event_date``."""
    weighed = _weighed(first_arrivals(positions, tz=tz), max_minutes=max_minutes,
                       dedupe_ties=dedupe_ties, blocks=blocks)
    return weighed.groupBy("stop_name", "event_date").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("named").alias("trips"))


def headway(
    positions: DataFrame,
    *,
    service_date: str | None = None,
    max_minutes: int = constants.HEADWAY_MAX_MINUTES,
    tz: str = constants.LOCAL_ZONE,
    dedupe_ties: bool = False,
    approximate_trips: bool = False,
    blocks: int | None = None,
) -> DataFrame:
    """Mean whole minutes between consecutive arrivals, and trips seen, per station.

    The defining query lists every arrival with its gap and joins it back to the arrivals
    on (station, time) to regain the trips: ``k`` trips arriving together become ``k * k``
    rows, of which ``k`` carry the gap before them and the others a gap of 0. Only the
    sums are needed, so arrivals are counted per instant and weighted by ``k`` instead of
    joined; no pair of rows is ever made. ``dedupe_ties`` counts each instant once.

    With ``service_date`` a trip belongs to one row per station and trips are summed;
    over all dates they are counted distinct (or ``approximate_trips``).
    """
    arrivals = first_arrivals(positions, service_date=service_date, tz=tz)
    if service_date is None:
        # Used twice.
        arrivals = replace_table(arrivals, scratch_path(positions.sparkSession, "arrivals"), as_path=True)
    weighed = _weighed(arrivals, max_minutes=max_minutes, dedupe_ties=dedupe_ties, blocks=blocks)

    if service_date is not None:
        parts = weighed.select("stop_name", "total", "n", F.col("named").alias("trips"))
    else:
        # Null-safe keys: a plain join would filter both sides for nulls, each differently,
        # and the arrivals would be computed twice instead of shared.
        keys = ("stop_name", "event_date", "trip_arrival_time")
        passing = weighed.select(*[F.col(c).alias(f"_{c}") for c in keys])
        match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
        seen = arrivals.join(passing, match, "left_semi")
        count = F.approx_count_distinct if approximate_trips else F.count_distinct
        trips = seen.groupBy("stop_name").agg(count("trip_id").alias("trips"))
        # A union keeps one aggregation by station and needs no join.
        zero = F.lit(0.0)
        parts = (weighed.select("stop_name", "total", "n", F.lit(0).cast("bigint").alias("trips"))
                        .unionByName(trips.select("stop_name", zero.alias("total"),
                                                  zero.alias("n"), "trips")))
    return (parts.groupBy("stop_name")
                 .agg(F.round(F.sum("total") / F.sum("n"), 2)
                      .alias("average_min_difference_between_trains"),
                      F.sum("trips").alias("total_unique_trip_ids"))
                 .orderBy(F.desc("average_min_difference_between_trains"), "stop_name"))


def busiest(
    positions: DataFrame,
    *,
    service_date: str | None = None,
    weekdays_only: bool = True,
    top: int = constants.BUSIEST_TOP,
    tz: str = constants.LOCAL_ZONE,
) -> DataFrame:
    """The ``top`` stations by number of train arrivals, on one date or on all weekdays."""
    arrivals = first_arrivals(positions, service_date=service_date, tz=tz)
    if service_date is None and weekdays_only:
        arrivals = arrivals.where(F.dayofweek("event_date").between(2, 6))
    return (arrivals.groupBy("stop_name")
                    .agg(F.count(F.lit(1)).alias("total_arrivals"))
                    .orderBy(F.desc("total_arrivals"), "stop_name")
                    .limit(top))
