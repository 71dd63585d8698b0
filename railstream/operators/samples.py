"""Training data: enriched stop times -> features -> context windows -> split -> matrix."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railstream import constants, schemas
from railstream.constants import FEATURES
from railstream.functions import temporal
from railstream.functions.slices import HOME, SLICE, in_blocks, with_halo, with_previous

# Copies of one row written out by a single task (see prepare_stop_times).
_COPIES_PER_TASK = 1_000_000

# Attributes of a context stop, in order.
CONTEXT_FIELDS = ("stop_sequence", "stop_name", "stop_lat", "stop_lon", "arrival_time",
                  "minutes_since_prev_stop", "hour_of_day", "day_of_week", "is_rush_hour",
                  "is_weekend")


def build_raw_stop_times(
    sensor_data: DataFrame, trips: DataFrame, stops: DataFrame
) -> DataFrame:
    """Stop observations + trip attributes + stop attributes -> ``schemas.STOP_TIMES``.

    The layout of the result is given, the way to it is an assumption: observations
    without a known trip are left out, those without a known stop keep NULL attributes.
    ``trips`` has one row per ``trip_uid``, ``stops`` one per ``stop_id``. The join method
    is Spark's choice; it splits a hot trip or stop at run time. Observations without a stop id
    get a made-up key each, which finds nothing, so that they do not meet in one task.
    """
    nobody = F.concat_ws("-", F.lit("\0"), F.xxhash64("trip_uid", "arrival_time").cast("string"))
    found = stops.select(F.col("stop_id").alias("_key"), "stop_name", "stop_lat", "stop_lon")
    joined = (sensor_data.join(trips.select("trip_uid", "start_time_dts", "route_id", "direction"),
                               "trip_uid")
                         .withColumn("_key", F.coalesce("stop_id", nobody))
                         .join(found, "_key", "left"))
    return joined.select(*[f.name for f in schemas.STOP_TIMES.fields])


def prepare_stop_times(
    stop_times: DataFrame,
    *,
    route_id: str = constants.SAMPLE_ROUTE,
    direction: str = constants.SAMPLE_DIRECTION,
    tz: str = constants.LOCAL_ZONE,
    blocks: int | None = None,
) -> DataFrame:
    """Number the stops of each trip by arrival and add gap and calendar features.

    Only rows of the route and direction with arrival time and coordinates are numbered.
    Ties are ordered by stop id, then by the remaining columns.

    Numbering is done in two levels, so that no task holds a whole trip: identical rows are
    counted first, the counted rows are stored in ``blocks`` by trip and order, each block is
    ordered by itself, and one small row per block adds the number of rows before it and the
    last arrival before it (see ``functions.slices``). Copies become rows again at the end, in
    lots of bounded size that are spread over tasks.
    """
    names = [f.name for f in schemas.STOP_TIMES.fields]
    wanted = stop_times.where(
        (F.col("route_id") == route_id) & (F.col("direction") == direction)
        & F.col("arrival_time").isNotNull()
        & F.col("stop_lat").isNotNull() & F.col("stop_lon").isNotNull()).select(*names)
    counted = wanted.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    rest = [n for n in names if n not in ("trip_uid", "arrival_time", "stop_id")]
    keys, order = ["trip_uid"], ["arrival_time", "stop_id", *rest]
    numbered = with_previous(in_blocks(counted, keys, order, blocks=blocks), keys, order, "_n")
    lots = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / _COPIES_PER_TASK))
    start = F.col("_lot") * _COPIES_PER_TASK
    stop = F.least(start + _COPIES_PER_TASK, F.col("_n")) - 1
    copies = (numbered.select(*names, "_n", "_previous", (F.col("_before") + 1).alias("_first"),
                              F.explode(lots).alias("_lot")).hint("rebalance")
              .select("*", F.explode(F.sequence(start, stop)).alias("_copy")))

    arrival, local = F.col("arrival_time"), F.col("arrival_time_nyc")
    before = F.when(F.col("_copy") == 0, F.col("_previous")).otherwise(arrival)
    gap = temporal.whole_units("SECOND", arrival, before) / F.lit(60.0)
    hour, day = F.hour(local), F.dayofweek(local)
    return (copies
            .select(*names, temporal.wall_clock(arrival, tz).alias("arrival_time_nyc"),
                    (F.col("_first") + F.col("_copy")).alias("stop_sequence"),
                    gap.alias("minutes_since_prev_stop"))
            .select("*", hour.alias("hour_of_day"), day.alias("day_of_week"),
                    F.to_date(local).alias("trip_date"),
                    temporal.is_rush_hour(hour).alias("is_rush_hour"),
                    temporal.is_weekend(day).alias("is_weekend")))


def _target_columns() -> list[Column]:
    return [F.col("trip_uid"), F.col("start_time_dts"),
            F.col("stop_name").alias("target_stop_name"),
            F.col("arrival_time").alias("target_arrival_time"),
            F.col("stop_sequence").alias("target_sequence"),
            F.col("minutes_since_prev_stop").alias("target_minutes_from_prev"),
            F.col("hour_of_day"), F.col("day_of_week"), F.col("trip_date"),
            F.col("is_rush_hour"), F.col("is_weekend")]


def context_windows(
    prepared: DataFrame,
    *,
    target_stop: str = constants.SAMPLE_TARGET_STOP,
    k: int = constants.SAMPLE_CONTEXT_STOPS,
    method: str = "window",
    slice_rows: int = 1000,
) -> DataFrame:
    """One sample per arrival at ``target_stop``, with the ``k`` stops before it as an array.

    Arrivals with fewer than ``k`` stops before them, or without a trip id, give no sample.
    ``stop_sequence`` has to be gap-free within a trip, as ``prepare_stop_times`` makes it.

    ``method="window"`` shuffles once: a trip is cut into blocks of ``slice_rows`` stops with
    ``k`` rows of halo, so a window partition has at most ``slice_rows + k`` rows.
    ``method="join"`` looks up the ``k`` preceding numbers of each target by an equi-join on
    (trip, number); it reads less when targets are rare and the table is bucketed that way.
    """
    rows = prepared.where(F.col("trip_uid").isNotNull())
    stop = F.struct(*CONTEXT_FIELDS)
    if method == "window":
        sliced = with_halo(rows, F.col("stop_sequence") - 1, F.lit(k), slice_rows)
        order = Window.partitionBy("trip_uid", SLICE).orderBy("stop_sequence")
        steps = [F.lag(stop, k - i).over(order).alias(f"_step{i}") for i in range(k)]
        return (sliced.select("*", *steps)
                .where(F.col(HOME) & (F.col("stop_name") == target_stop)
                       & (F.col("stop_sequence") > k))
                .select(*_target_columns(),
                        F.array(*[F.col(f"_step{i}") for i in range(k)]).alias("context_stops")))
    if method != "join":
        raise ValueError("method must be 'window' or 'join'")
    targets = (rows.where(F.col("stop_name") == target_stop)
                   .select(*_target_columns())
                   .withColumn("_number", F.explode(F.sequence(
                       F.col("target_sequence") - k, F.col("target_sequence") - 1))))
    stops = rows.select(F.col("trip_uid").alias("_t"), F.col("stop_sequence").alias("_number"),
                        stop.alias("_stop"))
    keys = ["trip_uid", "target_sequence"]
    carried = [c for c in targets.columns if c not in (*keys, "_number")]
    return (targets.join(stops.withColumnRenamed("_t", "trip_uid"), ["trip_uid", "_number"])
            .groupBy(*keys)
            .agg(*[F.first(c).alias(c) for c in carried],
                 F.sort_array(F.collect_list("_stop")).alias("context_stops"))
            .where(F.size("context_stops") == k)
            .select(*[c for c in targets.columns if c != "_number"], "context_stops"))


def split_dates(
    samples: DataFrame,
    *,
    train: float = constants.SPLIT_TRAIN_SHARE,
    validation: float = constants.SPLIT_VALIDATION_SHARE,
) -> DataFrame:
    """One row: first and last date, days between, last training and validation date."""
    def after(share: float) -> Column:
        return F.date_add(F.col("min_date"),
                          F.round(F.col("total_days") * F.lit(share)).cast("int"))

    return (samples.agg(F.min("trip_date").alias("min_date"), F.max("trip_date").alias("max_date"))
                   .withColumn("total_days", F.datediff("max_date", "min_date"))
                   .withColumn("train_end_date", after(train))
                   .withColumn("val_end_date", after(validation)))


def _bounds(dates: DataFrame) -> Column:
    """The one row of split dates as a scalar subquery: no join, evaluated once."""
    return dates.select(F.struct("*").alias("b")).scalar()


def assign_split(samples: DataFrame, dates: DataFrame) -> DataFrame:
    """Add ``split``: ``train``, ``val`` or ``test`` (NULL without a date).

    Training ends with the last training date, validation with the last validation date,
    both included.
    """
    day = F.col("trip_date")
    return (samples.withColumn("_b", _bounds(dates))
                   .withColumn("split", F.when(day <= F.col("_b.train_end_date"), "train")
                               .when(day <= F.col("_b.val_end_date"), "val")
                               .when(day > F.col("_b.val_end_date"), "test"))
                   .drop("_b"))


def split_counts(samples: DataFrame, dates: DataFrame) -> DataFrame:
    """Samples and mean label per split, in one pass; only dates within the split dates count."""
    day = F.col("trip_date")
    inside = (samples.withColumn("_b", _bounds(dates))
                     .where(day.between(F.col("_b.min_date"), F.col("_b.max_date")))
                     .drop("_b"))
    return (assign_split(inside, dates).groupBy("split")
            .agg(F.count(F.lit(1)).alias("n_samples"),
                 F.round(F.avg("target_minutes_from_prev"), 6).alias("mean_target_minutes")))


def split_summary(samples: DataFrame, dates: DataFrame) -> DataFrame:
    """The split as a 16-line text report: ``ord`` and ``info``, in order."""
    counts = {s: F.coalesce(F.sum(F.when(F.col("split") == s, F.col("n_samples"))), F.lit(0))
              for s in ("train", "val", "test")}
    facts = (split_counts(samples, dates)
             .agg(*[c.alias(s) for s, c in counts.items()])
             .withColumn("b", _bounds(dates))
             .select("*", "b.*",
                     F.date_add("b.train_end_date", 1).alias("val_start_date"),
                     F.date_add("b.val_end_date", 1).alias("test_start_date")))

    def filled(line: str) -> Column:
        # Every second piece is a name in braces.
        pieces = re.split(r"\{(\w+)\}", line)
        return F.concat(*[F.col(p).cast("string") if i % 2 else F.lit(p)
                          for i, p in enumerate(pieces)])

    entries = F.array(*[F.struct(F.lit(i).alias("ord"), filled(line).alias("info"))
                        for i, line in enumerate(constants.SPLIT_SUMMARY, 1)])
    return facts.select(F.inline(entries)).orderBy("ord")


def read_split(
    samples: DataFrame, dates: DataFrame, split: str, *, k: int = constants.SAMPLE_CONTEXT_STOPS
) -> DataFrame:
    """Flat feature rows of one split, sorted by date and trip.

    The sort continues with the target's number, so that one large trip is spread over
    several ranges. The date bounds reach the scan of the samples table as a filter.
    """
    train_end = dates.select("train_end_date").scalar()
    val_end = dates.select("val_end_date").scalar()
    day = F.col("trip_date")
    wanted = {
        "train": day <= train_end,
        "val": (day > train_end) & (day <= val_end),
        "test": day > val_end,
    }[split]
    kept = samples.where(wanted)
    return flatten_context(kept.orderBy("trip_date", "trip_uid", "target_sequence"), k=k)


def flatten_context(
    samples: DataFrame, *, k: int = constants.SAMPLE_CONTEXT_STOPS, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Label and ``k`` x 8 columns ``ctx{i}_{feature}``; ``keep`` names further columns."""
    flat = [F.col("context_stops")[i][attribute].alias(f"ctx{i}_{name}")
            for i in range(k) for name, attribute in FEATURES.items()]
    return samples.select(*keep, "target_minutes_from_prev", *flat)


def to_matrix(
    samples: DataFrame, *, fill: float | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``x``: array of ``k`` arrays of 8 floats, ``y``: the label.

    The first stop of a trip has no gap; its cell stays NULL unless ``fill`` is given.
    """
    def cell(step: Column, attribute: str) -> Column:
        value = step[attribute].cast("float")
        return value if fill is None else F.coalesce(value, F.lit(fill).cast("float"))

    matrix = F.transform("context_stops",
                         lambda s: F.array(*[cell(s, a) for a in FEATURES.values()]))
    return samples.select(*keep, matrix.alias("x"),
                          F.col("target_minutes_from_prev").cast("float").alias("y"))


def shuffle_samples(samples: DataFrame, *, seed: int = 0) -> DataFrame:
    """All samples in a random but repeatable order."""
    return samples.orderBy(F.xxhash64(F.lit(seed), "trip_uid", "target_sequence"),
                           "trip_uid", "target_sequence")
