"""Training data from ``events``; the target stop is ``purchase``."""

from __future__ import annotations

from pyspark.sql import functions as F

from railstream.operators import samples as ops
from railstream.plans import adapters
from railstream.plans.registry import PREPARED, SAMPLES, STOPS, query
from railstream.session import scratch_path
from railstream.sources.tables import replace_table

_TARGET = "purchase"
_KEYS = ("trip_uid", "target_sequence")


def _prepared(spark, sf_dir):
    return ops.prepare_stop_times(adapters.stop_times(adapters.table(spark, sf_dir, "events")))


def _samples(spark, sf_dir, method="window"):
    return ops.context_windows(_prepared(spark, sf_dir), target_stop=_TARGET, method=method)


def _stored(spark, sf_dir):
    """Samples and split dates; the samples are stored, as both uses read all of them."""
    samples = replace_table(_samples(spark, sf_dir), scratch_path(spark, "samples"), as_path=True)
    return samples, ops.split_dates(samples)


_PREPARED_COLUMNS = """trip_uid, start_time_dts, route_id, direction, stop_id, stop_name, stop_lat,
  stop_lon, arrival_time, departure_time, arrival_time_nyc, stop_sequence, minutes_since_prev_stop,
  hour_of_day, day_of_week, trip_date, is_rush_hour, is_weekend"""


@query("prepare_stop_times", f"SELECT {_PREPARED_COLUMNS} FROM ({PREPARED})", dates=("trip_date",))
def prepare_stop_times(spark, sf_dir):
    return adapters.plain(_prepared(spark, sf_dir))


@query("raw_stop_times", f"""WITH trips AS (SELECT CAST(user_id AS VARCHAR) AS trip_uid,
  min(ts) AS start_time_dts FROM events GROUP BY user_id), stops AS ({STOPS})
SELECT CAST(user_id AS VARCHAR) AS trip_uid, start_time_dts, 'E' AS route_id, 'S' AS direction,
  'A' || event_id % 120 AS stop_id, stop_name, stop_lat, stop_lon, ts AS arrival_time,
  date_trunc('second', ts) + INTERVAL 30 SECOND AS departure_time
FROM events JOIN trips ON trip_uid = CAST(user_id AS VARCHAR)
  LEFT JOIN stops ON stop_id = 'A' || event_id % 120""")
def raw_stop_times(spark, sf_dir):
    events = adapters.table(spark, sf_dir, "events")
    return adapters.plain(ops.build_raw_stop_times(
        adapters.sensor_data(events), adapters.trips(events),
        adapters.stops(adapters.table(spark, sf_dir, "supplier"))))


_CONTEXT_SQL = SAMPLES + """SELECT * EXCLUDE (context_stops), array_to_string(list_transform(
  context_stops, lambda s: s.stop_sequence || '/' || s.stop_name || '/' || epoch_us(s.arrival_time)
    || '/' || s.hour_of_day || s.day_of_week || s.is_rush_hour || s.is_weekend), '|') AS context
FROM samples"""


def _context_text(samples):
    context = F.array_join(F.transform("context_stops", lambda s: F.concat_ws(
        "/", s["stop_sequence"], s["stop_name"], F.unix_micros(s["arrival_time"]),
        F.concat(s["hour_of_day"], s["day_of_week"], s["is_rush_hour"], s["is_weekend"]))), "|")
    return adapters.plain(samples.withColumn("context", context).drop("context_stops"))


@query("context_windows", _CONTEXT_SQL, dates=("trip_date",))
def context_windows(spark, sf_dir):
    return _context_text(_samples(spark, sf_dir))


@query("context_windows_join", _CONTEXT_SQL, dates=("trip_date",))
def context_windows_join(spark, sf_dir):
    return _context_text(_samples(spark, sf_dir, "join"))


_FLAT_SQL = ", ".join(f"context_stops[{i + 1}].{attribute} AS ctx{i}_{name}"
                      for i in range(5) for name, attribute in ops.FEATURES.items())


@query("flat_context_features", SAMPLES + f"""SELECT trip_uid, target_sequence,
  target_minutes_from_prev, {_FLAT_SQL} FROM samples""")
def flat_context_features(spark, sf_dir):
    return ops.flatten_context(_samples(spark, sf_dir), keep=_KEYS)


_CELLS_SQL = ", ".join(f"CAST(s.{a} AS FLOAT)" for a in ops.FEATURES.values())


@query("context_matrix", SAMPLES + f"""SELECT trip_uid, target_sequence,
  CAST(CAST(target_minutes_from_prev AS FLOAT) AS DOUBLE) AS y, step, feature,
  CAST(x[step][feature] AS DOUBLE) AS cell
FROM (SELECT *, list_transform(context_stops, lambda s: [{_CELLS_SQL}]) AS x FROM samples),
  (SELECT unnest(generate_series(1, 5)) AS step), (SELECT unnest(generate_series(1, 8)) AS feature)""")
def context_matrix(spark, sf_dir):
    matrix = ops.to_matrix(_samples(spark, sf_dir), keep=_KEYS)
    steps = matrix.select(*_KEYS, F.col("y").cast("double").alias("y"),
                          F.posexplode("x").alias("step", "row"))
    return (steps.select(*_KEYS, "y", (F.col("step") + 1).alias("step"),
                         F.posexplode("row").alias("feature", "cell"))
                 .withColumn("feature", F.col("feature") + 1)
                 .withColumn("cell", F.col("cell").cast("double")))


@query("split_dates", SAMPLES + "SELECT * FROM dates",
       dates=("min_date", "max_date", "train_end_date", "val_end_date"))
def split_dates(spark, sf_dir):
    return ops.split_dates(_samples(spark, sf_dir))


_SPLIT_SQL = SAMPLES + """, split AS (SELECT samples.*, CASE WHEN trip_date <= train_end_date
  THEN 'train' WHEN trip_date <= val_end_date THEN 'val' ELSE 'test' END AS split
  FROM samples, dates WHERE trip_date >= min_date AND trip_date <= max_date) """


@query("assign_split", _SPLIT_SQL + "SELECT trip_uid, target_sequence, trip_date, split FROM split",
       dates=("trip_date",))
def assign_split(spark, sf_dir):
    return ops.assign_split(*_stored(spark, sf_dir)).select(*_KEYS, "trip_date", "split")


@query("split_counts", _SPLIT_SQL + """SELECT split, count(*) AS n_samples,
  round(avg(target_minutes_from_prev), 6) AS mean_target_minutes FROM split GROUP BY split""")
def split_counts(spark, sf_dir):
    return ops.split_counts(*_stored(spark, sf_dir))


@query("split_summary", _SPLIT_SQL + f"""SELECT unnest(generate_series(1, 16)) AS ord, unnest([
  '{"═" * 51}', 'DATA SPLIT SUMMARY', '{"═" * 51}', '',
  'Full date range: ' || min_date || ' to ' || max_date, 'Total days: ' || total_days, '',
  'TRAIN:      ' || min_date || ' to ' || train_end_date,
  'VALIDATION: ' || (train_end_date + 1) || ' to ' || val_end_date,
  'TEST:       ' || (val_end_date + 1) || ' to ' || max_date, '', '--- Sample Counts ---',
  'Train samples: ' || (SELECT count(*) FROM split WHERE split = 'train'),
  'Val samples: ' || (SELECT count(*) FROM split WHERE split = 'val'),
  'Test samples: ' || (SELECT count(*) FROM split WHERE split = 'test'),
  '{"═" * 51}']) AS info FROM dates""")
def split_summary(spark, sf_dir):
    return ops.split_summary(*_stored(spark, sf_dir))


def _read(split: str):
    @query(f"{split}_split_read", _SPLIT_SQL + f"""SELECT target_minutes_from_prev, {_FLAT_SQL}
FROM split WHERE split = '{split}'""")
    def read(spark, sf_dir):
        return ops.read_split(*_stored(spark, sf_dir), split)
    return read


train_split_read, val_split_read, test_split_read = map(_read, ("train", "val", "test"))


@query("shuffled_samples", SAMPLES + """SELECT trip_uid, target_sequence, target_minutes_from_prev
FROM samples""")
def shuffled_samples(spark, sf_dir):
    return ops.shuffle_samples(_samples(spark, sf_dir), seed=7).select(
        *_KEYS, "target_minutes_from_prev")
