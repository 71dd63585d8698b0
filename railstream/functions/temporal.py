"""Instants, local dates and wall clocks as column expressions.

Instants are ``timestamp`` columns in a UTC session (see ``railstream.session``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railstream.constants import LOCAL_ZONE

# First and last epoch second of the years 1 to 9999.
_FIRST_SECOND = -62135596800
_LAST_SECOND = 253402300799


def wall_clock(ts: Column, tz: str = LOCAL_ZONE) -> Column:
    """Instant -> local date and time without a zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ts.cast("timestamp_ntz"))


def local_date(ts: Column, tz: str = LOCAL_ZONE) -> Column:
    return F.to_date(wall_clock(ts, tz))


def local_time(ts: Column, tz: str = LOCAL_ZONE) -> Column:
    """Instant -> local time of day, as text ``HH:mm:ss.SSSSSS``."""
    return F.date_format(wall_clock(ts, tz), "HH:mm:ss.SSSSSS")


def day_start(day: Column, tz: str = LOCAL_ZONE) -> Column:
    """Local date -> instant at which it begins."""
    return F.to_utc_timestamp(day.cast("timestamp"), tz)


def on_local_day(ts: Column, day: str, tz: str = LOCAL_ZONE, *, last: str | None = None) -> Column:
    """True for instants on the local date ``day`` (``YYYY-MM-DD``), or from it to the date ``last``.

    A half-open range over the bare column, so that it reaches the Parquet scan; a
    function around the column would not.
    """
    first, end = (F.lit(d).cast("date") for d in (day, last or day))
    return (ts >= day_start(first, tz)) & (ts < day_start(F.date_add(end, 1), tz))


def repeated_seconds(day: Column, tz: str = LOCAL_ZONE) -> Column:
    """Seconds of wall clock that occur twice on a local date (0 on all but one day a year)."""
    length = F.unix_seconds(day_start(F.date_add(day, 1), tz)) - F.unix_seconds(day_start(day, tz))
    return F.greatest(length - F.lit(86400), F.lit(0))


def whole_units(unit: str, later: Column, earlier: Column) -> Column:
    """``later - earlier`` in whole ``SECOND``/``MINUTE`` units, truncated towards zero."""
    return F.timestamp_diff(unit, earlier, later)


def epoch_text(text: Column) -> Column:
    """Epoch seconds as text -> instant; NULL when empty, not a number or outside years 1 to 9999."""
    seconds = text.try_cast("bigint")
    return F.when(seconds.between(_FIRST_SECOND, _LAST_SECOND), F.timestamp_seconds(seconds))


def minutes_seconds(seconds: Column, *, carry: bool = False) -> Column:
    """Mean seconds -> ``M:SS``.

    Minutes come from the unrounded value and seconds from the rounded one, so 119.6 gives
    ``1:00``. With ``carry`` both come from the rounded value (``2:00``).
    """
    rounded = F.round(seconds).cast("bigint")
    minutes = F.floor((rounded if carry else seconds) / F.lit(60)).cast("bigint")
    return F.concat(minutes.cast("string"), F.lit(":"),
                    F.lpad((rounded % F.lit(60)).cast("string"), 2, "0"))


def is_rush_hour(hour: Column) -> Column:
    """1 from 7:00 to 9:59 and from 16:00 to 19:59, otherwise 0."""
    return F.when(hour.between(7, 9) | hour.between(16, 19), 1).otherwise(0)


def is_weekend(day_of_week: Column) -> Column:
    """1 on Sunday (1) and Saturday (7), otherwise 0."""
    return F.when(day_of_week.isin(1, 7), 1).otherwise(0)


def csv_timestamp(text: Column) -> Column:
    """Timestamp text of a CSV file (ISO form or epoch seconds) -> instant, NULL when unreadable."""
    iso = F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("timestamp"))
    return F.coalesce(iso, epoch_text(text))
