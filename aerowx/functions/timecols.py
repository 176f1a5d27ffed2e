"""Wall-clock time construction as built-in column expressions.

All timestamps are ``TIMESTAMP_NTZ`` (airport-local wall clock): no session
zone or daylight-saving rule can move or merge hours.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_date(date_col) -> Column:
    """DATE -> ``yyyy-MM-dd`` text."""
    return F.date_format(_c(date_col), "yyyy-MM-dd")


def split_hhmm(hhmm) -> tuple[Column, Column]:
    """Integer ``hhmm`` -> (hour, minute): ``hhmm div 100``, ``hhmm % 100``."""
    c = _c(hhmm)
    return (c / 100).cast("int"), (c % 100).cast("int")


def departure_ts(date_col, hhmm) -> Column:
    """Date + ``hhmm`` (zero padded to 4 digits) -> NTZ timestamp.

    An ``hhmm`` that does not parse as ``HHmm`` (hour 24, minute >= 60,
    negative) gives null, as a failed parse does.
    """
    hh, mm = split_hhmm(hhmm)
    c = _c(hhmm)
    valid = (c >= 0) & (hh <= 23) & (mm <= 59)
    midnight = _c(date_col).cast("timestamp_ntz")
    return F.when(valid, midnight + F.make_dt_interval(F.lit(0), hh, mm, F.lit(0)))


def to_seconds(col, unit_seconds: int) -> Column:
    """A duration in ``unit_seconds`` units -> whole seconds, truncated; NaN and
    what is too large give null."""
    return (_c(col) * unit_seconds).try_cast("long")


def arrival_ts(dep_ts, elapsed_minutes, tz_shift_hours) -> Column:
    """Departure + scheduled minutes + time-zone difference (hours).

    Both durations are truncated to whole seconds separately, then added.
    """
    secs = to_seconds(elapsed_minutes, 60) + to_seconds(tz_shift_hours, 3600)
    return _c(dep_ts) + F.make_dt_interval(secs=secs)


def weather_ts(date_int, hour) -> Column:
    """Integer ``yyyyMMdd`` + hour -> NTZ timestamp at minute 0.

    A date that does not exist or an hour outside 0..23 gives null.
    """
    d = F.try_to_date(_c(date_int).cast("string"), "yyyyMMdd")
    h = _c(hour)
    return F.when((h >= 0) & (h <= 23),
                  d.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), h))


def obs_date(ts) -> Column:
    """Join key date of a timestamp."""
    return F.to_date(_c(ts))


def observation_dates(ts, hours: int = 12) -> Column:
    """Dates a reading is filed under: its own date, and the next date when
    ``ts + hours`` falls on it (readings in the last ``hours`` of a day also
    serve the following day's windows)."""
    t = _c(ts)
    return F.array_distinct(F.array(F.to_date(t),
                                    F.to_date(t + F.make_dt_interval(F.lit(0), F.lit(hours)))))


def week_of_month(ts) -> Column:
    """Pattern field ``F`` (aligned day-of-week-in-month): ((day - 1) mod 7) + 1."""
    return ((F.dayofmonth(_c(ts)) - 1) % 7 + 1).cast("int")


def hour_of(ts) -> Column:
    return F.hour(_c(ts)).cast("int")
