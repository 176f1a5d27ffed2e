"""Observation lists keyed by (airport, date) for the bucketed interval join.

A trip at time ``t`` needs the readings in ``(t - 12h, t]``.  Filing every
reading under its own date and, when it is in the last 12 hours of its day,
also under the next date turns that interval predicate into an equi-join on
(airport, date): date ``D``'s list holds the 24 readings of ``D`` plus hours
12..23 of ``D - 1`` — 36 when the day is complete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerowx.functions.timecols import observation_dates
from aerowx.schemas import OBS_FIELDS

def full_day(hours: int) -> int:
    """Readings of a complete list: the day's 24 and the ``hours`` before it."""
    if not 1 <= hours <= 24:
        raise ValueError(f"hours is between 1 and 24 (lists reach back one day), not {hours}")
    return 24 + hours


def observation_keys(obs: DataFrame, hours: int = 12) -> DataFrame:
    """Each observation once per date it serves (1 -> 1 or 2 rows)."""
    return obs.withColumn("obs_date", F.explode(observation_dates("Weather_TIMESTAMP", hours)))


def observation_lists(obs: DataFrame, hours: int = 12) -> DataFrame:
    """(AIRPORT_ID, obs_date, Weather_List) — the list sorted by time.

    The record's first field is AIRPORT_ID (constant inside a group) and
    its second the timestamp, so the natural struct order is time order.
    Groups are bounded by ``24 + hours`` hourly readings, so
    ``collect_list`` cannot grow with the data."""
    k = observation_keys(obs, hours)
    return (k.groupBy("AIRPORT_ID", "obs_date")
             .agg(F.array_sort(F.collect_list(F.struct(*OBS_FIELDS))).alias("Weather_List")))


def complete(lists: DataFrame, hours: int = 12) -> DataFrame:
    """Keep keys whose list has one reading for each hour from ``hours``
    before the day to its end: as many as that, no two alike, the first and
    the last in place.  (A doubled hour beside a missing one is not
    complete.)"""
    n = full_day(hours)
    times = F.col("Weather_List.Weather_TIMESTAMP")
    day = F.col("obs_date").cast("timestamp_ntz")
    return lists.where((F.size("Weather_List") == n) & (F.size(F.array_distinct(times)) == n)
                       & (times[0] == day - F.make_dt_interval(F.lit(0), F.lit(hours)))
                       & (times[n - 1] == day + F.make_dt_interval(F.lit(0), F.lit(23))))


def complete_lists(obs: DataFrame, hours: int = 12) -> DataFrame:
    """``complete(observation_lists(obs, hours), hours)`` for observations on
    the hour, from one aggregate.

    Whether a key is complete is told by numbers beside the list (readings,
    and a bit for each hour present), so a plan that needs only the keys, as
    the live feature set's does, collects and ships no reading."""
    n = full_day(hours)
    ts, day = F.col("Weather_TIMESTAMP"), F.col("obs_date")
    at = F.hour(ts) + F.lit(24) * F.datediff(F.to_date(ts), day) + F.lit(hours)
    k = observation_keys(obs, hours).withColumn("_bit", F.call_function("shiftleft", F.lit(1).cast("long"), at))
    lists = k.groupBy("AIRPORT_ID", "obs_date").agg(
        F.array_sort(F.collect_list(F.struct(*OBS_FIELDS))).alias("Weather_List"),
        F.count(F.lit(1)).alias("_n"), F.bit_or("_bit").alias("_hours"))
    return lists.where((F.col("_n") == n) & (F.col("_hours") == F.lit((1 << n) - 1).cast("long"))).drop("_n", "_hours")


def complete_days(obs: DataFrame, hours: int = 12) -> DataFrame:
    """(AIRPORT_ID, obs_date) keys with a complete list of hourly
    observations — counts only, no arrays."""
    return (observation_keys(obs, hours).groupBy("AIRPORT_ID", "obs_date")
            .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == full_day(hours)).drop("_n"))
