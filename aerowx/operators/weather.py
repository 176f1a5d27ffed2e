"""Station readings: cleaning, daily means, imputation, one reading per hour.

The plan (``hourly_observations``) drops exact copies of a reading with a hash
aggregate, partly in each task, before the single (airport, date) exchange;
one sort behind it then serves the minute, the day's means and the hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerowx.functions.timecols import split_hhmm, weather_ts
from aerowx.functions.weathercols import (precip, sky_condition, to_double,
                                          weather_type, wind_speed)
from aerowx.operators.clean import dedup_by
from aerowx.operators.stations import weather_by_airport
from aerowx.schemas import OBS_FIELDS

READING_COLUMNS = ["WBAN", "Date", "Time", "DryBulbCelsius", "SkyCondition",
                   "Visibility", "WeatherType", "WindSpeed", "HourlyPrecip"]
MEASURES = ["DryBulbCelsius", "SkyCondition", "Visibility", "WindSpeed",
            "WeatherType", "HourlyPrecip"]
READING_KEYS = ["AIRPORT_ID", "Date", "Time_hh", "Time_mm"]
DAY_KEYS = ["AIRPORT_ID", "Date"]
MEAN_COLUMNS = {"DryBulbCelsius": "average_temperature",
                "WindSpeed": "average_windspeed",
                "Visibility": "average_visibility",
                "HourlyPrecip": "average_hourlyprecip"}


def project_weather(weather: DataFrame) -> DataFrame:
    return weather.select(*READING_COLUMNS)


def clean_readings(weather: DataFrame, airports: DataFrame) -> DataFrame:
    """Readings per served airport with sentinel-free typed measures and
    the time split into hour / minute."""
    w = weather_by_airport(project_weather(weather), airports)
    hh, mm = split_hhmm("Time")
    return w.select(
        "AIRPORT_ID", "Date", "Time",
        to_double("DryBulbCelsius").alias("DryBulbCelsius"),
        sky_condition("SkyCondition").alias("SkyCondition"),
        to_double("Visibility").alias("Visibility"),
        wind_speed("WindSpeed").alias("WindSpeed"),
        weather_type("WeatherType").alias("WeatherType"),
        precip("HourlyPrecip").alias("HourlyPrecip"),
        hh.alias("Time_hh"), mm.alias("Time_mm"))


def dedup_readings(w: DataFrame, partitions: int | None = None) -> DataFrame:
    """One reading per airport, date, hour and minute (smallest by the
    measure values, nulls first, so the choice is deterministic), hashed by
    airport and date and sorted by minute.

    Copies go first, by a hash aggregate that reduces in each task, so a
    flood of one reading never meets in a task.  Readings of one minute that
    differ meet in their day's task, where they are sorted and streamed."""
    copies_gone = w.distinct()
    by_day = (copies_gone.repartition(partitions, *DAY_KEYS) if partitions
              else copies_gone.repartition(*DAY_KEYS))
    minute = Window.partitionBy(*READING_KEYS).orderBy(*[F.asc_nulls_first(c) for c in MEASURES + ["Time"]])
    return by_day.withColumn("_place", F.row_number().over(minute)).where(F.col("_place") == 1).drop("_place")


ZERO_FILLED = ["DryBulbCelsius", "SkyCondition", "Visibility", "WindDirection", "WindSpeed", "WeatherType",
               "StationPressure"]


def impute_zero(weather: DataFrame, airports: DataFrame) -> DataFrame:
    """The simpler cleaning: raw measures to numbers, what is missing or does
    not parse (variable wind too) to 0, the missing code of a text to empty,
    and one reading per minute.  Takes raw readings with wind direction and
    station pressure."""
    w = weather_by_airport(weather.select("WBAN", "Date", "Time", *ZERO_FILLED), airports)
    hh, mm = split_hhmm("Time")
    whole = lambda c: F.coalesce(to_double(c).try_cast("int"), F.lit(0)).alias(c)
    real = lambda c: F.coalesce(to_double(c), F.lit(0.0)).alias(c)
    w = w.select("AIRPORT_ID", "Date", "Time", hh.alias("Time_hh"), mm.alias("Time_mm"),
                 real("DryBulbCelsius"), weather_type("SkyCondition").alias("SkyCondition"), real("Visibility"),
                 whole("WindDirection"), whole("WindSpeed"), weather_type("WeatherType").alias("WeatherType"),
                 real("StationPressure"))
    return dedup_by(w, READING_KEYS, order=ZERO_FILLED + ["Time"])


def complete_case(w: DataFrame) -> DataFrame:
    """Readings with every averaged measure present and a definite wind."""
    return w.where((F.col("WindSpeed") != -1) & F.col("DryBulbCelsius").isNotNull()
                   & F.col("WindSpeed").isNotNull() & F.col("HourlyPrecip").isNotNull()
                   & F.col("Visibility").isNotNull())


def daily_mean(w: DataFrame) -> DataFrame:
    """Mean temperature, wind, visibility and rain per airport-day over
    complete-case readings (variable wind excluded)."""
    return (complete_case(w).groupBy(*DAY_KEYS)
            .agg(*[F.avg(c).alias(a) for c, a in MEAN_COLUMNS.items()]))


def impute(w: DataFrame, means: DataFrame) -> DataFrame:
    """Inner-join the day's means (airport-days without a complete-case
    reading disappear) and fill null measures with them."""
    m = means.withColumnsRenamed({"AIRPORT_ID": "_ma", "Date": "_md"})
    j = w.join(m, (w["AIRPORT_ID"] == m["_ma"]) & (w["Date"] == m["_md"]), "inner")
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(a)) for c, a in MEAN_COLUMNS.items()}
    return j.withColumns(filled).drop("_ma", "_md", *MEAN_COLUMNS.values())


def hour_first(w: DataFrame) -> DataFrame:
    """First minute reported per airport, date and hour."""
    return (w.groupBy("AIRPORT_ID", "Date", "Time_hh")
             .agg(F.min("Time_mm").alias("Time_mm")))


def first_reading_per_hour(w: DataFrame) -> DataFrame:
    """The reading at the first minute of each airport-hour (one aggregate:
    min over (minute, measures...) — no self-join, no window sort)."""
    return dedup_by(w, ["AIRPORT_ID", "Date", "Time_hh"],
                    order=["Time_mm"] + [c for c in w.columns
                                         if c not in ("AIRPORT_ID", "Date", "Time_hh", "Time_mm")])


def to_observations(w: DataFrame) -> DataFrame:
    """Hour-grain reading -> observation record (minute forced to 0)."""
    return (w.withColumn("Weather_TIMESTAMP", weather_ts("Date", "Time_hh"))
             .withColumn("WindSpeed", F.col("WindSpeed").cast("double"))
             .select(*OBS_FIELDS))


def impute_by_day(w: DataFrame) -> DataFrame:
    """Window form of ``impute(w, daily_mean(w))``: conditional means over
    ``PARTITION BY (AIRPORT_ID, Date)`` (no join, no second pass); days
    without a complete-case reading are dropped, as the inner join does."""
    day = Window.partitionBy(*DAY_KEYS)
    cc = ((F.col("WindSpeed") != -1) & F.col("DryBulbCelsius").isNotNull()
          & F.col("WindSpeed").isNotNull() & F.col("HourlyPrecip").isNotNull()
          & F.col("Visibility").isNotNull())
    # means and count in one step, so that a day's rows are kept and copied once
    stats = {a: F.avg(F.when(cc, F.col(c))).over(day) for c, a in MEAN_COLUMNS.items()}
    stats["_n_cc"] = F.count(F.when(cc, 1)).over(day)
    j = w.withColumns(stats).where(F.col("_n_cc") > 0)
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(a)) for c, a in MEAN_COLUMNS.items()}
    return j.withColumns(filled).drop("_n_cc", *MEAN_COLUMNS.values())


def first_by_hour(w: DataFrame) -> DataFrame:
    """Window form of ``first_reading_per_hour`` for rows with one reading
    per minute (after the minute dedup): the same rows, off the sort that the
    dedup made, each hour cut to its first row as it streams by."""
    hour = Window.partitionBy("AIRPORT_ID", "Date", "Time_hh").orderBy(F.asc_nulls_first("Time_mm"))
    return w.withColumn("_place", F.row_number().over(hour)).where(F.col("_place") == 1).drop("_place")


def hourly_observations(weather: DataFrame, airports: DataFrame,
                        partitions: int | None = None) -> DataFrame:
    """Raw readings -> one cleaned, imputed observation per airport-hour.

    1. exact copies go by a hash aggregate, partly in each task, so even a
       station flooding one minute with a report cannot concentrate rows;
    2. one hash exchange by (AIRPORT_ID, Date);
    3. the smallest reading of each minute, the daily means and the first
       reading of each hour are windows over that partitioning and one sort,
       without a further exchange.
    """
    w = dedup_readings(clean_readings(weather, airports), partitions)
    return to_observations(first_by_hour(impute_by_day(w)).where(F.col("Time_mm").isNotNull()))
