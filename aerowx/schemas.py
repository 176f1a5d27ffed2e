"""Schemas of the inputs, the typed records and the learning table.

PySpark has no typed ``Dataset``; a "record" is a ``StructType`` and
``conform`` casts a frame to it (by name) and checks nothing is missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# raw trips (CSV with header)
FLIGHTS_RAW = T.StructType([
    T.StructField("FL_DATE", T.DateType()),
    T.StructField("ORIGIN_AIRPORT_ID", T.IntegerType()),
    T.StructField("DEST_AIRPORT_ID", T.IntegerType()),
    T.StructField("CRS_DEP_TIME", T.IntegerType()),
    T.StructField("CRS_ELAPSED_TIME", T.DoubleType()),
    T.StructField("ARR_DELAY_NEW", T.DoubleType()),
    T.StructField("WEATHER_DELAY", T.DoubleType()),
    T.StructField("NAS_DELAY", T.DoubleType()),
    T.StructField("CANCELLED", T.IntegerType()),
    T.StructField("DIVERTED", T.IntegerType()),
])

# raw hourly station readings (CSV with header); measures stay text so the
# sentinels (M, VR, T, single blank) survive until they are cleaned
WEATHER_RAW = T.StructType([
    T.StructField("WBAN", T.IntegerType()),
    T.StructField("Date", T.IntegerType()),
    T.StructField("Time", T.IntegerType()),
    T.StructField("DryBulbCelsius", T.StringType()),
    T.StructField("SkyCondition", T.StringType()),
    T.StructField("Visibility", T.StringType()),
    T.StructField("WindSpeed", T.StringType()),
    T.StructField("WeatherType", T.StringType()),
    T.StructField("HourlyPrecip", T.StringType()),
    T.StructField("WindDirection", T.StringType()),
    T.StructField("StationPressure", T.StringType()),
])

# airport -> station, time zone (hours from UTC)
STATIONS_RAW = T.StructType([
    T.StructField("AirportID", T.IntegerType()),
    T.StructField("WBAN", T.IntegerType()),
    T.StructField("TimeZone", T.DoubleType()),
])

# typed trip record handed to the window join
FLIGHT_RECORD = T.StructType([
    T.StructField("ORIGIN_AIRPORT_ID", T.IntegerType()),
    T.StructField("DEST_AIRPORT_ID", T.IntegerType()),
    T.StructField("CRS_DEP_TIMESTAMP", T.TimestampNTZType()),
    T.StructField("SCHEDULED_ARRIVAL_TIMESTAMP", T.TimestampNTZType()),
    T.StructField("ARR_DELAY_NEW", T.DoubleType()),
])

# typed observation record (one reading per airport and hour)
WEATHER_RECORD = T.StructType([
    T.StructField("AIRPORT_ID", T.IntegerType()),
    T.StructField("Weather_TIMESTAMP", T.TimestampNTZType()),
    T.StructField("DryBulbCelsius", T.DoubleType()),
    T.StructField("SkyCondition", T.StringType()),
    T.StructField("Visibility", T.DoubleType()),
    T.StructField("WindSpeed", T.DoubleType()),
    T.StructField("WeatherType", T.StringType()),
    T.StructField("HourlyPrecip", T.DoubleType()),
])

OBS_FIELDS = [f.name for f in WEATHER_RECORD.fields]

# window column names: item 0 of a window (oldest) is *_11H, item 11 is *_00H
HOURS = 12


def window_columns(prefix: str, hours: int = HOURS) -> list[str]:
    return [f"{prefix}_{hours - 1 - i:02d}H" for i in range(hours)]


WO_COLUMNS = window_columns("WO")
WD_COLUMNS = window_columns("WD")

ML_TABLE_COLUMNS = (WO_COLUMNS + ["ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID",
                                  "CRS_DEP_TIMESTAMP",
                                  "SCHEDULED_ARRIVAL_TIMESTAMP"]
                    + WD_COLUMNS + ["Class"])


class SchemaMismatch(ValueError):
    pass


def conform(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Select ``schema``'s fields from ``df`` by name and cast them.

    Missing fields raise ``SchemaMismatch`` (the typed-record conversion of a
    frame).  Casts are ``try_cast`` so malformed values become null rather
    than failing the job under ANSI mode.
    """
    cols = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in cols]
    if missing and strict:
        raise SchemaMismatch(f"missing columns {missing}; have {df.columns}")
    types = dict(df.dtypes)
    out = []
    for f in schema.fields:
        src = cols.get(f.name.lower())
        if src is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif types[src] == "string" and isinstance(f.dataType, _INTEGRAL):
            # exports write integral fields as "0.00" / "0930": go through
            # double (fraction truncated, as the non-ANSI cast did)
            out.append(F.col(src).try_cast("double").try_cast(f.dataType).alias(f.name))
        else:
            out.append(F.col(src).try_cast(f.dataType).alias(f.name))
    return df.select(*out)


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
