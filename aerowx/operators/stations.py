"""Airport/station map joins and the served-airport set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def attach_station(flights: DataFrame, stations: DataFrame, side: str) -> DataFrame:
    """Inner-join the map on ``<SIDE>_AIRPORT_ID`` and bring in the station
    (as ``<SIDE>_WBAN``) and time zone (as ``TZone_<SIDE>_AIRPORT_ID``)."""
    side = side.upper()
    key = f"{side}_AIRPORT_ID"
    m = stations.select(
        F.col("AirportID").alias("_aid"),
        F.col("WBAN").alias(f"{side}_WBAN"),
        F.col("TimeZone").alias(f"TZone_{side}_AIRPORT_ID"))
    return flights.join(m, flights[key] == m["_aid"], "inner").drop("_aid")


def tz_shift(df: DataFrame) -> DataFrame:
    """``Dest-Orig`` = destination zone − origin zone (hours); the two zone
    columns are dropped."""
    return (df.withColumn("Dest-Orig", F.col("TZone_DEST_AIRPORT_ID") - F.col("TZone_ORIGIN_AIRPORT_ID"))
              .drop("TZone_DEST_AIRPORT_ID", "TZone_ORIGIN_AIRPORT_ID"))


def attach_stations(flights: DataFrame, stations: DataFrame) -> DataFrame:
    """Origin and destination station + time-zone difference.  Spark
    broadcasts the map when its bytes allow."""
    return tz_shift(attach_station(attach_station(flights, stations, "origin"), stations, "dest"))


def airports_of(df: DataFrame, side: str) -> DataFrame:
    """Distinct (AIRPORT_ID, F_WBAN) pairs of one side of the trips."""
    side = side.upper()
    return df.select(F.col(f"{side}_AIRPORT_ID").alias("AIRPORT_ID"),
                     F.col(f"{side}_WBAN").alias("F_WBAN")).distinct()


def all_airports(df: DataFrame) -> DataFrame:
    """Destination ∪ origin airport/station pairs, distinct — one pass and
    one (partially aggregated) distinct instead of two plus a union."""
    pair = lambda side: F.struct(F.col(f"{side}_AIRPORT_ID").alias("AIRPORT_ID"),
                                 F.col(f"{side}_WBAN").alias("F_WBAN"))
    return (df.select(F.explode(F.array(pair("DEST"), pair("ORIGIN"))).alias("_p"))
              .select("_p.AIRPORT_ID", "_p.F_WBAN").distinct())


def served_airports(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """``all_airports`` of trips that still lack their stations, as rows of
    the station map.  What Spark expects of the trips' pairs multiplies with
    every join; of rows of the map it expects no more bytes than the map has,
    so it broadcasts a small map's airports to the readings, never the
    readings, whose estimate leaves out what a generator makes of a row."""
    pairs = all_airports(attach_stations(trips, stations))
    m = stations.select(F.col("AirportID").alias("AIRPORT_ID"), F.col("WBAN").alias("F_WBAN"))
    return m.join(pairs.select("AIRPORT_ID"), "AIRPORT_ID", "left_semi").distinct()


def served_only(weather: DataFrame, airports: DataFrame) -> DataFrame:
    """Readings whose station serves at least one airport (left semi join —
    no list of stations passes through the driver)."""
    a = airports.select(F.col("F_WBAN").alias("_w")).distinct()
    return weather.join(a, weather["WBAN"] == a["_w"], "left_semi")


def weather_by_airport(weather: DataFrame, airports: DataFrame) -> DataFrame:
    """Readings re-keyed by airport (a station serving several airports
    yields one row per airport).  AQE broadcasts the served airports when
    their measured bytes allow."""
    a = airports.select("AIRPORT_ID", F.col("F_WBAN").alias("_w"))
    return weather.join(a, weather["WBAN"] == a["_w"], "inner").drop("_w")
