"""Adapters that derive trips, station readings and the station map from the
driver's tables, so every query's work grows with the scale factor.

* station map: one airport per ``supplier`` row.
* trips: one per ``orders`` row; every third leaves from one hub, the others
  from the station that the customer's key and nation name.
* readings: an hourly grid per station (with gaps that make some days
  incomplete) plus one extra reading per ``events`` row, at any hour (an
  event may fill a gap), with its own sentinels.  Measures are small integers
  or quarters, so sums (and hence means) are exact in any summation order.

Every row of the base tables is used; stations, lists and trips all grow with
the scale factor, and the hub is a hot key at every size.

The same derivations exist as SQL CTEs in ``aerowx.plans.oracle``; keep the
two in step.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerowx.schemas import FLIGHTS_RAW, STATIONS_RAW, WEATHER_RAW

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")

GRID_HOURS = 720          # 2024-01-01 00:00 .. 2024-01-30 23:00
GRID_STATIONS = 500       # stations whose hours one task makes
FIRST_FLIGHT_DATE = "2024-01-02"


_TABLE_CACHE: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  The (lazy) DataFrame is memoized per session and
    path, so repeated queries skip file listing and footer reads; nothing is
    cached in memory."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLE_CACHE.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLE_CACHE[key] = spark.read.parquet(path)
    return df


GAP = "(h * 131 + n * 977) % 509 = 0"    # station has no report in hour h


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey AS int) AS AirportID",
        "cast(10000 + s_suppkey AS int) AS WBAN",
        "cast(-5 - s_nationkey % 4 AS double) AS TimeZone")


def _n_stations(spark: SparkSession, sf_dir: str) -> Column:
    """The number of stations, as a scalar subquery."""
    return table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()


FLIGHT_EXPRS = [
    f"date_add(DATE'{FIRST_FLIGHT_DATE}', cast(o_orderkey % 28 AS int)) AS FL_DATE",
    "cast(origin AS int) AS ORIGIN_AIRPORT_ID",
    "cast((origin + 1 + o_orderkey % (n_stations - 1)) % n_stations AS int) AS DEST_AIRPORT_ID",
    "cast(((o_orderkey * 7) % 24) * 100 + (o_orderkey * 13) % 60 AS int) AS CRS_DEP_TIME",
    "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE cast(45 + o_orderkey % 400 AS double) END AS CRS_ELAPSED_TIME",
    "CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE cast(floor(o_totalprice) % 60 AS double) END AS ARR_DELAY_NEW",
    "CASE WHEN o_orderkey % 7 = 0 THEN cast(o_orderkey % 30 AS double) END AS WEATHER_DELAY",
    "CASE WHEN o_orderkey % 11 = 0 THEN cast(o_orderkey % 45 AS double) END AS NAS_DELAY",
    "cast(CASE WHEN o_orderkey % 41 = 0 THEN 1 ELSE 0 END AS int) AS CANCELLED",
    "cast(CASE WHEN o_orderkey % 83 = 0 THEN 1 ELSE 0 END AS int) AS DIVERTED",
]


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    df = o.join(c, o.o_custkey == c.c_custkey, "inner").withColumn("n_stations", _n_stations(spark, sf_dir))
    df = df.withColumn("origin", F.expr(
        "CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE (o_custkey + c_nationkey) % n_stations END"))
    return df.selectExpr(*FLIGHT_EXPRS).select(*[f.name for f in FLIGHTS_RAW.fields])


GRID_EXPRS = [
    "cast(10000 + n AS int) AS WBAN",
    "cast(20240101 + h div 24 AS int) AS Date",
    "cast((h % 24) * 100 + (h * 11 + n * 17) % 60 AS int) AS Time",
    "CASE WHEN (h * 5 + n) % 89 = 0 THEN 'M' ELSE cast((h * 3 + n * 7) % 41 - 10 AS string) END AS DryBulbCelsius",
    "CASE (h + n) % 5 WHEN 0 THEN 'CLR' WHEN 1 THEN 'FEW010 OVC100' WHEN 2 THEN 'M' WHEN 3 THEN '' "
    "ELSE 'SCT025 BKN040' END AS SkyCondition",
    "CASE WHEN (h * 7 + n) % 71 = 0 THEN 'M' ELSE cast((h * 7 + n * 3) % 11 AS string) END AS Visibility",
    "CASE WHEN (h + n * 3) % 31 = 0 THEN 'VR' ELSE cast((h * 7 + n) % 30 AS string) END AS WindSpeed",
    "CASE (h * 3 + n) % 11 WHEN 0 THEN 'RA' WHEN 1 THEN '-RA FG+' WHEN 2 THEN 'M' WHEN 3 THEN NULL "
    "WHEN 4 THEN 'FZFG' WHEN 5 THEN 'SN BR' ELSE '' END AS WeatherType",
    "CASE (h + n * 2) % 13 WHEN 0 THEN 'T' WHEN 1 THEN ' ' WHEN 2 THEN NULL "
    "ELSE CASE (h + n) % 4 WHEN 0 THEN '0.25' WHEN 1 THEN '0.5' WHEN 2 THEN '0.75' ELSE '1.5' END "
    "END AS HourlyPrecip",
    "CASE WHEN (h + n * 3) % 31 = 0 THEN 'VR' ELSE cast((h * 10 + n) % 360 AS string) END AS WindDirection",
    "CASE WHEN (h + n) % 43 = 0 THEN 'M' ELSE cast(28 + (h + n) % 4 * 0.25 AS string) END AS StationPressure",
]


def _grid_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a generator, not a cross join: each station row emits its hours.  The
    # file is one split, whatever comes of its rows, and AQE would put so few
    # bytes together again, so the number of tasks is stated
    stations = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("n"))
    return (stations.repartition(max(1, math.ceil(stations.count() / GRID_STATIONS)), "n")
            .selectExpr("n", f"explode(sequence(0, {GRID_HOURS - 1})) AS h")
            .where(f"NOT ({GAP})").selectExpr(*GRID_EXPRS))


EVENT_EXPRS = [
    "cast(10000 + n AS int) AS WBAN",
    "cast(year(ts) * 10000 + month(ts) * 100 + day(ts) AS int) AS Date",
    "cast(hour(ts) * 100 + minute(ts) AS int) AS Time",
    "CASE WHEN event_type = 'error' THEN 'M' ELSE cast(floor(value) % 41 - 10 AS string) END AS DryBulbCelsius",
    "CASE event_type WHEN 'view' THEN 'BKN015' WHEN 'click' THEN 'FEW020 SCT035 OVC050' "
    "WHEN 'signup' THEN 'VV002' WHEN 'purchase' THEN ' CLR' ELSE NULL END AS SkyCondition",
    "cast(floor(value) % 11 AS string) AS Visibility",
    "CASE WHEN event_type = 'signup' THEN 'VR' ELSE cast(floor(value * 3) % 30 AS string) END AS WindSpeed",
    "CASE event_type WHEN 'error' THEN 'TS RA' WHEN 'purchase' THEN 'FZRA' ELSE 'M' END AS WeatherType",
    "CASE WHEN event_type = 'view' THEN 'T' ELSE '0.5' END AS HourlyPrecip",
    "CASE WHEN event_type = 'click' THEN NULL ELSE cast(floor(value * 7) % 360 AS string) END AS WindDirection",
    "CASE WHEN event_type = 'error' THEN 'M' ELSE '29.5' END AS StationPressure",
]


def _event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("n_stations", _n_stations(spark, sf_dir))
    return events.selectExpr("ts", "event_type", "value", "user_id % n_stations AS n").selectExpr(*EVENT_EXPRS)


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw station readings: hourly grid ∪ event-driven extra readings."""
    cols = [f.name for f in WEATHER_RAW.fields]
    return _grid_readings(spark, sf_dir).select(*cols).unionByName(
        _event_readings(spark, sf_dir).select(*cols))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels")


__all__ = ["stations", "flights", "weather", "labels", "table", "TABLES",
           "STATIONS_RAW"]
