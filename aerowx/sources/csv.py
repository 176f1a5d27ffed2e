"""CSV sources (header row) and a matching writer.

Files are read with every column as text and then conformed to the schema
*by header name* (case-insensitive, ``try_cast``): extra columns, any column
order and the empty trailing-comma column are tolerated, and no
schema-inference pass runs over the data.  All files of one path must share
their header; a file with another one raises instead of being read by
position.  An empty field is null; a writer that must tell null from empty
text names a null marker, and readers are given the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerowx.schemas import FLIGHTS_RAW, STATIONS_RAW, WEATHER_RAW, conform

# keep blanks: the precipitation sentinel is a single space
_READ_OPTS = {"header": "true", "inferSchema": "false", "ignoreLeadingWhiteSpace": "false",
              "ignoreTrailingWhiteSpace": "false", "mode": "PERMISSIVE", "enforceSchema": "false"}
_WRITE_OPTS = {"header": "true", "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}

# columns a trip file may lack (filled with null, later with 0)
OPTIONAL_FLIGHT_COLUMNS = ("WEATHER_DELAY", "NAS_DELAY")
# columns of a reading that only the zero-filling cleaning uses
OPTIONAL_WEATHER_COLUMNS = ("WindDirection", "StationPressure")


def read_csv(spark: SparkSession, path: str, schema, optional=(), **opts) -> DataFrame:
    """Header CSV -> ``schema`` columns by name; a missing required column
    raises ``SchemaMismatch``."""
    raw = spark.read.options(**(_READ_OPTS | opts)).csv(path)
    have = {c.lower() for c in raw.columns}
    missing = [f.name for f in schema.fields
               if f.name.lower() not in have and f.name not in optional]
    if missing:
        from aerowx.schemas import SchemaMismatch
        raise SchemaMismatch(f"{path}: missing columns {missing}")
    return conform(raw, schema, strict=False)


def read_flights(spark: SparkSession, path: str, **opts) -> DataFrame:
    return read_csv(spark, path, FLIGHTS_RAW, optional=OPTIONAL_FLIGHT_COLUMNS, **opts)


def read_weather(spark: SparkSession, path: str, **opts) -> DataFrame:
    return read_csv(spark, path, WEATHER_RAW, optional=OPTIONAL_WEATHER_COLUMNS, **opts)


def read_stations(spark: SparkSession, path: str, **opts) -> DataFrame:
    return read_csv(spark, path, STATIONS_RAW, **opts)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **opts) -> None:
    df.write.mode(mode).options(**(_WRITE_OPTS | opts)).csv(path)
