"""Cleaning of sentinel-coded station measurements (built-in expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical results.
MISSING = "M"            # "missing" code in text measures
VARIABLE_WIND = "VR"     # variable wind direction/speed
TRACE = "T"              # trace precipitation
BLANK = " "              # single-blank precipitation field
SKY_MISSING = "M"        # sky condition of a null/empty field
SKY_OTHER = "OTHER"      # sky condition with no letter code in its last layer
# letters at the end of the last cloud layer, optionally followed by digits
SKY_LAYER_PATTERN = r"([A-Za-z]+)[0-9]*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(col) -> Column:
    """Text -> double; malformed text (``M`` etc.) -> null."""
    return _c(col).try_cast("double")


def sky_condition(col) -> Column:
    """Cloud cover code of the last (highest) reported layer.

    null / empty -> ``M``; otherwise the last whitespace-separated token of
    the trimmed text, and in it the letters that end it before optional
    digits (``FEW010 OVC100`` -> ``OVC``); no such letters -> ``OTHER``.
    """
    c = _c(col)
    # strip every leading/trailing control or blank character (not only
    # spaces), then take the last whitespace-separated layer
    stripped = F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    last = F.element_at(F.split(stripped, r"\s+"), -1)
    code = F.regexp_extract(last, SKY_LAYER_PATTERN, 1)
    return (F.when(c.isNull() | (c == ""), F.lit(SKY_MISSING))
             .when(code == "", F.lit(SKY_OTHER))
             .otherwise(code))


def wind_speed(col) -> Column:
    """``VR`` -> -1, else the integer speed (fraction truncated); bad -> null."""
    c = _c(col)
    return (F.when(c == VARIABLE_WIND, F.lit(-1))
             .otherwise(c.try_cast("double").try_cast("int")))


def weather_type(col) -> Column:
    """``M`` -> empty string; anything else (null included) unchanged."""
    c = _c(col)
    return F.when(c == MISSING, F.lit("")).otherwise(c)


def precip(col) -> Column:
    """Hourly precipitation: trace ``T`` or a single blank -> 0; text ->
    double; null stays null (imputed later)."""
    c = _c(col)
    return (F.when((c == TRACE) | (c == BLANK), F.lit(0.0))
             .otherwise(c.try_cast("double")))
