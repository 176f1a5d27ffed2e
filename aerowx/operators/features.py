"""Learning-table features: label, schedule parts, window flattening,
weather-type flags and column selection.  Column lists are computed from the
schema on the driver (metadata only); every transformation is one
``select`` / ``withColumns`` so the analysed plan stays flat."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerowx.functions.hashing import ROW_KEY, trip_key
from aerowx.functions.timecols import hour_of, week_of_month
from aerowx.schemas import OBS_FIELDS, WD_COLUMNS, WO_COLUMNS

# Fixed values that must equal the reference's for identical results.
# weather-type codes turned into flags by substring match
WEATHER_CODES = ["RA", "SN", "FG", "FG+", "WIND", "FZDZ", "FZRA", "MIFG", "FZFG"]
# schedule columns kept by the live feature set (plus the label)
SCHEDULE_COLUMNS = ["ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "Hour_SO", "Hour_SA",
                    "Month_SO", "Month_SA", "Day_SO", "Day_SA", "Year_SO", "Year_SA"]
TARGET = "Target"
WEATHER_TYPE_INDEX = OBS_FIELDS.index("WeatherType")      # 6
AIRPORT_INDEX = OBS_FIELDS.index("AIRPORT_ID")             # 0
TIMESTAMP_INDEX = OBS_FIELDS.index("Weather_TIMESTAMP")    # 1


def label(df: DataFrame, threshold: float, source: str = "Class", out: str = TARGET) -> DataFrame:
    """1 when the delay reaches ``threshold`` minutes, else 0 (null -> 0)."""
    return df.withColumn(out, F.when(F.col(source) >= threshold, 1).otherwise(0))


def schedule_parts(df: DataFrame) -> DataFrame:
    """Hour, week-of-month (``F``), month and year of the scheduled
    departure (``_SO``) and arrival (``_SA``)."""
    dep, arr = F.col("CRS_DEP_TIMESTAMP"), F.col("SCHEDULED_ARRIVAL_TIMESTAMP")
    return df.withColumns({
        "Hour_SO": hour_of(dep), "Hour_SA": hour_of(arr),
        "Day_SO": week_of_month(dep), "Day_SA": week_of_month(arr),
        "Month_SO": F.month(dep), "Month_SA": F.month(arr),
        "Year_SO": F.year(dep), "Year_SA": F.year(arr),
    })


def learning_table(ml: DataFrame, threshold: float) -> DataFrame:
    """ML table -> label, string airport ids and schedule parts; the delay
    and the two timestamps are dropped."""
    df = label(ml, threshold)
    df = df.withColumns({"ORIGIN_AIRPORT_ID": F.col("ORIGIN_AIRPORT_ID").cast("string"),
                         "DEST_AIRPORT_ID": F.col("DEST_AIRPORT_ID").cast("string")})
    return schedule_parts(df).drop("Class", "CRS_DEP_TIMESTAMP", "SCHEDULED_ARRIVAL_TIMESTAMP")


_HOUR_RE = re.compile(r"^(WO|WD)_(\d+)H$")


def window_hours(columns: Sequence[str], prefix: str, n: int) -> list[str]:
    """Window columns of ``prefix`` whose hour number is <= ``n``."""
    out = []
    for c in columns:
        m = _HOUR_RE.match(c)
        if m and m.group(1) == prefix and int(m.group(2)) <= n:
            out.append(c)
    return out


def select_hours(df: DataFrame, n_origin: int, n_dest: int, extra: Sequence[str] = ()) -> DataFrame:
    """Keep origin hours 00..n_origin, destination hours 00..n_dest (+ extra)."""
    cols = window_hours(df.columns, "WO", n_origin) + window_hours(df.columns, "WD", n_dest)
    return df.select(*cols, *extra)


def select_features(df: DataFrame, weather: bool = False, n_origin: int = 11,
                    n_dest: int = 11, extra: Sequence[str] = ()) -> DataFrame:
    """The schedule columns + label (+ ``extra``); with ``weather`` also the
    selected window hours (the reference's live setting is ``weather=False``)."""
    const = [*SCHEDULE_COLUMNS, TARGET, *extra]
    if not weather:
        return df.select(*const)
    return select_hours(df, n_origin, n_dest, extra=const)


def window_struct_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if _HOUR_RE.match(c)]


def flatten_obs(df: DataFrame) -> DataFrame:
    """Every window struct -> one column per field, named ``<i>_<col>``."""
    ws = window_struct_columns(df)
    keep = [F.col(f"`{c}`") for c in df.columns if c not in ws]
    flat = [F.col(f"{w}.{f}").alias(f"{i}_{w}") for w in ws for i, f in enumerate(OBS_FIELDS)]
    return df.select(*keep, *flat)


def drop_obs_ids(df: DataFrame) -> DataFrame:
    """Remove the repeated airport-id columns (``0_W..``)."""
    return df.drop(*[c for c in df.columns if c.startswith(f"{AIRPORT_INDEX}_W")])


def obs_parts(df: DataFrame) -> DataFrame:
    """Year, month, day of week and hour of every timestamp column, which
    is then dropped."""
    ts_cols = [f.name for f in df.schema.fields
               if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    parts = {}
    for c in ts_cols:
        parts[f"Year_{c}"] = F.year(c)
        parts[f"Month_{c}"] = F.month(c)
        parts[f"Day_{c}"] = F.dayofweek(c)
        parts[f"Hour_{c}"] = F.hour(c)
    return df.withColumns(parts).drop(*ts_cols)


def multi_hot(df: DataFrame, codes: Sequence[str] = WEATHER_CODES) -> DataFrame:
    """Each weather-type column -> one 0/1 flag per code, by substring match
    (so ``FG`` also fires on ``FG+`` / ``MIFG`` / ``FZFG``); null -> 0.  The
    source columns are dropped."""
    src = [c for c in df.columns if c.startswith(f"{WEATHER_TYPE_INDEX}_W")]
    flags = {f"{c}_{code}": F.when(F.col(c).contains(code), 1).otherwise(0)
             for c in src for code in codes}
    return df.withColumns(flags).drop(*src)


def granularity(df: DataFrame, year: bool = False, month: bool = False, day: bool = False) -> DataFrame:
    """Drop the Year / Month / Day columns whose flag is off.  (All flags on
    keeps every column.)"""
    drop = [(year, "Year"), (month, "Month"), (day, "Day")]
    gone = [c for c in df.columns if any((not flag) and c.startswith(p + "_") for flag, p in drop)]
    return df.drop(*gone)


def weather_features(df: DataFrame) -> DataFrame:
    """Flatten the windows, drop repeated airport ids, split timestamps into
    parts and turn weather types into flags."""
    return multi_hot(obs_parts(drop_obs_ids(flatten_obs(df))))


def prepare_features(ml: DataFrame, threshold: float, weather: bool = False,
                     n_origin: int = 11, n_dest: int = 11,
                     year: bool = False, month: bool = False, day: bool = False,
                     key: bool = False) -> DataFrame:
    """ML table -> the frame handed to the encoder; with ``key`` also every
    row's ``row_key``, by which samples and folds are drawn."""
    if key:
        ml = ml.withColumn(ROW_KEY, trip_key())
    df = select_features(learning_table(ml, threshold), weather, n_origin, n_dest, extra=[ROW_KEY] if key else [])
    if weather:
        df = weather_features(df)
    return granularity(df, year, month, day)


def feature_columns(df: DataFrame, target: str = TARGET) -> tuple[list[str], list[str]]:
    """(numeric columns except the label, string columns)."""
    num = [f.name for f in df.schema.fields
           if isinstance(f.dataType, (T.DoubleType, T.IntegerType)) and target not in f.name]
    txt = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return num, txt

