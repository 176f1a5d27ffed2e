"""Projection, filtering and cleaning of trip rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILL_ZERO_COLUMNS = ("WEATHER_DELAY", "NAS_DELAY", "ARR_DELAY_NEW")
REQUIRED_COLUMNS = ("CRS_ELAPSED_TIME",)
FLAG_COLUMNS = ("DIVERTED", "CANCELLED")
ARTEFACT_COLUMNS = ("_C12",)


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    have = {c.lower(): c for c in df.columns}
    return [have[c.lower()] for c in cols if c.lower() in have]


def fill_zero(df: DataFrame, cols: Sequence[str] = FILL_ZERO_COLUMNS) -> DataFrame:
    """null -> 0 in the given numeric columns (absent columns are skipped)."""
    cols = _present(df, cols)
    return df.na.fill(0, cols) if cols else df


def require(df: DataFrame, cols: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Drop rows with a null in any of ``cols``."""
    return df.na.drop(subset=list(cols))


def operated_only(df: DataFrame, flags: Sequence[str] = FLAG_COLUMNS) -> DataFrame:
    """Keep trips neither diverted nor cancelled; a null flag drops the row
    (``flag != 1`` is null there)."""
    cond = None
    for f in _present(df, flags):
        c = F.col(f) != 1
        cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns if present (case-insensitive)."""
    return df.drop(*_present(df, cols))


def dedup(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows."""
    return df.dropDuplicates()


def dedup_by(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the smallest by ``order`` (default: all other
    columns, ascending, nulls first) — deterministic where a keyed
    ``dropDuplicates`` keeps an arbitrary row.

    Written as ``min(struct(order..., rest...))`` per key with a map-side
    partial aggregate (a sort aggregate, as the buffer holds text), so a hot
    key is reduced in every task before it is shuffled.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order) if order is not None else rest
    payload = order + [c for c in rest if c not in order]
    if not payload:
        return df.select(*keys).distinct()
    best = df.groupBy(*keys).agg(F.min(F.struct(*payload)).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest]).select(*df.columns)


def cast_cols(df: DataFrame, cols: Sequence[str], dtype: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(dtype) for c in cols})


def operated_trips(df: DataFrame) -> DataFrame:
    """Fill delays, require a scheduled duration, keep operated trips and
    drop the flag / artefact columns (row-local, no shuffle)."""
    df = fill_zero(df)
    df = require(df)
    df = operated_only(df)
    return drop_columns(df, FLAG_COLUMNS + ARTEFACT_COLUMNS)


def clean_flights(df: DataFrame) -> DataFrame:
    """``operated_trips`` and then exact-duplicate removal."""
    return dedup(operated_trips(df))
