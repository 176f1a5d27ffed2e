"""Seeded places of rows, from a digest of the row's own key.

A place does not depend on how rows are partitioned or on the order in which
tasks run, so samples, splits and folds are the same on every run and after a
lost executor.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROW_KEY = "row_key"          # a long, which no feature selection takes for a feature


def row_key(*parts: Column) -> Column:
    """60 bits of a digest over the parts of a row's key (null parts count
    as empty)."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def trip_key() -> Column:
    """``row_key`` of a learning-table row: airports, both times to the
    minute and the delay in hundredths of a minute."""
    minute = lambda c: F.date_format(c, "yyyyMMddHHmm")
    return row_key(F.col("ORIGIN_AIRPORT_ID").cast("int"), F.col("DEST_AIRPORT_ID").cast("int"),
                   minute("CRS_DEP_TIMESTAMP"), minute("SCHEDULED_ARRIVAL_TIMESTAMP"),
                   F.round(F.col("Class") * 100).cast("long"))


def place(key: Column, purpose: str, seed: int) -> Column:
    """A number in [0, 1) for the key; another one for every purpose and seed."""
    text = F.concat_ws(":", F.lit(purpose), F.lit(str(seed)), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def bucket(key: Column, purpose: str, seed: int, n: int) -> Column:
    """A bucket 0 .. n-1 for the key."""
    return F.floor(place(key, purpose, seed) * F.lit(n)).cast("int")
