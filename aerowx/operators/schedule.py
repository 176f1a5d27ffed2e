"""Trip timestamps: scheduled departure and arrival, local wall clock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerowx.functions.timecols import arrival_ts, departure_ts
from aerowx.schemas import FLIGHT_RECORD

RECORD_COLUMNS = [f.name for f in FLIGHT_RECORD.fields]


def schedule(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Trips with station info -> the trip record.

    ``CRS_DEP_TIMESTAMP`` = FL_DATE + CRS_DEP_TIME (``hhmm``);
    ``SCHEDULED_ARRIVAL_TIMESTAMP`` = departure + CRS_ELAPSED_TIME minutes +
    ``Dest-Orig`` hours (each truncated to whole seconds).
    ``keep`` lists extra pass-through columns.
    """
    dep = departure_ts("FL_DATE", "CRS_DEP_TIME")
    out = df.withColumn("CRS_DEP_TIMESTAMP", dep)
    out = out.withColumn("SCHEDULED_ARRIVAL_TIMESTAMP",
                         arrival_ts("CRS_DEP_TIMESTAMP", "CRS_ELAPSED_TIME", F.col("`Dest-Orig`")))
    return out.select(*RECORD_COLUMNS, *(keep or []))
