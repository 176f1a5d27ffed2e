"""The observation-window attach over a streaming trip source.

Trip records arriving on a stream are joined (stream–static inner join) to
the complete observation lists, which are a static table rebuilt by the
batch plan.  The positional ``slice`` needs no state, so the query is
stateless: every micro-batch is a plain join.  Its checkpoint lies beside its
output, which makes it restartable after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from aerowx.operators.windows import DEST, ORIGIN, attach_window, widen
from aerowx.schemas import FLIGHT_RECORD


def read_trip_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Trip records (``FLIGHT_RECORD``) appearing as Parquet files in ``path``."""
    r = spark.readStream.schema(FLIGHT_RECORD)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def attach_windows_stream(trips: DataFrame, lists: DataFrame, hours: int = 12) -> DataFrame:
    """Streaming trips -> learning-table rows (both windows, widened)."""
    df = attach_window(trips, lists, *ORIGIN, hours=hours)
    df = attach_window(df, lists, *DEST, hours=hours)
    return widen(df, hours)


def start_to_parquet(df: DataFrame, out_path: str, checkpoint: str | None = None,
                     trigger_once: bool = False) -> StreamingQuery:
    """Append the widened rows to Parquet.  The checkpoint belongs to the
    output (by default the folder ``<out_path>.checkpoint`` beside it), so a
    query started again on the same output goes on where it stopped."""
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint or out_path.rstrip("/") + ".checkpoint"))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start(out_path)
