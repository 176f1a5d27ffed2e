"""Streaming window attach equals the batch result."""

from aerowx.operators.observations import complete_lists
from aerowx.operators.windows import attach_windows, widen
from aerowx.plans import preprocess as PP
from aerowx.schemas import FLIGHT_RECORD
from aerowx.session import scratch_path
from aerowx.sources import fixtures as FX
from aerowx.streaming.windows import (attach_windows_stream, read_trip_stream,
                                      start_to_parquet)
from conftest import SF_SMALL


def test_stream_static_attach_matches_batch(spark):
    p = PP.prepare(FX.flights(spark, SF_SMALL), FX.weather(spark, SF_SMALL), FX.stations(spark, SF_SMALL))
    lists = complete_lists(p.observations)
    src = scratch_path(spark, "trip-stream-src")
    p.trips.repartition(4).write.parquet(src)
    out = scratch_path(spark, "trip-stream-out")
    q = start_to_parquet(attach_windows_stream(read_trip_stream(spark, src, 1), lists), out, trigger_once=True)
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    want = widen(attach_windows(p.trips, lists))
    assert got.count() == want.count() == 1333
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    # a second start on the same output takes up the new rows only
    p.trips.limit(40).write.mode("append").parquet(src)
    q = start_to_parquet(attach_windows_stream(read_trip_stream(spark, src, 1), lists), out, trigger_once=True)
    q.awaitTermination(300)
    more = widen(attach_windows(spark.read.schema(FLIGHT_RECORD).parquet(src), lists)).count()
    assert spark.read.parquet(out).count() == more > 1333
