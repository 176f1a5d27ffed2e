"""Properties on the driver fixtures (sf0.001)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from aerowx.operators import observations as O
from aerowx.operators import windows as WN
from aerowx.plans import preprocess as PP
from aerowx.session import cut_lineage, scratch_path
from aerowx.sources import chunks as CH
from aerowx.sources import fixtures as FX
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def prepared(spark):
    return PP.prepare(FX.flights(spark, SF_SMALL), FX.weather(spark, SF_SMALL), FX.stations(spark, SF_SMALL))


def test_documented_counts(prepared):
    """Trips after cleaning, with the origin window, with both windows."""
    assert prepared.trips.count() == 1430
    assert PP.origin_windows(prepared).count() == 1384
    assert PP.with_windows(prepared).count() == 1333


def test_list_and_frame_forms_agree(prepared):
    a = WN.widen(PP.with_windows(prepared, "list"))
    b = WN.widen(PP.with_windows(prepared, "frame"))
    assert a.count() == b.count() == 1333
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_every_window_is_twelve_ascending_hours_before_t(prepared):
    df = PP.with_windows(prepared)
    for lst, t in (("WO_List", "CRS_DEP_TIMESTAMP"), ("WD_List", "SCHEDULED_ARRIVAL_TIMESTAMP")):
        ts = F.transform(lst, lambda x: x["Weather_TIMESTAMP"])
        bad = df.where(
            (F.size(lst) != 12)
            | (F.array_sort(ts) != ts)
            | (F.array_max(ts) > F.col(t))
            | (F.array_min(ts) <= F.col(t) - F.expr("INTERVAL 12 HOURS"))
            | (F.size(F.array_distinct(ts)) != 12))
        assert bad.count() == 0


@pytest.mark.parametrize("hours", [1, 6, 24])
def test_windows_of_other_lengths(prepared, hours):
    lists = O.complete_lists(prepared.observations, hours)
    by_place = WN.attach_windows(prepared.trips, lists, hours)
    by_filter = WN.attach_windows(prepared.trips, lists, hours, complete=False)
    by_frame = WN.attach_windows_frame(prepared.trips, prepared.observations, hours)
    assert by_place.count() > 1000
    for other in (by_filter, by_frame):
        other = other.select(*by_place.columns)
        assert by_place.exceptAll(other).count() == 0 and other.exceptAll(by_place).count() == 0
    wide = WN.widen(by_place, hours)
    assert wide.columns[0] == f"WO_{hours - 1:02d}H" and f"WD_{hours:02d}H" not in wide.columns
    late = wide.where(F.col("WO_00H.Weather_TIMESTAMP") != F.date_trunc("hour", "CRS_DEP_TIMESTAMP").cast("timestamp_ntz"))
    assert late.count() == 0


def test_hours_out_of_range_are_refused(prepared):
    for hours in (0, 25):
        with pytest.raises(ValueError):
            O.complete_lists(prepared.observations, hours)


def test_a_doubled_hour_beside_a_missing_one_is_not_complete(spark):
    start = dt.datetime(2024, 1, 4, 12)
    hours = [start + dt.timedelta(hours=i) for i in range(36)]
    schema = "AIRPORT_ID int, Weather_TIMESTAMP timestamp_ntz, DryBulbCelsius double, SkyCondition string, " \
             "Visibility double, WindSpeed double, WeatherType string, HourlyPrecip double"
    rows = [(a, t, 0.0, "CLR", 1.0, 1.0, "", 0.0) for a, ts in
            ((1, hours), (2, hours[:20] + [hours[18]] + hours[21:])) for t in ts]
    lists = O.observation_lists(spark.createDataFrame(rows, schema)).where("obs_date = DATE'2024-01-05'")
    assert lists.where(F.size("Weather_List") == 36).count() == 2
    assert [r.AIRPORT_ID for r in O.complete(lists).collect()] == [1]


def test_complete_days_are_exactly_36(prepared):
    lists = O.observation_lists(prepared.observations)
    full = O.complete(lists)
    assert full.where(F.size("Weather_List") != 36).count() == 0
    # every complete day covers D-1 12:00 .. D 23:00 once
    rng = full.select(F.col("Weather_List")[0]["Weather_TIMESTAMP"].alias("a"),
                      F.element_at("Weather_List", -1)["Weather_TIMESTAMP"].alias("b"), "obs_date")
    bad = rng.where((F.col("a") != F.col("obs_date").cast("timestamp_ntz") - F.expr("INTERVAL 12 HOURS"))
                    | (F.col("b") != F.col("obs_date").cast("timestamp_ntz") + F.expr("INTERVAL 23 HOURS")))
    assert bad.count() == 0
    assert 0 < full.count() < lists.count()


def test_chunks_partition_the_table(spark, prepared):
    ml = WN.widen(PP.with_windows(prepared))
    path = scratch_path(spark, "test-chunks")
    CH.write_chunks(ml, path)
    back = CH.read_chunks(spark, path)
    assert back.count() == ml.count()
    assert back.exceptAll(ml).count() == 0 and ml.exceptAll(back).count() == 0
    parts = spark.read.parquet(path).groupBy("chunk").count().collect()
    assert {r.chunk for r in parts} <= set(range(CH.N_CHUNKS)) and len(parts) > 10
    one = CH.read_chunks(spark, path, chunks=[3])
    assert one.count() == [r["count"] for r in parts if r.chunk == 3][0]


def test_inputs_are_whole_and_grow_with_scale(spark):
    """Every event is a reading, and stations, lists and trip keys grow."""
    seen = []
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        events = spark.read.parquet(f"{sf}/events.parquet").count()
        readings, grid = FX.weather(spark, sf), FX._grid_readings(spark, sf)
        assert readings.count() == grid.count() + events
        trips = FX.flights(spark, sf)
        assert trips.count() == spark.read.parquet(f"{sf}/orders.parquet").count()
        hub = trips.where("ORIGIN_AIRPORT_ID = 0").count() / trips.count()
        assert hub > 1 / 3
        seen.append((FX.stations(spark, sf).count(), readings.select("WBAN", "Date").distinct().count(),
                     trips.select("ORIGIN_AIRPORT_ID", "FL_DATE").distinct().count()))
    assert all(b > 5 * a for a, b in zip(*seen)), seen


def test_final_plan_splits_a_hot_key(spark):
    """On the shuffle path, with the lists in a checkpoint, AQE splits the
    hub's partition of the trips.  (Without it the lists' own aggregation
    shares the join's exchange, which AQE leaves whole.)"""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        start = dt.datetime(2024, 1, 4)
        obs = spark.createDataFrame(
            [(a, start + dt.timedelta(hours=i), float(i), "CLR", 1.0, 1.0, "", 0.0) for a in range(8) for i in range(72)],
            "AIRPORT_ID int, Weather_TIMESTAMP timestamp_ntz, DryBulbCelsius double, SkyCondition string, "
            "Visibility double, WindSpeed double, WeatherType string, HourlyPrecip double")
        trips = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 8).cast("int").alias("ORIGIN_AIRPORT_ID"),
            F.lit(1).alias("DEST_AIRPORT_ID"),
            (F.lit(dt.datetime(2024, 1, 5)).cast("timestamp_ntz")
             + F.make_dt_interval(mins=(F.col("id") % 1440).cast("int"))).alias("CRS_DEP_TIMESTAMP"),
            F.lit(dt.datetime(2024, 1, 6, 8)).cast("timestamp_ntz").alias("SCHEDULED_ARRIVAL_TIMESTAMP"),
            F.rand(1).alias("ARR_DELAY_NEW"))
        lists = cut_lineage(O.complete_lists(obs)).hint("shuffle_hash")
        out = WN.attach_window(trips, lists, *WN.ORIGIN)
        assert out._jdf.queryExecution().toRdd().count() == 60000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan.lower() and "BuildRight" in plan, plan[:1500]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_airport_skew_is_handled(spark):
    """A third of all trips on one airport-day: result equals the
    unskewed computation per row (AQE may split the hot partition)."""
    start = dt.datetime(2024, 1, 4)
    obs = spark.createDataFrame(
        [(1, start + dt.timedelta(hours=i), float(i), "CLR", 1.0, 1.0, "", 0.0) for i in range(72)],
        "AIRPORT_ID int, Weather_TIMESTAMP timestamp_ntz, DryBulbCelsius double, SkyCondition string, "
        "Visibility double, WindSpeed double, WeatherType string, HourlyPrecip double")
    trips = (spark.range(3000).select(
        F.lit(1).alias("ORIGIN_AIRPORT_ID"), F.lit(1).alias("DEST_AIRPORT_ID"),
        (F.lit(dt.datetime(2024, 1, 5)).cast("timestamp_ntz")
         + F.make_dt_interval(mins=(F.col("id") % 1440).cast("int"))).alias("CRS_DEP_TIMESTAMP"),
        F.lit(dt.datetime(2024, 1, 6, 8)).cast("timestamp_ntz").alias("SCHEDULED_ARRIVAL_TIMESTAMP"),
        F.lit(1.0).alias("ARR_DELAY_NEW")))
    out = WN.attach_windows(trips, O.complete_lists(obs))
    assert out.count() == 3000
    assert out.where(F.size("WO_List") != 12).count() == 0
    salted = WN.attach_windows(trips, O.complete_lists(obs), salt=8)
    assert salted.count() == 3000
    assert salted.exceptAll(out).count() == 0 and out.exceptAll(salted).count() == 0
    # only the hot key is salted; a cold trip on another airport-day joins unsalted
    cold = trips.limit(1).withColumn("CRS_DEP_TIMESTAMP", F.lit(dt.datetime(2024, 1, 6, 9)).cast("timestamp_ntz"))
    mixed = trips.unionByName(cold)
    hot = WN.hot_keys(mixed, "ORIGIN_AIRPORT_ID", "CRS_DEP_TIMESTAMP", 0.3).collect()
    assert [(r._ha, r._hd) for r in hot] == [(1, dt.date(2024, 1, 5))]
    a = WN.attach_window_hot_salted(mixed, O.complete_lists(obs), *WN.ORIGIN, buckets=8, fraction=0.3)
    b = WN.attach_window(mixed, O.complete_lists(obs), *WN.ORIGIN)
    assert a.count() == b.count() == 3001
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_flooded_station_minute_is_pre_reduced(spark):
    """One reading repeated many times: the hash aggregate collapses it in
    each task; the observation is the same as with a single copy."""
    from aerowx.operators import weather as W
    base = [(10001, 20240105, 1000 + m, "5", "CLR", "10", "3", "", "0.5") for m in range(0, 60, 10)]
    flood = [(10001, 20240105, 1000, "5", "CLR", "10", "3", "", "0.5")] * 5000
    schema = "WBAN int, Date int, Time int, DryBulbCelsius string, SkyCondition string, " \
             "Visibility string, WindSpeed string, WeatherType string, HourlyPrecip string"
    airports = spark.createDataFrame([(1, 10001)], "AIRPORT_ID int, F_WBAN int")
    one = W.hourly_observations(spark.createDataFrame(base, schema), airports).collect()
    many = W.hourly_observations(spark.createDataFrame(base + flood, schema).repartition(8), airports).collect()
    assert one == many and len(one) == 1


def test_minute_keeps_its_smallest_reading_as_the_keyed_dedup_does(spark):
    """Copies and different readings of a minute, with nulls: the windowed
    dedup and the keyed aggregate keep the same rows."""
    from aerowx.operators import clean as C
    from aerowx.operators import weather as W
    rnd = random.Random(3)
    pick = lambda *v: rnd.choice(v)
    rows = [(pick(1, 2), 20240105, f"{h:02d}{m:02d}", pick(None, 1.0, 2.0), pick("CLR", None, ""), pick(9.0, None),
             pick(-1, 3, None), pick("", "RA"), pick(0.0, None), h, m)
            for h, m in ((rnd.randrange(3), rnd.randrange(4)) for _ in range(2000))]
    w = spark.createDataFrame(rows, "AIRPORT_ID int, Date int, Time string, DryBulbCelsius double, SkyCondition string, "
                              "Visibility double, WindSpeed int, WeatherType string, HourlyPrecip double, "
                              "Time_hh int, Time_mm int").repartition(5)
    want = C.dedup_by(w, W.READING_KEYS, order=W.MEASURES + ["Time"])
    got = W.dedup_readings(w)
    assert got.columns == w.columns and got.count() == want.count() == 24
    assert got.exceptAll(want).count() == 0
