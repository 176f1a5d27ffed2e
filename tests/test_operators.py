"""Operators on tiny hand-made frames."""

import datetime as dt

from pyspark.sql import functions as F

from aerowx.operators import clean as C
from aerowx.operators import observations as O
from aerowx.operators import stations as S
from aerowx.operators import weather as W
from aerowx.operators import windows as WN
from aerowx.schemas import FLIGHTS_RAW, WEATHER_RECORD, WO_COLUMNS, conform, SchemaMismatch


def _flights(spark, rows):
    return spark.createDataFrame(rows, FLIGHTS_RAW)


def test_clean_flights(spark):
    d = dt.date(2024, 1, 5)
    rows = [
        (d, 1, 2, 900, 60.0, None, None, None, 0, 0),     # kept, delays -> 0
        (d, 1, 2, 900, 60.0, None, None, None, 0, 0),     # exact duplicate
        (d, 1, 2, 901, None, 5.0, None, None, 0, 0),      # no duration -> dropped
        (d, 1, 2, 902, 60.0, 5.0, None, None, 1, 0),      # cancelled
        (d, 1, 2, 903, 60.0, 5.0, None, None, 0, 1),      # diverted
        (d, 1, 2, 904, 60.0, 5.0, None, None, None, 0),   # null flag -> dropped
        (d, 1, 2, 905, 60.0, 7.0, 1.0, 2.0, 0, 0),
    ]
    out = C.clean_flights(_flights(spark, rows))
    assert "CANCELLED" not in out.columns and "DIVERTED" not in out.columns
    got = sorted((r.CRS_DEP_TIME, r.ARR_DELAY_NEW, r.WEATHER_DELAY) for r in out.collect())
    assert got == [(900, 0.0, 0.0), (905, 7.0, 1.0)]


def test_dedup_by_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", None), (1, "a", 1.0), (2, "z", 0.0)],
                               "k int, s string, v double")
    got = sorted(tuple(r) for r in C.dedup_by(df, ["k"]).collect())
    assert got == [(1, "a", None), (2, "z", 0.0)]   # smallest by (s, v), nulls first


def test_station_joins_and_airports(spark):
    d = dt.date(2024, 1, 5)
    fl = _flights(spark, [(d, 1, 2, 900, 60.0, 0.0, 0.0, 0.0, 0, 0), (d, 2, 3, 900, 60.0, 0.0, 0.0, 0.0, 0, 0)])
    st = spark.createDataFrame([(1, 101, -5.0), (2, 102, -6.0), (3, 103, -8.5)], "AirportID int, WBAN int, TimeZone double")
    fs = S.attach_stations(fl, st)
    got = sorted((r.ORIGIN_WBAN, r.DEST_WBAN, r["Dest-Orig"]) for r in fs.collect())
    assert got == [(101, 102, -1.0), (102, 103, -2.5)]
    assert sorted(tuple(r) for r in S.all_airports(fs).collect()) == [(1, 101), (2, 102), (3, 103)]
    wx = spark.createDataFrame([(101, 1), (109, 2)], "WBAN int, x int")
    assert [r.WBAN for r in S.served_only(wx, S.all_airports(fs)).collect()] == [101]


def _readings(spark, rows):
    schema = "AIRPORT_ID int, Date int, Time int, DryBulbCelsius double, SkyCondition string, " \
             "Visibility double, WindSpeed int, WeatherType string, HourlyPrecip double, Time_hh int, Time_mm int"
    return spark.createDataFrame(rows, schema)


def test_daily_mean_impute_and_hour_first(spark):
    rows = [
        (1, 20240105, 1010, 10.0, "CLR", 5.0, 4, "", 0.0, 10, 10),
        (1, 20240105, 1005, None, "CLR", 5.0, 8, "", 0.0, 10, 5),    # first in hour 10, temp imputed
        (1, 20240105, 1130, 20.0, "CLR", None, -1, "", 0.5, 11, 30),  # variable wind: not in means
        (2, 20240105, 1000, None, "CLR", None, None, "", None, 10, 0),  # no complete-case: day dropped
    ]
    w = _readings(spark, rows)
    means = {(r.AIRPORT_ID, r.Date): r for r in W.daily_mean(w).collect()}
    assert set(means) == {(1, 20240105)}
    assert means[(1, 20240105)].average_temperature == 10.0
    assert means[(1, 20240105)].average_windspeed == 4.0
    for imp in (W.impute(w, W.daily_mean(w)), W.impute_by_day(w)):
        got = sorted((r.Time, r.DryBulbCelsius, r.Visibility, r.WindSpeed) for r in imp.collect())
        assert got == [(1005, 10.0, 5.0, 8.0), (1010, 10.0, 5.0, 4.0), (1130, 20.0, 5.0, -1.0)]
    first = W.first_reading_per_hour(W.impute_by_day(w))
    assert sorted((r.Time_hh, r.Time_mm) for r in first.collect()) == [(10, 5), (11, 30)]


def _obs(spark, airport, start, hours, skip=()):
    rows = []
    for i in range(hours):
        if i in skip:
            continue
        rows.append((airport, start + dt.timedelta(hours=i), float(i), "CLR", 10.0, 5.0, "", 0.0))
    return spark.createDataFrame(rows, WEATHER_RECORD)


def test_lists_completeness_and_window(spark):
    # airport 1: 2024-01-04 00:00 .. 2024-01-06 23:00, complete
    obs = _obs(spark, 1, dt.datetime(2024, 1, 4), 72)
    lists = O.observation_lists(obs)
    sizes = {r.obs_date: r.n for r in lists.select("obs_date", F.size("Weather_List").alias("n")).collect()}
    assert sizes[dt.date(2024, 1, 4)] == 24 and sizes[dt.date(2024, 1, 5)] == 36
    assert sizes[dt.date(2024, 1, 7)] == 12
    full = O.complete(lists)
    assert sorted(r.obs_date for r in full.collect()) == [dt.date(2024, 1, 5), dt.date(2024, 1, 6)]
    trips = spark.createDataFrame(
        [(1, 1, dt.datetime(2024, 1, 5, 10, 5), dt.datetime(2024, 1, 6, 0, 0), 3.0),
         (1, 1, dt.datetime(2024, 1, 4, 10, 5), dt.datetime(2024, 1, 6, 0, 0), 3.0)],   # incomplete day
        "ORIGIN_AIRPORT_ID int, DEST_AIRPORT_ID int, CRS_DEP_TIMESTAMP timestamp_ntz, "
        "SCHEDULED_ARRIVAL_TIMESTAMP timestamp_ntz, ARR_DELAY_NEW double")
    out = WN.attach_window(trips, full, *WN.ORIGIN).collect()
    assert len(out) == 1
    ts = [x.Weather_TIMESTAMP for x in out[0].WO_List]
    assert ts[0] == dt.datetime(2024, 1, 4, 23) and ts[-1] == dt.datetime(2024, 1, 5, 10) and len(ts) == 12
    both = WN.attach_windows(trips, full).collect()
    assert [x.Weather_TIMESTAMP for x in both[0].WD_List][-1] == dt.datetime(2024, 1, 6, 0)
    frame = WN.attach_windows_frame(trips, obs).collect()
    assert [r.WO_List for r in frame] == [r.WO_List for r in both]
    wide = WN.widen(WN.attach_windows(trips, full)).collect()[0]
    assert wide[WO_COLUMNS[0]].Weather_TIMESTAMP == dt.datetime(2024, 1, 4, 23)   # WO_11H oldest
    assert wide["WO_00H"].Weather_TIMESTAMP == dt.datetime(2024, 1, 5, 10)
    assert wide["Class"] == 3.0


def test_window_bounds_exclusive_lower_inclusive_upper(spark):
    obs = _obs(spark, 1, dt.datetime(2024, 1, 4), 72)
    full = O.complete_lists(obs)
    trips = spark.createDataFrame(
        [(1, 1, dt.datetime(2024, 1, 5, 10, 0), dt.datetime(2024, 1, 5, 12, 0), 0.0)],
        "ORIGIN_AIRPORT_ID int, DEST_AIRPORT_ID int, CRS_DEP_TIMESTAMP timestamp_ntz, "
        "SCHEDULED_ARRIVAL_TIMESTAMP timestamp_ntz, ARR_DELAY_NEW double")
    ts = [x.Weather_TIMESTAMP for x in WN.attach_window(trips, full, *WN.ORIGIN).collect()[0].WO_List]
    assert ts[0] == dt.datetime(2024, 1, 4, 23) and ts[-1] == dt.datetime(2024, 1, 5, 10)


def test_gap_makes_day_incomplete(spark):
    obs = _obs(spark, 1, dt.datetime(2024, 1, 4), 72, skip={20})   # 2024-01-04 20:00 missing
    days = sorted(r.obs_date for r in O.complete_days(obs).collect())
    # 01-05 needs 01-04 12..23 -> incomplete; 01-06 is complete
    assert days == [dt.date(2024, 1, 6)]


def test_conform(spark):
    from aerowx.schemas import FLIGHT_RECORD
    df = spark.createDataFrame([("1", "2", None, None, "3.5", "x")],
                               "origin_airport_id string, DEST_AIRPORT_ID string, CRS_DEP_TIMESTAMP timestamp_ntz, "
                               "SCHEDULED_ARRIVAL_TIMESTAMP timestamp_ntz, ARR_DELAY_NEW string, extra string")
    out = conform(df, FLIGHT_RECORD)
    assert out.schema == FLIGHT_RECORD or [f.dataType for f in out.schema] == [f.dataType for f in FLIGHT_RECORD]
    assert out.collect()[0].ARR_DELAY_NEW == 3.5
    try:
        conform(df.drop("DEST_AIRPORT_ID"), FLIGHT_RECORD)
        raise AssertionError("expected SchemaMismatch")
    except SchemaMismatch:
        pass
