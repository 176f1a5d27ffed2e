"""Column expressions on hand-made edge cases."""

import datetime as dt
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerowx.functions.timecols import to_seconds
from aerowx.functions import (arrival_ts, departure_ts, observation_dates,
                              precip, sky_condition, split_hhmm, weather_ts,
                              week_of_month, wind_speed, weather_type)


def _one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


SKY_CASES = [
    ("FEW010 SCT025 OVC100", "OVC"), ("SCT025 123", "OTHER"), (" ", "OTHER"),
    ("OVC0A", "A"), (None, "M"), ("", "M"), ("CLR", "CLR"), ("\tBKN015", "BKN"),
    ("OVC100\t", "OVC"), ("VV002", "VV"), ("FEW020  SCT035", "SCT"), ("M", "M"),
]


def test_sky_condition_edge_cases(spark):
    got = _one(spark, sky_condition("s"), [(x,) for x, _ in SKY_CASES], "s string")
    assert got == [y for _, y in SKY_CASES]


def _sky_rule(s):
    """The rule as written in plain Python (look-ahead regex)."""
    if s is None or s == "":
        return "M"
    last = s.strip().split()
    last = last[-1] if last else ""
    m = re.search(r"[A-Za-z]+(?=\d*$)", last)
    return m.group(0) if m else "OTHER"


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="AOVCFEWB019 \t", max_size=14), min_size=1, max_size=20))
def test_sky_condition_matches_rule(spark, values):
    got = _one(spark, sky_condition("s"), [(v,) for v in values], "s string")
    assert got == [_sky_rule(v) for v in values]


def test_wind_speed(spark):
    got = _one(spark, wind_speed("s"), [("VR",), ("12",), ("x",), ("12.5",), (None,), ("0",)], "s string")
    assert got == [-1, 12, None, 12, None, 0]


def test_weather_type_and_precip(spark):
    assert _one(spark, weather_type("s"), [("M",), ("RA",), (None,), ("",)], "s string") == ["", "RA", None, ""]
    assert _one(spark, precip("s"), [("T",), (" ",), (None,), ("0.25",), ("x",)], "s string") == [
        0.0, 0.0, None, 0.25, None]


def test_split_hhmm(spark):
    df = spark.createDataFrame([(0,), (5,), (1259,), (2359,)], "t int")
    hh, mm = split_hhmm("t")
    assert [tuple(r) for r in df.select(hh, mm).collect()] == [(0, 0), (0, 5), (12, 59), (23, 59)]


def test_departure_ts(spark):
    rows = [(dt.date(2024, 1, 31), 5), (dt.date(2024, 1, 31), 2359), (dt.date(2024, 1, 31), 2400),
            (dt.date(2024, 2, 29), 960), (dt.date(2024, 2, 29), 1230), (dt.date(2024, 2, 29), -5)]
    got = _one(spark, departure_ts("d", "t"), rows, "d date, t int")
    assert got == [dt.datetime(2024, 1, 31, 0, 5), dt.datetime(2024, 1, 31, 23, 59), None, None,
                   dt.datetime(2024, 2, 29, 12, 30), None]


def test_arrival_ts_crosses_midnight_month_and_year(spark):
    rows = [(dt.datetime(2023, 12, 31, 22, 0), 150.0, 1.0),   # +2h30 +1h
            (dt.datetime(2024, 1, 31, 23, 0), 61.5, -2.0),    # +61m30s -2h
            (dt.datetime(2024, 3, 1, 0, 10), 30.0, 5.5)]      # fractional zone
    schema = "d timestamp_ntz, m double, z double"
    got = _one(spark, arrival_ts("d", "m", "z"), rows, schema)
    assert got == [dt.datetime(2024, 1, 1, 1, 30), dt.datetime(2024, 1, 31, 22, 1, 30),
                   dt.datetime(2024, 3, 1, 6, 10)]


def test_weather_ts(spark):
    rows = [(20240105, 7), (20240230, 1), (20241231, 23), (20240101, 24)]
    got = _one(spark, weather_ts("d", "h"), rows, "d int, h int")
    assert got == [dt.datetime(2024, 1, 5, 7), None, dt.datetime(2024, 12, 31, 23), None]


def test_week_of_month(spark):
    rows = [(dt.datetime(2024, 1, d, 12),) for d in (1, 7, 8, 10, 29, 31)]
    assert _one(spark, week_of_month("t"), rows, "t timestamp_ntz") == [1, 7, 1, 3, 1, 3]


def test_observation_dates(spark):
    rows = [(dt.datetime(2024, 1, 5, 11),), (dt.datetime(2024, 1, 5, 12),),
            (dt.datetime(2023, 12, 31, 23),)]
    got = _one(spark, observation_dates("t"), rows, "t timestamp_ntz")
    assert got == [[dt.date(2024, 1, 5)], [dt.date(2024, 1, 5), dt.date(2024, 1, 6)],
                   [dt.date(2023, 12, 31), dt.date(2024, 1, 1)]]


@pytest.mark.parametrize("tz", ["UTC", "America/New_York"])
def test_wall_clock_independent_of_session_zone(spark, tz):
    """NTZ arithmetic does not move across a DST change of the session zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        got = _one(spark, departure_ts("d", "t"), [(dt.date(2024, 3, 10), 230)], "d date, t int")
        assert got == [dt.datetime(2024, 3, 10, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_numbers_out_of_range_give_null(spark):
    df = spark.createDataFrame([("NaN",), ("1e12",), ("VR",), ("7.9",)], "t string")
    assert [r[0] for r in df.select(wind_speed("t")).collect()] == [None, None, -1, 7]
    df = spark.createDataFrame([(float("nan"),), (1e300,), (1.5,)], "d double")
    assert [r[0] for r in df.select(to_seconds("d", 60)).collect()] == [None, None, 90]
