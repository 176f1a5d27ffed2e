"""CSV readers on files shaped like real exports."""

import datetime as dt
import os

import pytest

from aerowx.schemas import WEATHER_RAW, SchemaMismatch
from aerowx.session import scratch_path
from aerowx.sources.chunks import chunk_dirs, read_chunk_dirs, read_chunks, write_chunks
from aerowx.sources.csv import read_flights, read_stations, read_weather, write_csv


def _write(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as fh:
        fh.write(text)


def test_flights_by_header_name_with_trailing_comma(spark):
    path = scratch_path(spark, "csv-flights")
    if path.startswith("file:"):
        path = path[5:]
    # other column order, extra columns, trailing comma (empty 12th header)
    _write(path,
           "YEAR,FL_DATE,DEST_AIRPORT_ID,ORIGIN_AIRPORT_ID,CRS_DEP_TIME,CANCELLED,DIVERTED,"
           "CRS_ELAPSED_TIME,ARR_DELAY_NEW,WEATHER_DELAY,NAS_DELAY,\n"
           "2024,2024-01-05,12,10,0930,0.00,0.00,95.00,7.00,,,\n"
           "2024,2024-01-05,12,10,2400,1.00,0.00,,,,,\n")
    df = read_flights(spark, path)
    rows = df.collect()
    assert df.columns[:3] == ["FL_DATE", "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID"]
    r = rows[0]
    assert (r.FL_DATE, r.ORIGIN_AIRPORT_ID, r.DEST_AIRPORT_ID, r.CRS_DEP_TIME) == (dt.date(2024, 1, 5), 10, 12, 930)
    assert (r.CANCELLED, r.CRS_ELAPSED_TIME, r.ARR_DELAY_NEW, r.WEATHER_DELAY) == (0, 95.0, 7.0, None)
    assert rows[1].CANCELLED == 1 and rows[1].CRS_ELAPSED_TIME is None


def test_weather_keeps_sentinels(spark):
    path = scratch_path(spark, "csv-weather")
    if path.startswith("file:"):
        path = path[5:]
    _write(path,
           "WBAN,Date,Time,StationType,DryBulbCelsius,SkyCondition,Visibility,WindSpeed,WeatherType,HourlyPrecip\n"
           "10001,20240105,0951,AO2,M,FEW010 OVC100,10.00,VR,-RA FG+, \n"
           "10001,20240105,1051,AO2,-2.5,,M,7,M,T\n")
    rows = read_weather(spark, path).collect()
    assert rows[0].DryBulbCelsius == "M" and rows[0].WindSpeed == "VR" and rows[0].HourlyPrecip == " "
    assert rows[1].SkyCondition is None and rows[1].Visibility == "M" and rows[1].HourlyPrecip == "T"
    assert rows[0].Time == 951


def test_missing_required_column_raises(spark):
    path = scratch_path(spark, "csv-stations")
    if path.startswith("file:"):
        path = path[5:]
    _write(path, "AirportID,WBAN\n10,20\n")
    with pytest.raises(SchemaMismatch):
        read_stations(spark, path)


def test_files_with_another_header_raise(spark):
    path = scratch_path(spark, "csv-mixed")
    if path.startswith("file:"):
        path = path[5:]
    _write(path, "AirportID,WBAN,TimeZone\n10,10010,-5.0\n")
    with open(os.path.join(path, "part-1.csv"), "w") as fh:
        fh.write("WBAN,AirportID,TimeZone\n10009,9,-7.0\n")
    with pytest.raises(Exception, match="header"):
        read_stations(spark, path).collect()


def test_null_and_empty_text_survive_a_round_trip(spark):
    path = scratch_path(spark, "csv-marks")
    rows = [(1, 20240105, 900, None, "", " ", "M", "", None, "", "29")]
    df = spark.createDataFrame(rows, WEATHER_RAW)
    write_csv(df, path, nullValue="<null>")
    assert [tuple(r) for r in read_weather(spark, path, nullValue="<null>").collect()] == rows


def test_chunk_folders_of_a_small_table(spark):
    path = scratch_path(spark, "one-row")
    row = spark.createDataFrame([(1, 2, dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 5, 2), 3.0)],
                                "ORIGIN_AIRPORT_ID int, DEST_AIRPORT_ID int, CRS_DEP_TIMESTAMP timestamp_ntz, "
                                "SCHEDULED_ARRIVAL_TIMESTAMP timestamp_ntz, Class double")
    write_chunks(row, path)
    dirs = chunk_dirs(spark, path)
    assert len(dirs) == 1 and read_chunk_dirs(spark, dirs).count() == 1


def test_application_from_exports_to_a_model(spark):
    from aerowx.operators.model import ModelOptions
    from aerowx.plans.application import learn_from_chunks, preprocess_csv
    from aerowx.sources import fixtures as FX
    from conftest import SF_SMALL
    paths = [scratch_path(spark, f"app-{n}") for n in ("flights", "weather", "stations", "out")]
    for path, df in zip(paths, (FX.flights(spark, SF_SMALL), FX.weather(spark, SF_SMALL), FX.stations(spark, SF_SMALL))):
        write_csv(df, path, nullValue="<null>")
    out = preprocess_csv(spark, *paths, nullValue="<null>")
    result = learn_from_chunks(spark, out, num_trees=2, options=ModelOptions(max_depth=4))
    assert result.encoded_rows == 1333 and 0.0 <= result.auc <= 1.0


def test_chunks_are_written_where_their_rows_lie(spark):
    from pyspark.sql import functions as F
    path = scratch_path(spark, "in-place")
    df = spark.range(0, 600, 1, 3).selectExpr(
        "cast(id AS int) AS ORIGIN_AIRPORT_ID", "0 AS DEST_AIRPORT_ID", "timestamp_ntz'2024-01-05 00:00:00' AS CRS_DEP_TIMESTAMP",
        "timestamp_ntz'2024-01-05 02:00:00' AS SCHEDULED_ARRIVAL_TIMESTAMP", "1.0D AS Class")
    write_chunks(df, path, 4)
    found = read_chunks(spark, path).groupBy(F.input_file_name().alias("file")).agg(
        F.countDistinct(F.floor(F.col("ORIGIN_AIRPORT_ID") / 200)).alias("tasks"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in found) == 600 and len(chunk_dirs(spark, path)) == 4
    assert len(found) == 12 and {r.tasks for r in found} == {1}


def test_exports_of_the_application_are_compressed(spark):
    import glob
    from aerowx.plans.catalog import QUERIES
    from aerowx.session import ensure_checkpoint_dir
    from conftest import SF_SMALL
    files = lambda: set(glob.glob(ensure_checkpoint_dir(spark).removeprefix("file:")
                                  + "/aerowx-scratch/export-*/part-*"))
    before = files()
    assert QUERIES["application"](spark, SF_SMALL).count() == 1333
    made = files() - before
    assert made and all(f.endswith(".csv.gz") for f in made)
