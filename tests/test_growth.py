"""What must hold as the tables grow: who is broadcast, and what one task gets."""

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from aerowx.functions.hashing import ROW_KEY
from aerowx.operators import features as FT
from aerowx.operators import model as MD
from aerowx.operators import observations as O
from aerowx.operators import stations as S
from aerowx.operators import weather as W
from aerowx.operators import windows as WN
from aerowx.plans import catalog as CAT
from aerowx.plans.oracle import oracle_sql
from aerowx.sources import fixtures as FX

STATIONS = 1200


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Base tables of more stations than one task's share or a forest's bins."""
    d = str(tmp_path_factory.mktemp("growth"))
    made = {
        "supplier": spark.range(STATIONS).selectExpr("id AS s_suppkey", "cast(id % 25 AS int) AS s_nationkey"),
        "customer": spark.range(900).selectExpr("id AS c_custkey", "cast(id % 25 AS int) AS c_nationkey"),
        "orders": spark.range(3000).selectExpr("id AS o_orderkey", "(id * 7) % 900 AS o_custkey",
                                               "cast(1000 + id * 17 AS double) AS o_totalprice"),
        "events": spark.range(2000).selectExpr(
            "id AS event_id", "timestamp'2024-01-03 00:10:00' + make_interval(0, 0, 0, 0, cast(id % 400 AS int)) AS ts",
            "id % 1500 AS user_id", "element_at(array('view', 'click', 'error', 'signup', 'purchase'), "
            "cast(id % 5 + 1 AS int)) AS event_type", "cast(id AS double) AS value"),
    }
    for name, df in made.items():
        df.coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d


@pytest.mark.parametrize("query", ["cast_measures", "project_weather", "hourly_precip"])
def test_readings_are_never_the_broadcast_side(spark, tables, query):
    plan = CAT.QUERIES[query](spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"HashJoin \[WBAN#\d+\], \[_w#\d+\], Inner, (\w+)", plan) == ["BuildRight"], plan


def test_served_airports_are_the_pairs_of_the_trips(spark):
    trips = spark.createDataFrame([(1, 2), (2, 2), (5, 1), (None, 1), (7, 7)],
                                  "ORIGIN_AIRPORT_ID int, DEST_AIRPORT_ID int")
    # twice the same station, two stations of an airport, nulls, and airports that no trip has
    st = spark.createDataFrame([(1, 101, -5.0), (1, 101, -5.0), (2, 102, -6.0), (2, 202, -6.0), (3, 103, -5.0),
                                (7, None, -5.0), (None, 108, -5.0)], "AirportID int, WBAN int, TimeZone double")
    got = S.served_airports(trips, st)
    assert got.columns == ["AIRPORT_ID", "F_WBAN"]
    want = S.all_airports(S.attach_stations(trips, st))
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(got) == rows(want) and got.count() == 4


def test_no_task_makes_the_readings_of_many_stations(spark, tables):
    per_task = FX._grid_readings(spark, tables).groupBy(F.spark_partition_id()).agg(
        F.countDistinct("WBAN").alias("n")).collect()
    assert sum(r.n for r in per_task) == STATIONS
    assert max(r.n for r in per_task) < STATIONS / 2


def test_grid_of_no_stations_is_empty(spark, tables, tmp_path):
    spark.read.parquet(f"{tables}/supplier.parquet").limit(0).write.parquet(str(tmp_path / "supplier.parquet"))
    assert FX._grid_readings(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("query", ["string_index", "assemble_vector", "vector_index"])
def test_encoder_steps_with_more_airports_than_bins(spark, tables, query):
    """Against the oracle's SQL, with so many airports that no indexer takes them."""
    con, sql = duckdb.connect(), oracle_sql()
    for name in ("supplier", "customer", "orders", "events"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tables}/{name}.parquet/*.parquet')")
    con.execute("CREATE VIEW labels AS SELECT 0 AS quality, 0 AS toxic")
    got = CAT.QUERIES[query](spark, tables)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({sql[query]})").fetchall()
    rows = sorted(tuple(r) for r in got.collect())
    assert len(rows) > 3 and rows == sorted(want)
    if query == "vector_index":
        assert max(n for _, n in rows) > 270


def test_numbers_of_narrow_and_wide_columns_together(spark):
    df = spark.range(900).selectExpr("concat('w', id % 300) AS wide", "concat('n', id % 7) AS narrow",
                                     "cast(id % 5 AS int) AS hour", "cast(id % 2 AS int) AS Target")
    encoder = MD.fit_encoder(df)
    assert encoder.wide == ("wide",)
    rows = MD.assemble_numbered(df, encoder).select("wide", "narrow", "hour", F.col(MD.ASSEMBLED)).collect()
    order = {c: {v: i for i, (v, _) in enumerate(sorted(Counter(r[c] for r in rows).items(), key=lambda x: (-x[1], x[0])))}
             for c in ("wide", "narrow")}
    assert len(rows) == 900
    assert all(list(r[MD.ASSEMBLED]) == [order["wide"][r.wide], order["narrow"][r.narrow], r.hour] for r in rows)
    assert MD.category_counts(df, encoder) == [(0, 300), (1, 7), (2, 5)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_without_weather_collect_no_reading(spark, tables):
    c = CAT.Ctx(spark, tables)
    plan = _plan(FT.prepare_features(c.ml, 45))
    assert "bit_or" in plan and "collect_list" not in plan and "avg(" not in plan, plan
    assert "collect_list" in _plan(CAT.pivot_window(spark, tables))


def test_a_day_of_readings_is_windowed_once(spark, tables):
    plan = _plan(CAT.Ctx(spark, tables).obs)
    assert len(re.findall(r"\bWindow \[", plan)) == 3 and "SortAggregate" not in plan, plan
    assert len(re.findall(r"\bSort \[AIRPORT_ID#\d+ ASC NULLS FIRST, Date", plan)) == 1, plan


def test_hour_windows_are_not_exchanged(spark, tables):
    c = CAT.Ctx(spark, tables)
    exchanged = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(WN.attach_windows_frame(c.trips, c.obs)))
    assert exchanged and not any("_w" in keys or "hour" in keys for keys in exchanged), exchanged


def _observations(spark, hours):
    """(airport, hour of January 2024 or None) as observations."""
    rows = spark.createDataFrame(hours, "a int, h int")
    at = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("h"))
    return rows.select(F.col("a").alias("AIRPORT_ID"), at.alias("Weather_TIMESTAMP"), F.col("h").cast("double").alias("DryBulbCelsius"),
                       F.lit("CLR").alias("SkyCondition"), F.lit(1.0).alias("Visibility"), F.lit(2.0).alias("WindSpeed"),
                       F.lit(None).cast("string").alias("WeatherType"), F.lit(0.0).alias("HourlyPrecip"))


@pytest.mark.parametrize("hours", [1, 12, 24])
def test_complete_lists_from_one_aggregate(spark, hours):
    days = [(1, h) for h in range(96)]
    days += [(2, h) for h in range(96) if h != 50]                       # one hour missing
    days += [(3, 49 if h == 50 else h) for h in range(96)]               # another doubled in its place
    days += [(4, h) for h in range(96)] + [(4, 60), (4, None), (None, 3)]  # one too many, nulls
    obs = _observations(spark, days)
    rows = lambda df: sorted(map(str, df.collect()))
    got = O.complete_lists(obs, hours)
    assert got.columns == ["AIRPORT_ID", "obs_date", "Weather_List"]
    assert rows(got) == rows(O.complete(O.observation_lists(obs, hours), hours))
    assert {r.AIRPORT_ID for r in got.select("AIRPORT_ID").distinct().collect()} == {1, 2, 3, 4}


def test_first_of_an_hour_in_both_forms(spark):
    w = spark.createDataFrame([(1, 20240101, 5, 10, 1.0), (1, 20240101, 5, 3, None), (1, 20240101, 6, 0, 2.0),
                               (1, 20240101, None, None, 4.0), (1, None, 5, 7, 3.0), (None, 20240101, 5, 9, 5.0),
                               (1, 20240102, 5, 59, 6.0)],
                              "AIRPORT_ID int, Date int, Time_hh int, Time_mm int, DryBulbCelsius double")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(W.first_by_hour(w)) == rows(W.first_reading_per_hour(w))


def test_frame_windows_by_hour_as_lists(spark):
    """Both forms of the join, with trips at the edges of a day and hour."""
    obs = _observations(spark, [(a, h) for a in (1, 2) for h in range(120)])
    trips = spark.range(300).selectExpr(
        "cast(id % 3 AS int) AS ORIGIN_AIRPORT_ID", "cast((id + 1) % 3 AS int) AS DEST_AIRPORT_ID",
        "IF(id % 17 = 0, NULL, timestamp_ntz'2024-01-02 00:00:00' + make_dt_interval(0, cast(id % 72 AS int), cast(id % 60 AS int))) "
        "AS CRS_DEP_TIMESTAMP", "timestamp_ntz'2024-01-02 23:59:00' + make_dt_interval(0, cast(id % 26 AS int)) "
        "AS SCHEDULED_ARRIVAL_TIMESTAMP", "cast(id AS double) AS ARR_DELAY_NEW")
    rows = lambda df: sorted(map(str, WN.window_summary(df, "WO_List", "WD_List").collect()))
    got = rows(WN.attach_windows_frame(trips, obs))
    assert len(got) > 50 and got == rows(WN.attach_windows(trips, O.complete_lists(obs)))


def test_rows_for_fits_lie_in_few_even_tasks(spark):
    rows = spark.range(5200).repartition(40, F.col("id") % 3)       # three uneven partitions, 37 empty ones
    got = MD.for_fits(rows, rows=1000)
    sizes = [len(p) for p in got.rdd.glom().collect()]
    assert len(sizes) == 6 and max(sizes) - min(sizes) <= 40
    ids = [r.id for r in got.collect()]
    assert sorted(ids) == list(range(5200)) and ids == [r.id for r in got.collect()]
    assert MD.for_fits(rows).rdd.getNumPartitions() == MD.FIT_TASKS
    assert MD.for_fits(rows.limit(0)).count() == 0


def test_grid_rows_do_not_follow_the_shuffle_partitions(spark, tables):
    """Every task of a fit has statistics of its own for every node."""
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "24",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        c = CAT.Ctx(spark, tables)
        rows = CAT._grid_rows(c)
        want = MD.split(MD.balance(c.encoded))[0]
        seen = lambda df: sorted((r[ROW_KEY], r.label, tuple(r.features)) for r in df.collect())
        assert rows.rdd.getNumPartitions() == MD.FIT_TASKS
        assert seen(rows) == seen(want) and rows.count() > 100
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_encode_pipeline_does_not_change_with_the_number_of_airports(spark, tables):
    """Against the oracle's SQL: numbers in their places, not label means behind the hours."""
    con = duckdb.connect()
    for name in ("supplier", "customer", "orders", "events"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tables}/{name}.parquet/*.parquet')")
    con.execute("CREATE VIEW labels AS SELECT 0 AS quality, 0 AS toxic")
    got = CAT.QUERIES["encode_pipeline"](spark, tables)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({oracle_sql()['encode_pipeline']})").fetchall()
    rows = sorted(tuple(r) for r in got.collect())
    assert max(r[0] for r in rows) > 270 and rows == sorted(want)


def test_numbered_encoding_is_the_same_above_and_below_the_bins(spark):
    df = spark.range(900).selectExpr(
        "IF(id % 50 = 0, NULL, concat('w', id * id % 300)) AS wide", "IF(id % 70 = 0, NULL, concat('n', id % 7)) AS narrow",
        "cast(3 * (id % 5) AS int) AS hour", "cast(id % 2 AS int) AS Target", "id AS row_key")
    n = df.select("wide").distinct().count()
    def vectors(categories):
        options = MD.ModelOptions(categories=categories)
        encoder = MD.fit_encoder(df, options, by_mean=False)
        return encoder.wide, {r[ROW_KEY]: list(r[MD.FEATURES]) for r in MD.encode(df, encoder).collect()}
    few, many = vectors(n - 2), vectors(n)
    assert few[0] == ("wide",) and many[0] == () and few[1] == many[1]
    assert len(few[1]) == df.where("wide IS NOT NULL AND narrow IS NOT NULL").count()
    assert {v[2] for v in few[1].values()} == {0.0, 1.0, 2.0, 3.0, 4.0}


def test_a_task_of_a_fit_has_more_rows_than_nodes_have_bins(spark):
    """600,000 rows are no reason for more tasks, each with statistics of every node."""
    rows = MD.for_fits(spark.range(0, 600_000, 1, 12).toDF("id"))
    assert rows.rdd.getNumPartitions() == MD.FIT_TASKS and rows.count() == 600_000
