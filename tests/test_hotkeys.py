"""Hot keys, packed windows and lists stored in buckets."""

import os
import re

import pytest
from pyspark.sql import functions as F

from aerowx.operators.hotkeys import HotKeys, find_hot_keys, key_hash
from aerowx.operators.observations import complete_lists
from aerowx.operators.packed import attach_packed, pack, unpack, widen_packed
from aerowx.operators.windows import DEST, ORIGIN, attach_windows, salted_lists, widen
from aerowx.plans import preprocess as PP
from aerowx.plans.explain import final_plan
from aerowx.sources import fixtures as FX
from aerowx.sources.liststore import store_lists
from conftest import SF_SMALL

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture(scope="module")
def prepared(spark):
    return PP.prepare(*(f(spark, SF_SMALL) for f in (FX.flights, FX.weather, FX.stations)))


@pytest.fixture
def shuffled(spark):
    before = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def expected(prepared):
    return sorted(widen(attach_windows(prepared.trips, complete_lists(prepared.observations))).collect(), key=str)


def trips(spark, rows):
    ts = F.timestamp_seconds(F.lit(1704100000)).cast("timestamp_ntz")
    return spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).cast("int").alias("ORIGIN_AIRPORT_ID"),
        (F.col("id") % 7).cast("int").alias("DEST_AIRPORT_ID"),
        ts.alias("CRS_DEP_TIMESTAMP"), ts.alias("SCHEDULED_ARRIVAL_TIMESTAMP"), F.col("id").cast("double").alias("ARR_DELAY_NEW"))


def test_hot_keys_are_those_above_the_share(spark):
    df = trips(spark, 30_000)
    origin, dest = find_hot_keys(df, (ORIGIN, DEST), share=0.2)
    want = {r["k"] for r in df.where("ORIGIN_AIRPORT_ID = 0").select(
        key_hash(F.col("ORIGIN_AIRPORT_ID"), F.to_date("CRS_DEP_TIMESTAMP")).alias("k")).distinct().collect()}
    assert set(origin.hashes) == want and origin.buckets == 6 and not dest      # 8 partitions, a third of the rows
    _, dest = find_hot_keys(df, (ORIGIN, DEST), share=0.1)
    assert len(dest.hashes) == 7
    assert not any(find_hot_keys(df.where("false"), (ORIGIN, DEST), share=0.1))
    assert not any(find_hot_keys(df, (ORIGIN, DEST), share=1.0))


def test_default_path_spreads_the_hub(spark, shuffled, prepared, expected):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        hot = find_hot_keys(prepared.keys, (ORIGIN, DEST))
        assert hot[0] and hot[0].buckets > 1                   # by the default share, no option set
        df = PP.packed_windows(prepared)
        hub = df.groupBy("ORIGIN_AIRPORT_ID", F.to_date("CRS_DEP_TIMESTAMP").alias("d")).count().orderBy(
            F.desc("count")).first()
        one = attach_packed(prepared.trips, pack(complete_lists(prepared.observations)), *ORIGIN, hot=hot[0])
        tasks = one.where((F.col("ORIGIN_AIRPORT_ID") == hub[0]) & (F.to_date("CRS_DEP_TIMESTAMP") == hub[1])).select(
            F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 1
        assert sorted(widen_packed(df).collect(), key=str) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_packed_windows_are_the_same_rows(prepared, expected):
    lists = pack(complete_lists(prepared.observations))
    df = attach_packed(attach_packed(prepared.trips, lists, *ORIGIN), lists, *DEST)
    assert sorted(widen_packed(df).collect(), key=str) == expected
    assert sorted(widen(unpack(df)).collect(), key=str) == expected


def test_packed_windows_are_narrower(spark, shuffled, prepared):
    """Bytes of a trip with its origin window, as the second exchange has them."""
    lists = complete_lists(prepared.observations)
    from aerowx.operators.windows import attach_window
    def size(df):
        path = f"{spark.conf.get('spark.checkpoint.dir')}/width-{id(df)}"
        df.write.option("compression", "none").parquet(path)
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))
    assert size(attach_packed(prepared.trips, pack(lists), *ORIGIN)) < size(attach_window(prepared.trips, lists, *ORIGIN))


@pytest.mark.parametrize("share", [None, 0.002])
def test_stored_lists_are_joined_without_an_exchange_and_released(spark, shuffled, prepared, expected, share):
    store = store_lists(pack(complete_lists(prepared.observations)))
    with store:
        df = widen_packed(PP.packed_windows(prepared, persist_lists=store, hot_share=share))
        rows, plan = final_plan(df)
        assert rows == len(expected)
        # from each scan of the lists up to its join: no exchange
        lines = [(re.match(r"[ :]*[+:]- ", x), x) for x in plan.splitlines()]
        lines = [(m.end(), x[m.end():]) for m, x in lines if m]
        scans = [i for i, (_, x) in enumerate(lines) if "FileScan" in x and "Bucketed: true" in x]
        assert len(scans) >= 2
        for i in scans:
            depth, above = lines[i][0], []
            for d, x in reversed(lines[:i]):
                if d < depth:
                    depth = d
                    above.append(x)
                    if re.match(r"(\*\(\d+\) )?\w*Join", x):
                        break
            assert "Join" in above[-1]
            assert not any(re.match(r"(Exchange|ShuffleQueryStage)", x) for x in above), above
        assert sorted(df.collect(), key=str) == expected
    assert not spark.catalog.tableExists(store.table) and not os.path.exists(store.path.removeprefix("file:"))


def test_no_hot_keys_leave_the_plan_alone(prepared):
    lists = pack(complete_lists(prepared.observations))
    plain = attach_packed(prepared.trips, lists, *ORIGIN, hot=HotKeys())
    assert "_lb" not in plain._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("hours", [1, 12, 24])
def test_salted_windows_are_the_same_rows(prepared, hours):
    want = PP.with_windows(prepared, hours=hours)
    cols = want.columns
    rows = lambda df: sorted(map(str, df.select(*cols).collect()))
    got = rows(PP.with_windows(prepared, hours=hours, salt=8))
    assert len(got) > 1000 and got == rows(want)
    assert got == rows(PP.with_windows(prepared, hours=hours, salt=3, colocate=True))
    if hours == 12:
        lists = complete_lists(prepared.observations)
        assert got == rows(attach_windows(prepared.trips, lists, salt=8))
        assert got == rows(attach_windows(prepared.trips, lists, salt=8, complete=False))


def test_lists_go_only_to_buckets_with_trips(spark):
    day = F.lit("2024-01-05").cast("date")
    lists = spark.range(100).select(F.col("id").cast("int").alias("_la"), day.alias("_ld"), F.lit("x").alias("_wl"))
    # airport 0 has 4,000 trips, 1 to 49 have one each, the others (and null) none
    keys = spark.range(4060).select(
        F.when(F.col("id") < 4000, 0).when(F.col("id") < 4049, F.col("id") - 3999).cast("int").alias("a"),
        (day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (F.col("id") % 7 + 3).cast("int"))).alias("t"), "id")
    got = salted_lists(lists, keys, "a", "t", 8).collect()
    assert len(got) == 8 + 49 and len({(r._la, r._lsalt) for r in got}) == 57
    assert {r._lsalt for r in got if r._la == 0} == set(range(8))
    assert all((r._lo, r._hi) == (3, 9) for r in got if r._la == 0) and all(r._lo == r._hi for r in got if r._la)
