"""Global order by partition and position; chunks replaced in one step."""

import os

import pytest
from pyspark.sql import functions as F

from aerowx.operators.order import out_of_order
from aerowx.sources import chunks as CH


def frame(spark, n, at=0):
    ts = F.timestamp_seconds(F.lit(1704100000) + F.col("id")).cast("timestamp_ntz")
    return spark.range(at, at + n).select(
        F.col("id").cast("int").alias("ORIGIN_AIRPORT_ID"), F.lit(1).alias("DEST_AIRPORT_ID"),
        ts.alias("CRS_DEP_TIMESTAMP"), ts.alias("SCHEDULED_ARRIVAL_TIMESTAMP"), F.col("id").cast("double").alias("Class"))


def test_order_is_proven_and_disorder_found(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("a"), (F.col("id") % 3).alias("b"))
    check = lambda d, c: tuple(out_of_order(d, c).first())
    assert check(df.orderBy("b", "a"), ["b", "a"]) == (5000, 0)
    assert check(df.orderBy("b"), ["b", "a"])[1] > 0
    assert check(df.orderBy("b", "a").repartition(4), ["b", "a"])[1] > 0
    # sorted inside the partitions only: the bounds tell
    assert check(df.repartition(4).sortWithinPartitions("a"), ["a"]) == (5000, 3)
    assert check(df.orderBy(F.desc("a")), ["a"])[1] > 4000
    assert check(df.where("a < 0").orderBy("a"), ["a"]) == (0, 0)


def test_failed_write_leaves_the_old_chunks(spark, tmp_path):
    path = str(tmp_path / "chunks")
    CH.write_chunks(frame(spark, 300), path, 5)
    old = sorted(CH.read_chunks(spark, path).collect())
    assert len(old) == 300 and len(CH.chunk_dirs(spark, path)) == 5
    bad = frame(spark, 100).withColumn("Class", F.when(F.col("ORIGIN_AIRPORT_ID") == 99, F.raise_error(F.lit("no")))
                                       .otherwise(F.col("Class")))
    with pytest.raises(Exception, match="no"):
        CH.write_chunks(bad, path, 5)
    assert sorted(CH.read_chunks(spark, path).collect()) == old
    assert sorted(CH.read_chunk_dirs(spark, CH.chunk_dirs(spark, path)).collect()) == old
    # the next write replaces them, may read what it replaces, and leaves one version
    CH.write_chunks(CH.read_chunks(spark, path).where("ORIGIN_AIRPORT_ID < 50").unionByName(frame(spark, 10, 1000)), path, 5)
    assert CH.read_chunks(spark, path).count() == 60
    assert CH.read_chunks(spark, path, [0, 1]).count() < 60
    assert len([d for d in os.listdir(path) if d.startswith("data-")]) == 1
    assert spark.read.parquet(path).count() == 60
