"""Proof that a frame is sorted across its partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerowx.session import cut_lineage


def out_of_order(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """(n_rows, n_out_of_order): neighbouring rows whose ``cols`` fall, both
    inside a partition, by position, and from the last row of a partition to
    the first of the next one that has rows.  Zero for a sorted frame.

    Positions are taken where the rows lie and written.  A partition's rows
    are compared in one task, as they were sorted; across partitions only one
    row for each is compared."""
    key = F.struct(*[F.col(c).alias(f"k{i}") if isinstance(c, str) else c.alias(f"k{i}") for i, c in enumerate(cols)])
    placed = cut_lineage(df.select(key.alias("key"), F.spark_partition_id().alias("part"),
                                   F.monotonically_increasing_id().alias("at")))
    before = F.lag("key").over(Window.partitionBy("part").orderBy("at"))
    inside = placed.withColumn("_b", before).groupBy("part").agg(
        F.count("*").alias("n"), F.count_if(F.col("_b") > F.col("key")).alias("falls"),
        F.min_by("key", "at").alias("first"), F.max_by("key", "at").alias("last"))
    last = F.lag("last").over(Window.orderBy("part"))
    bounds = inside.withColumn("_l", last)
    return bounds.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                      F.coalesce(F.sum(F.col("falls") + F.coalesce((F.col("_l") > F.col("first")).cast("long"), F.lit(0))),
                                 F.lit(0)).alias("n_out_of_order"))
