"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _star(edges: DataFrame) -> DataFrame:
    """Every edge (a, b), b < a, is hung to the smallest neighbour of ``a``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").select(
        F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        .alias("e")).select("e.*")
    return hung.where("a <> b")


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b), in either direction, repeats allowed -> node, root:
    every node of a link with the smallest node of its component.

    A round takes, for every node, the smallest of its neighbours and hangs
    its larger neighbours there (large star), then does the same downwards
    (small star).  Neighbourhoods are only ever reduced to their minimum and
    joined back, so a node of any degree is no single task's work.  Rounds
    grow with the logarithm of the longest chain and end when nothing moves.
    """
    down = F.struct(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = links.where("a <> b").select(down.alias("e")).select("e.*").distinct()
    spark, old, written = links.sparkSession, [], []
    edges, seen = materialize(edges, "links", written), None
    while True:
        old, written = written, []
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        edges = materialize(_star(large).distinct(), "links", written)
        discard(spark, old)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
