"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the mix in proportion to its weight, but at most
``epochs`` times its own size.  The excess of capped sources is dealt again to
the others by weight until nothing is above its cap.  A source's target is
then met by whole repetitions of all its documents and one fractional
repetition, which takes documents in a seeded order until the rest of the
target is met; the document at the cut is taken if that comes nearer.

The order is a hash of the seed, doc_id and text.  The cut is found from the
sizes of 4096 ranges of that hash per source, and inside one range only, so no
task ever sees a source as a whole.  Rows of one source with the same doc_id
and text share a place.  They are counted, not listed; if the cut falls among
them, only those rows are numbered, by the partition that they were written in
and their position there, and as many are taken as come nearest to the target.

Defined cases: null text has size 0; a null source is a source of its own,
ranked last; a source of size 0 has target 0; with no words at all every
target is 0; rows without an id, or with the same, differ by their text; which
of the rows equal in source, doc_id and text are taken at the cut is open, how
many is not; very long texts are only counted and hashed; an empty table gives
no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2.0
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"
#: Hash ranges: the first three hex digits of the order.
RANGE_DIGITS = 3


def words(text: Column) -> Column:
    """Number of words; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def order_hash(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """The place in the order, of the id and the text (null: empty)."""
    def known(value: Column) -> Column:
        return F.coalesce(value.cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(seed + ":"), known(doc_id), F.lit(":"),
                          F.md5(known(text).cast("binary"))).cast("binary"))


def rank_sources(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """Adds ``weight``: the weights repeat over the sources by code point, null
    last.  Ranks are counted per sorted partition, then offset."""
    parts = materialize(sources.orderBy(F.col("source").asc_nulls_last())
                        .withColumn("part", F.spark_partition_id()), "mix-sources")
    offset, offsets = 0, []
    for r in parts.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():
        offsets.append((r["part"], offset))  # one entry for each sorted partition
        offset += r["n"]
    starts = sources.sparkSession.createDataFrame(offsets, "part int, before long")
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    place = (F.col("before") + inside - 1) % len(weights)
    return (parts.join(F.broadcast(starts), "part")
            .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")))
            .drop("part", "before"))


def water_fill(sources: DataFrame, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """``sources`` (source, source_size, weight) -> with ``target``.  Each
    round clamps the sources above their cap and deals the excess again; only
    sums reach the driver, and the level never falls, so rounds end."""
    cap = F.col("source_size") * F.lit(float(epochs))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    want, level, capped = share * total, 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) >= cap if capped >= 0 else F.lit(False)
        r = sources.agg(F.sum(F.when(full, cap).otherwise(0.0)).alias("caps"),
                        F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("open"),
                        F.sum(F.when(full, 1).otherwise(0)).alias("n")).first()
        if not r["open"] or r["n"] == capped:
            break
        level, capped = (want - r["caps"]) / r["open"], r["n"]
    # all capped: nothing is open, every target is its cap
    full = F.lit(True) if r["open"] == 0 else F.col("weight") * F.lit(level) >= cap
    return sources.withColumn("target", F.when(full, cap).otherwise(F.col("weight") * F.lit(level)))


def cuts(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: ``whole`` repetitions; ``upto``, the last place in the order
    that the fractional repetition takes from; and ``copies``, how many of the
    rows at that place it takes.  ``sized``: source, size, place."""
    src = targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                             .otherwise(0).cast("int"))
    src = src.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    sized = sized.withColumn("range", F.substring("place", 1, RANGE_DIGITS))
    ranges = sized.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    by_range = Window.partitionBy("source").orderBy("range")  # at most 16**RANGE_DIGITS rows
    ranges = ranges.withColumn("before", F.sum("range_size").over(by_range) - F.col("range_size"))
    named = src.select(F.col("source").alias("s"), "rest")
    cut = (ranges.join(named, F.col("source").eqNullSafe(F.col("s")))
           .where((F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("range_size")))
           .select("s", F.col("range").alias("cut_range"), "before", "rest"))
    inside = sized.join(cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("cut_range")))
    # equal rows are one place: a size and a number, counted before they meet
    at = inside.groupBy("s", "cut_range", "before", "rest", "place", "size").agg(F.count("*").alias("n"))
    run = F.sum(F.col("size") * F.col("n")).over(Window.partitionBy("s", "cut_range").orderBy("place")
                                                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    at = at.withColumn("left", F.col("rest") - (F.col("before") + run - F.col("size") * F.col("n")))
    # copies whose middle lies before the cut
    fit = F.ceil((2 * F.col("left") - F.col("size")) / F.nullif(2 * F.col("size"), F.lit(0)))
    at = at.withColumn("copies", F.when(F.col("size") == 0, F.when(F.col("left") > 0, F.col("n")).otherwise(0))
                       .otherwise(F.least(fit, F.col("n"))))
    last = (at.groupBy("s").agg(F.max(F.when(F.col("copies") > 0, F.struct("place", "copies"))).alias("last"),
                                F.max("cut_range").alias("cut_range"))
            .select("s", F.coalesce("last.place", "cut_range").alias("upto"), F.col("last.copies").alias("copies")))
    return (src.join(last, F.col("source").eqNullSafe(F.col("s")), "left")
            .select("source", "source_size", "weight", "target", "whole",
                    F.coalesce("upto", F.lit("")).alias("upto"), F.coalesce("copies", F.lit(0)).alias("copies")))


def plan_mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: float = EPOCHS,
             seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """(sized documents, one row per source with target and cut), both written
    to the shared folder."""
    sized = materialize(docs.select("doc_id", "source", words(F.col("text")).alias("size"),
                                    order_hash(F.col("doc_id"), F.col("text"), seed).alias("place")), "mix-sized")
    sources = rank_sources(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    return sized, materialize(cuts(sized, materialize(water_fill(sources, share, epochs), "mix-targets")), "mix-cuts")


def repeated(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (``key``, the source, and ``place``) with the plan of their
    source and ``repetitions``.  Only the rows at a source's last place are
    numbered: a partition's numbers start where those before it end."""
    rows = rows.join(plan, F.col("key").eqNullSafe(F.col("source")))
    clear = rows.where(F.col("place") != F.col("upto")).withColumn(
        "repetitions", F.col("whole") + (F.col("place") < F.col("upto")).cast("int"))
    at_cut = materialize(rows.where(F.col("place") == F.col("upto"))
                         .withColumn("part", F.spark_partition_id())
                         .withColumn("row_at", F.monotonically_increasing_id()), "mix-at-cut")
    parts = at_cut.groupBy(F.col("key").alias("k"), F.col("part").alias("p")).agg(F.count("*").alias("n"))
    starts = parts.withColumn("start", F.sum("n").over(Window.partitionBy("k").orderBy("p")) - F.col("n"))
    number = F.row_number().over(Window.partitionBy("key", "part").orderBy("row_at"))  # one written partition
    numbered = (at_cut.withColumn("number", number)
                .join(starts, F.col("key").eqNullSafe(F.col("k")) & (F.col("part") == F.col("p"))))
    taken = numbered.withColumn("repetitions", F.col("whole") + (
        F.col("start") + F.col("number") <= F.col("copies")).cast("int"))
    return clear.unionByName(taken.select(*clear.columns))


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken,
    repetitions.  ``docs`` needs doc_id, source and text."""
    sized, plan = plan_mix(docs, **options)
    return repeated(sized.withColumnRenamed("source", "key"), plan).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("repetitions")).alias("taken"),
        "repetitions")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes
    it, with all their columns."""
    seed = options.get("seed", SEED)
    _, plan = plan_mix(docs, **options)
    rows = docs.select(F.struct("*").alias("row"), F.col("source").alias("key"),
                       order_hash(F.col("doc_id"), F.col("text"), seed).alias("place"))
    return (repeated(rows, plan)
            .select("row", F.explode(F.array_repeat(F.lit(1), F.col("repetitions"))).alias("repetition"))
            .select("row.*"))
