"""Numbers for text columns of any number of values.

Every table here has a row per distinct value and stays distributed; the
driver sees one row per column, or one per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerowx.session import cut_lineage

_ROW_IN_PARTITION = (1 << 33) - 1      # low bits of monotonically_increasing_id


def _long(df: DataFrame, cols: Sequence[str], *others: Column) -> DataFrame:
    """(column_name, value, others): a row for each non-null value of each
    column.  The rows are aggregated in the task that makes them."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("value")) for c in cols])
    return (df.select(F.explode(cells).alias("_c"), *others)
              .select("_c.*", *[F.col(o) for o in df.select(*others).columns])
              .where(F.col("value").isNotNull()))


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value, count), from one partially aggregated pass."""
    return _long(df, cols).groupBy("column_name", "value").count()


def column_sizes(counts: DataFrame) -> dict[str, int]:
    """Distinct values of each column of ``value_counts``."""
    return {r.column_name: r["count"] for r in counts.groupBy("column_name").count().collect()}


def number_values(counts: DataFrame) -> DataFrame:
    """(column_name, value, index): the values of each column numbered from 0
    by falling count, ties by value, as ``StringIndexer`` numbers them.

    The values are range-partitioned and sorted; a value's number is its
    position in its partition plus the rows of the partitions before, less
    where its column starts.  Only those two offset tables are broadcast: a
    row per partition, and a row per column.
    """
    order = [F.col("column_name"), F.col("count").desc(), F.col("value")]
    placed = cut_lineage(counts.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "column_name", "value", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_IN_PARTITION)).alias("at")))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("part").count().select(
        "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    ranked = placed.join(F.broadcast(offsets), "part").withColumn("rank", F.col("before") + F.col("at"))
    starts = ranked.groupBy("column_name").agg(F.min("rank").alias("start"))
    return ranked.join(F.broadcast(starts), "column_name").select(
        "column_name", "value", (F.col("rank") - F.col("start")).cast("double").alias("index"))


def with_numbers(df: DataFrame, numbers: DataFrame, col: str, out: str, keep_unknown: bool = False) -> DataFrame:
    """``df`` with ``out``, the number of ``col`` in ``numbers`` (of
    ``number_values``, written already).  A null or unknown value drops the
    row, or is null with ``keep_unknown``."""
    of_col = numbers.where(F.col("column_name") == col).select(F.col("value").alias("_v"), F.col("index").alias(out))
    return df.join(of_col, df[f"`{col}`"] == of_col["_v"], "left" if keep_unknown else "inner").drop("_v")


def label_means(df: DataFrame, cols: Sequence[str], label: str, fold: Column, folds: int,
                prior: float) -> DataFrame:
    """(column_name, value, mean, fold_means): the label's mean of each value,
    over all rows and over the rows outside each fold (``fold_means[k]``).

    ``prior`` rows of the overall mean (outside the fold, too) are added to
    each, so a rare value stays near it.  One aggregate over the rows; its
    buffer has two sums per fold.
    """
    y = F.col(label).cast("double")
    rows = _long(df, cols, y.alias("_y"), fold.alias("_f"))
    in_fold = lambda k, c: F.coalesce(F.sum(F.when(F.col("_f") == k, c)), F.lit(0.0))
    sums = [F.sum(F.lit(1.0)).alias("n"), F.coalesce(F.sum("_y"), F.lit(0.0)).alias("y"),
            *[in_fold(k, F.lit(1.0)).alias(f"n{k}") for k in range(folds)],
            *[in_fold(k, F.col("_y")).alias(f"y{k}") for k in range(folds)]]
    total = df.select(y.alias("_y"), fold.alias("_f")).agg(*sums).first()

    def smoothed(n: Column, s: Column, all_n: float, all_y: float) -> Column:
        base = all_y / all_n if all_n else 0.0
        return (s + F.lit(prior * base)) / (n + F.lit(float(prior)))

    n, s = F.col("n"), F.col("y")
    whole_n, whole_y = total["n"] or 0.0, total["y"] or 0.0
    outside = [smoothed(n - F.col(f"n{k}"), s - F.col(f"y{k}"), whole_n - total[f"n{k}"], whole_y - total[f"y{k}"])
               for k in range(folds)]
    return rows.groupBy("column_name", "value").agg(*sums).select(
        "column_name", "value", smoothed(n, s, whole_n, whole_y).alias("mean"), F.array(*outside).alias("fold_means"))


def replace_by_mean(df: DataFrame, means: DataFrame, col: str, out: str, fold: Column, seen: Column,
                    keep_unknown: bool = False) -> DataFrame:
    """``df`` with ``out``, the label mean of ``col``: of the rows outside the
    row's own fold where ``seen`` (the row was among those averaged), else of
    all.  A null or unknown value drops the row, or is null with
    ``keep_unknown``.

    ``means`` should be written already (it is read once per column): then
    both sides of the join have exchanges of their own, and Spark broadcasts a
    small table or splits a hot value, by the bytes it measures.
    """
    of_col = means.where(F.col("column_name") == col).select(
        F.col("value").alias("_v"), F.col("mean").alias("_m"), F.col("fold_means").alias("_fm"))
    number = F.when(seen, F.get("_fm", fold)).otherwise(F.col("_m"))
    joined = df.join(of_col, df[f"`{col}`"] == of_col["_v"], "left" if keep_unknown else "inner")
    return joined.withColumn(out, number).drop("_v", "_m", "_fm")
