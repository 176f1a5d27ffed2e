"""Encoding, class balancing, splitting and the random forest (Spark ML)."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import (StringIndexer, StringIndexerModel, VectorAssembler, VectorIndexer,
                                VectorIndexerModel)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerowx.functions.hashing import ROW_KEY, bucket, place
from aerowx.operators.encoding import (column_sizes, label_means, number_values, replace_by_mean,
                                       value_counts, with_numbers)
from aerowx.operators.features import TARGET, feature_columns
from aerowx.session import cut_lineage

ASSEMBLED = "assembled"
MARKED = "marked"
FEATURES = "features"
LABEL = "label"
# Fixed values that must equal the reference's for identical results.
INDEX_PREFIX = "indexed_"
CATEGORIES = 270
HANDLE_INVALID = "skip"
FOREST_DEPTH = 20
FOREST_SUBSAMPLE = 0.5
FOREST_MIN_INSTANCES = 20
GRID_PARALLELISM = 10
# Rows that one task of a fit walks, and the fewest tasks: every task makes, sends
# and has merged its own statistics of every node, of many more bins than a deep
# node has rows.
FIT_ROWS = 300_000
FIT_TASKS = 3
# Of a task's share of the heap, the part for the node statistics of a fit; the
# rest is for what sends and merges them.
STATS_SHARE = 0.75


@dataclass(frozen=True)
class ModelOptions:
    """What the encoder and the forest share or need.  ``categories`` is both
    the most values of a categorical feature and the number of bins: a forest
    needs a bin for every category.  A text column of more values becomes one
    ordered number, its label mean out of ``mean_folds`` folds with
    ``mean_prior`` rows of the overall mean."""
    categories: int = CATEGORIES
    handle_invalid: str = HANDLE_INVALID
    max_depth: int = FOREST_DEPTH
    subsampling: float = FOREST_SUBSAMPLE
    min_instances: int = FOREST_MIN_INSTANCES
    mean_folds: int = 5
    mean_prior: float = 20.0
    # deep trees: more node statistics per pass over the data (as far as a task's
    # share of the heap goes, see within_memory), and a cached row -> node map
    # instead of walking every tree again
    memory_mb: int = 1024
    cache_node_ids: bool = True


def key_of(df: DataFrame) -> Column:
    """The row's key: ``row_key`` if the frame has it, else a hash of the
    whole row (equal rows then share a place)."""
    return F.col(ROW_KEY) if ROW_KEY in df.columns else F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def encoder_for(df: DataFrame, options: ModelOptions = ModelOptions(), wide: Sequence[str] = (),
                by_mean: bool = True) -> Pipeline:
    """Text columns numbered by frequency (ties by value), all columns in one
    vector, and features of few values marked as categorical.  The ``wide``
    text columns are expected as numbers already: label means follow the
    others, unmarked (they have an order, not categories); without ``by_mean``
    they are numbers by frequency, too, in their places."""
    numeric, text = feature_columns(df)
    numbered = {c: INDEX_PREFIX + c for c in text if c not in wide}
    if not by_mean:
        indexed = [StringIndexer(inputCols=list(numbered), outputCols=list(numbered.values()),
                                 handleInvalid=options.handle_invalid)] if numbered else []
        return Pipeline(stages=[*indexed,
                                VectorAssembler(inputCols=[*[INDEX_PREFIX + c for c in text], *numeric],
                                                outputCol=ASSEMBLED, handleInvalid=options.handle_invalid),
                                VectorIndexer(inputCol=ASSEMBLED, outputCol=FEATURES, maxCategories=options.categories,
                                              handleInvalid=options.handle_invalid)])
    means = [INDEX_PREFIX + c for c in text if c in wide]
    marked = MARKED if means else FEATURES
    stages = []
    if numbered:
        stages.append(StringIndexer(inputCols=list(numbered), outputCols=list(numbered.values()),
                                    handleInvalid=options.handle_invalid))
    if numbered or numeric:
        stages += [VectorAssembler(inputCols=[*numbered.values(), *numeric], outputCol=ASSEMBLED,
                                   handleInvalid=options.handle_invalid),
                   VectorIndexer(inputCol=ASSEMBLED, outputCol=marked, maxCategories=options.categories,
                                 handleInvalid=options.handle_invalid)]
    if means:
        stages.append(VectorAssembler(inputCols=([marked] if stages else []) + means, outputCol=FEATURES,
                                      handleInvalid=options.handle_invalid))
    return Pipeline(stages=stages)


def feature_names(df: DataFrame, wide: Sequence[str] = ()) -> list[tuple[str, str]]:
    """("feature i", column) in feature-vector order; reads the schema only."""
    num, txt = feature_columns(df)
    cols = [INDEX_PREFIX + c for c in txt if c not in wide] + num + [INDEX_PREFIX + c for c in txt if c in wide]
    return [(f"feature {i}", c) for i, c in enumerate(cols)]


@dataclass(frozen=True)
class Encoder:
    """A fitted encoder.  ``means`` has the label means of the ``wide``
    columns, or ``numbers`` their numbers by frequency (a written table; none
    if there is no such column)."""
    model: PipelineModel
    wide: tuple[str, ...] = ()
    means: DataFrame | None = None
    options: ModelOptions = field(default_factory=ModelOptions)
    seed: int = 42
    numbers: DataFrame | None = None

    @property
    def stages(self):
        return self.model.stages

    def transform(self, df: DataFrame, seen: Column | None = None) -> DataFrame:
        """``df`` with its feature vector.  ``seen`` tells which rows were
        among those the encoder was fitted on (all, by default); their label
        means leave out their own fold."""
        if self.numbers is not None:
            df = numbered_wide(df, self.numbers, self.wide, keep_unknown=self.options.handle_invalid != "skip")
        elif self.wide:
            df = with_means(df, self.means, self.wide, self.options, self.seed, seen)
        return self.model.transform(df)


def mean_fold(df: DataFrame, options: ModelOptions, seed: int) -> Column:
    return bucket(key_of(df), "mean", seed, options.mean_folds)


def with_means(df: DataFrame, means: DataFrame, wide: Sequence[str], options: ModelOptions, seed: int,
               seen: Column | None = None) -> DataFrame:
    """Every wide column ``c`` as its label mean, ``indexed_c``."""
    cols = df.columns
    df = df.withColumns({"_fold": mean_fold(df, options, seed), "_seen": F.lit(True) if seen is None else seen})
    for c in wide:
        df = replace_by_mean(df, means, c, INDEX_PREFIX + c, F.col("_fold"), F.col("_seen"),
                             keep_unknown=options.handle_invalid != "skip")
    return df.select(*[f"`{c}`" for c in cols], *[f"`{INDEX_PREFIX}{c}`" for c in wide])


def numbered_wide(df: DataFrame, numbers: DataFrame, wide: Sequence[str], keep_unknown: bool) -> DataFrame:
    """``df`` with every wide column ``c`` as its number, ``indexed_c``."""
    for c in wide:
        df = with_numbers(df, numbers, c, INDEX_PREFIX + c, keep_unknown=keep_unknown)
    return df


def fit_encoder(df: DataFrame, options: ModelOptions = ModelOptions(), train_only: DataFrame | None = None,
                target: str = TARGET, seed: int = 42, by_mean: bool = True) -> Encoder:
    """Fit the encoder on ``df`` (or on ``train_only`` when given, to keep
    the held-out rows out of the category statistics).

    Text columns are told apart by their exact number of values; only those
    of at most ``options.categories`` send their values to the driver.  A
    forest has no bins for the others' categories and gets their label means;
    without ``by_mean`` every text column is numbered by frequency, whatever
    its number of values, and only the way to the numbers differs."""
    rows = train_only if train_only is not None else df
    _, text = feature_columns(rows)
    sizes = column_sizes(value_counts(rows, text)) if text else {}
    wide = tuple(c for c in text if sizes.get(c, 0) > options.categories)
    means = numbers = None
    if wide and not by_mean:
        numbers = cut_lineage(number_values(value_counts(rows, wide)))
        # a row without a number still counts among the other columns' values
        rows_fit = numbered_wide(rows, numbers, wide, keep_unknown=True)
    elif wide:
        means = cut_lineage(label_means(rows, wide, target, mean_fold(rows, options, seed),
                                        options.mean_folds, options.mean_prior))
        rows_fit = with_means(rows, means, wide, options, seed)
    else:
        rows_fit = rows
    return Encoder(encoder_for(rows, options, wide, by_mean).fit(rows_fit), wide, means, options, seed, numbers)


def number_text(df: DataFrame, encoder: Encoder) -> DataFrame:
    """``df``, on which ``encoder`` was fitted, with every text column ``c``
    numbered by frequency as ``indexed_c``: by the encoder's string indexer,
    and the wide columns, which it leaves out, across sorted partitions."""
    keep = encoder.options.handle_invalid != "skip"
    indexers = [s for s in encoder.stages if isinstance(s, StringIndexerModel)]
    if encoder.wide:
        numbers = encoder.numbers
        if numbers is None:
            numbers = cut_lineage(number_values(value_counts(df, encoder.wide)))
        df = numbered_wide(df, numbers, encoder.wide, keep)
    return reduce(lambda rows, s: s.transform(rows), indexers, df)


def assemble_numbered(df: DataFrame, encoder: Encoder) -> DataFrame:
    """``number_text`` with all numbers, then the numeric columns, as one
    vector."""
    numeric, text = feature_columns(df)
    return VectorAssembler(inputCols=[*[INDEX_PREFIX + c for c in text], *numeric], outputCol=ASSEMBLED,
                           handleInvalid=encoder.options.handle_invalid).transform(number_text(df, encoder))


def category_counts(df: DataFrame, encoder: Encoder) -> list[tuple[int, int]]:
    """(feature, categories) of each feature of ``assemble_numbered``: those that the
    encoder's vector indexer marked, and the exact number of values of a
    column that it does not mark (its categories would all pass through the
    driver; their number alone does)."""
    numeric, text = feature_columns(df)
    marked = {}
    for s in encoder.stages:
        if isinstance(s, VectorIndexerModel):
            inputs = [INDEX_PREFIX + c for c in text if c not in encoder.wide] + numeric
            marked = {inputs[i]: len(values) for i, values in s.categoryMaps.items()}
    sizes = column_sizes(value_counts(df, encoder.wide)) if encoder.wide else {}
    marked |= {INDEX_PREFIX + c: sizes[c] for c in encoder.wide}
    names = [*[INDEX_PREFIX + c for c in text], *numeric]
    return [(i, marked[c]) for i, c in enumerate(names) if c in marked]


def encode(df: DataFrame, model: Encoder, target: str = TARGET, seen: Column | None = None) -> DataFrame:
    """(features, label) rows, and the row's key if ``df`` has it; rows with an
    invalid value are skipped."""
    key = [ROW_KEY] if ROW_KEY in df.columns else []
    return model.transform(df, seen).select(FEATURES, F.col(target).alias(LABEL), *key)


def colocate(df: DataFrame, n: int | None, *cols: str, salt: int = 1) -> DataFrame:
    """Hash rows by ``cols`` into ``n`` partitions (``None``: leave it).  With
    ``salt`` > 1 the rows of one key are spread over as many buckets, by a
    hash of the whole row, so that a hot key is no single task's work."""
    if not n:
        return df
    bucket_ = [F.pmod(F.xxhash64(*df.columns), F.lit(salt))] if salt > 1 else []
    return df.repartition(n, *cols, *bucket_)


def balance(df: DataFrame, label_col: str = LABEL, seed: int = 42) -> DataFrame:
    """Down-sample the larger class to about the size of the smaller one (the
    smaller class is kept whole): a row of the larger stays if its place, a
    seeded hash of its key, lies below the ratio of the sizes.  The two class
    counts are the only values collected to the driver."""
    counts = {r[label_col]: r["count"] for r in df.groupBy(label_col).count().collect()}
    if len(counts) < 2:
        return df
    (major, nmax), (minor, nmin) = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))
    at = place(key_of(df), "balance", seed)
    return df.where((F.col(label_col) == minor) | ((F.col(label_col) == major) & (at < F.lit(nmin / nmax))))


def split(df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int | None = 42) -> list[DataFrame]:
    """Parts of the given weights by the place of each row's key, the same for
    any partitioning; rows of one key stay together."""
    return [df.where(c) for c in in_parts(df, weights, seed)]


def in_parts(df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int | None = 42) -> list[Column]:
    """For each part of ``split``, whether a row is in it."""
    at = place(key_of(df), "split", 42 if seed is None else seed)
    total, bounds = sum(weights), [0.0]
    for w in weights:
        bounds.append(bounds[-1] + w / total)
    bounds[-1] = 1.0
    return [(at >= F.lit(lo)) & (at < F.lit(hi)) for lo, hi in zip(bounds, bounds[1:])]


def for_fits(df: DataFrame, rows: int = FIT_ROWS, tasks: int = FIT_TASKS) -> DataFrame:
    """``df`` written in even partitions of at most about ``rows`` rows, and no
    more of them than that takes (but ``tasks``), for forests that are fitted
    side by side.  A forest's samples follow partitions and the order in them,
    which the written rows fix for every fit."""
    df = cut_lineage(df)                # counted and dealt without being made again
    return cut_lineage(df.repartition(max(tasks, math.ceil(df.count() / rows))))


def forest(num_trees: int, options: ModelOptions = ModelOptions(), seed: int | None = 42) -> RandomForestClassifier:
    rf = RandomForestClassifier(labelCol=LABEL, featuresCol=FEATURES, numTrees=num_trees,
                                maxDepth=options.max_depth, maxBins=options.categories,
                                subsamplingRate=options.subsampling, minInstancesPerNode=options.min_instances,
                                maxMemoryInMB=options.memory_mb, cacheNodeIds=options.cache_node_ids)
    return rf if seed is None else rf.setSeed(seed)


def task_memory_mb(spark: SparkSession) -> float:
    """MB of heap that a task may fill with objects of its own: what Spark's
    managed memory leaves of the smallest executor (of the driver, in local
    mode), shared among its tasks at a time."""
    context = spark.sparkContext
    inner, conf = context._jsc.sc(), context.getConf()
    entries, managed = inner.getExecutorMemoryStatus().iterator(), {}
    while entries.hasNext():
        entry = entries.next()
        managed[entry._1()] = entry._2()._1()
    if len(managed) > 1:
        managed.pop(inner.env().blockManager().blockManagerId().hostPort(), None)
    cores = int(conf.get("spark.executor.cores", "0")) or math.ceil(context.defaultParallelism / len(managed))
    fraction = float(conf.get("spark.memory.fraction", "0.6"))
    own = min(managed.values()) / (1 << 20) * (1 - fraction) / fraction
    return own / max(1, cores // int(conf.get("spark.task.cpus", "1")))


def within_memory(spark: SparkSession, options: ModelOptions) -> ModelOptions:
    """``options`` with no more node statistics per pass than a task has room
    for, as each task holds the whole of them: they grow with the nodes, and so
    with the rows, up to ``memory_mb``.  What does not fit takes another pass."""
    return replace(options, memory_mb=max(1, min(options.memory_mb, int(STATS_SHARE * task_memory_mb(spark)))))


def train_forest(train: DataFrame, num_trees: int, options: ModelOptions = ModelOptions(), seed: int | None = 42):
    return forest(num_trees, within_memory(train.sparkSession, options), seed).fit(train)


def together(df: DataFrame, jobs: Sequence[Callable], parallelism: int) -> list:
    """Run independent Spark jobs from driver threads, each in a scheduler
    pool of its own (pools share the cluster evenly where the session
    schedules fairly), and return their results in order."""
    context = df.sparkSession.sparkContext

    def pooled(numbered):
        i, job = numbered
        context.setLocalProperty("spark.scheduler.pool", f"fit-{i}")
        return job()

    with ThreadPoolExecutor(max(1, min(parallelism, len(jobs)))) as threads:
        return list(threads.map(inheritable_thread_target(df.sparkSession)(pooled), enumerate(jobs)))


def shard_of(df: DataFrame, shards: int, seed: int = 42) -> Column:
    return bucket(key_of(df), "shard", seed, shards)


def train_sharded(train: DataFrame, test: DataFrame, shards: int, num_trees: int,
                  options: ModelOptions = ModelOptions(), seed: int = 42, parallelism: int = 4) -> DataFrame:
    """A forest for each hashed shard of the training rows, trained side by
    side (``parallelism`` at a time); each scores the same shard of the test
    rows.  The predictions have their ``shard``; a shard without training rows
    scores nothing."""
    train = train.withColumn("shard", shard_of(train, shards, seed))
    test = test.withColumn("shard", shard_of(test, shards, seed))
    filled = [r["shard"] for r in train.select("shard").distinct().orderBy("shard").collect()]
    fit = lambda i: lambda: train_forest(train.where(F.col("shard") == i), num_trees, options, seed)
    models = together(train, [fit(i) for i in filled], parallelism)
    return reduce(DataFrame.unionByName,
                  [m.transform(test.where(F.col("shard") == i)) for i, m in zip(filled, models)])


FOLD = "fold"


def with_folds(df: DataFrame, folds: int, seed: int = 42) -> DataFrame:
    """Cross-validation folds by the row's key, so that they can be formed
    again anywhere."""
    return df.withColumn(FOLD, bucket(key_of(df), "fold", seed, folds))


def grid_search(train: DataFrame, num_trees: Sequence[int], depths: Sequence[int],
                min_instances: Sequence[int], folds: int = 3, parallelism: int = GRID_PARALLELISM,
                options: ModelOptions = ModelOptions(), seed: int = 42):
    """Cross-validated grid over trees x depth x min instances (AUC), on the
    folds of ``with_folds``; ``parallelism`` points of a fold are fitted side by
    side (few tasks a fit then still fill the cluster: see ``for_fits``)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    rf = forest(num_trees[0], within_memory(train.sparkSession, options), seed)
    grid = (ParamGridBuilder().addGrid(rf.numTrees, list(num_trees))
            .addGrid(rf.maxDepth, list(depths))
            .addGrid(rf.minInstancesPerNode, list(min_instances)).build())
    cv = CrossValidator(estimator=rf, estimatorParamMaps=grid,
                        evaluator=BinaryClassificationEvaluator(labelCol=LABEL),
                        numFolds=folds, parallelism=parallelism, seed=seed, foldCol=FOLD)
    return cv.fit(with_folds(train, folds, seed))


def grid_scores(cv_model) -> list[dict]:
    """The grid's points with their mean metric, best first (ties: the point
    of fewer trees, less depth, more instances)."""
    points = [{p.name: int(v) for p, v in pm.items()} | {"metric": m}
              for pm, m in zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics)]
    return sorted(points, key=lambda d: (-d["metric"], d["numTrees"], d["maxDepth"], -d["minInstancesPerNode"]))


def best_params(cv_model) -> dict:
    """Parameters of the grid point with the best mean metric."""
    return grid_scores(cv_model)[0]
