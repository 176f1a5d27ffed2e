"""Text columns of any size, and samples by the rows' own keys."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from aerowx.functions.hashing import ROW_KEY, bucket, place
from aerowx.operators import encoding as E
from aerowx.operators import metrics as M
from aerowx.operators import model as MD

SMALL = MD.ModelOptions(max_depth=4, min_instances=2)


def trips(spark, airports, rows=None):
    """(airport, hour, Target, row_key); the label depends on the airport."""
    df = spark.range(rows or airports * 8)
    return df.select(F.concat(F.lit("A"), (F.col("id") % airports)).alias("airport"),
                     (F.col("id") % 24).cast("int").alias("hour"),
                     F.when((F.col("id") % airports) % 3 == 0, 1).otherwise(0).alias("Target"),
                     F.col("id").alias(ROW_KEY))


@pytest.mark.parametrize("airports", [270, 271, 5000])
def test_forest_trains_with_any_number_of_airports(spark, airports):
    df = trips(spark, airports)
    encoder = MD.fit_encoder(df, SMALL)
    assert encoder.wide == (() if airports <= 270 else ("airport",))
    enc = MD.encode(df, encoder).persist()
    assert enc.count() == df.count()
    scored = MD.train_forest(enc, 3, SMALL).transform(enc)
    assert M.auc(scored, score_col="rawPrediction") > 0.9
    names = [c for _, c in MD.feature_names(df, encoder.wide)]
    assert names == (["indexed_airport", "hour"] if airports <= 270 else ["hour", "indexed_airport"])
    enc.unpersist()


def test_label_means_leave_out_the_own_fold(spark):
    df = trips(spark, 300, 1500)
    options = MD.ModelOptions()
    encoder = MD.fit_encoder(df, options)
    got = MD.with_means(df.withColumn("f", MD.mean_fold(df, options, 42)), encoder.means, encoder.wide, options, 42)
    rows = got.collect()
    per, total = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        for k in range(options.mean_folds):
            if r.f != k:
                per[r.airport, k].update(n=1, y=r.Target)
                total[k].update(n=1, y=r.Target)
    for r in rows:
        c, t = per[r.airport, r.f], total[r.f]
        want = (c["y"] + options.mean_prior * t["y"] / t["n"]) / (c["n"] + options.mean_prior)
        assert math.isclose(r.indexed_airport, want, rel_tol=1e-12)
    # rows that were not fitted take the mean of all; unknown and null ones go
    new = spark.createDataFrame([("A0", 1, 0, 7), ("none", 1, 0, 8), (None, 1, 0, 9)],
                                f"airport string, hour int, Target int, {ROW_KEY} long")
    a0 = [r.Target for r in rows if r.airport == "A0"]
    base = sum(r.Target for r in rows) / len(rows)
    kept = encoder.transform(new, seen=F.lit(False)).select(vector_to_array(MD.FEATURES).alias("v"), ROW_KEY).collect()
    assert [r[ROW_KEY] for r in kept] == [7]
    assert math.isclose(kept[0].v[1], (sum(a0) + options.mean_prior * base) / (len(a0) + options.mean_prior))


def test_numbering_equals_the_string_indexer(spark):
    df = spark.range(4000).select(F.concat(F.lit("v"), F.floor(F.sqrt("id"))).alias("a"),
                                  F.when(F.col("id") % 7 != 0, (F.col("id") % 13).cast("string")).alias("b"))
    got = {(r.column_name, r.value): r["index"] for r in E.number_values(E.value_counts(df, ["a", "b"])).collect()}
    for c in "ab":
        labels = StringIndexer(inputCol=c, outputCol="i", handleInvalid="skip").fit(df).labels
        assert {v: i for (col, v), i in got.items() if col == c} == {v: float(i) for i, v in enumerate(labels)}
    empty = E.number_values(E.value_counts(df.where("false"), ["a"]))
    assert empty.count() == 0


def test_numbering_of_a_million_values_is_a_permutation(spark):
    counts = spark.range(1_000_000).select(F.lit("c").alias("column_name"), F.md5(F.col("id").cast("string")).alias("value"),
                                           (F.col("id") % 5).alias("count"))
    n = E.number_values(counts).join(counts, ["column_name", "value"]).agg(
        F.count("*").alias("n"), F.countDistinct("index").alias("d"), F.max("index").alias("last"),
        F.max(F.when(F.col("count") == 4, F.col("index"))).alias("last_of_largest")).first()
    assert (n.n, n.d, n["last"], n.last_of_largest) == (1_000_000, 1_000_000, 999_999.0, 199_999.0)


def test_samples_do_not_depend_on_partitions(spark):
    df = trips(spark, 50, 3000).withColumn("label", F.col("Target"))
    def keys(d):
        return sorted(r[ROW_KEY] for r in d.select(ROW_KEY).collect())
    got = []
    for n in (3, 17):
        d = df.repartition(n)
        bal = MD.balance(d)
        train, test = MD.split(bal)
        got.append([keys(bal), keys(train), keys(test), keys(d.where(MD.shard_of(d, 3) == 1))])
    assert got[0] == got[1]
    bal, train, test, _ = got[0]
    assert sorted(train + test) == bal and abs(len(train) / len(bal) - 0.7) < 0.05
    late = df.where("label = 1").count()
    assert sum(k % 50 % 3 == 0 for k in bal) == late and abs(len(bal) - 2 * late) < 5 * math.sqrt(late)


def test_places_are_even(spark):
    df = spark.range(20000).select(place(F.col("id"), "x", 1).alias("p"), bucket(F.col("id"), "x", 1, 4).alias("b"))
    assert 0.49 < df.agg(F.avg("p")).first()[0] < 0.51
    assert {r.b for r in df.groupBy("b").count().where("count > 4700").collect()} == {0, 1, 2, 3}


def test_sharded_forests_side_by_side_equal_one_after_another(spark):
    df = trips(spark, 30, 1200)
    enc = MD.encode(df, MD.fit_encoder(df, SMALL))
    def scores(parallelism):
        out = MD.train_sharded(enc, enc, 3, 3, SMALL, parallelism=parallelism)
        return sorted((r[ROW_KEY], r.shard, r.prediction) for r in out.select(ROW_KEY, "shard", "prediction").collect())
    together = scores(3)
    assert together == scores(1) and len(together) == 1200
    shard = enc.where(MD.shard_of(enc, 3) == 2)
    alone = MD.train_forest(shard, 3, SMALL).transform(shard)
    assert sorted((r[ROW_KEY], 2, r.prediction) for r in alone.collect()) == [t for t in together if t[1] == 2]


def test_jobs_run_together_overlap(spark):
    from threading import Barrier
    meet = Barrier(3, timeout=30)          # passes only if all three jobs are under way
    def job(i):
        return lambda: (meet.wait(), spark.range(1000 * (i + 1)).count())[1]
    assert MD.together(spark.range(1), [job(i) for i in range(3)], 3) == [1000, 2000, 3000]


def test_grid_follows_the_labels_and_its_folds(spark):
    grid = {"num_trees": [2, 3], "depths": [2, 4], "min_instances": [2]}
    df = trips(spark, 30, 1500)
    enc = MD.encode(df, MD.fit_encoder(df)).persist()
    scores = MD.grid_scores(MD.grid_search(enc, **grid))
    assert len(scores) == 4 and scores[0]["metric"] > 0.9
    b = scores[0]
    folded = MD.with_folds(enc, 3)
    apart = []
    for k in range(3):
        options = MD.ModelOptions(max_depth=b["maxDepth"], min_instances=b["minInstancesPerNode"])
        model = MD.train_forest(folded.where(F.col("fold") != k), b["numTrees"], options)
        apart.append(M.ranked_auc(model.transform(folded.where(F.col("fold") == k))).first()["auc"])
    assert math.isclose(sum(apart) / 3, b["metric"], rel_tol=1e-6)
    shuffled = enc.withColumn("label", bucket(F.col(ROW_KEY), "permuted", 1, 2))
    assert MD.grid_scores(MD.grid_search(shuffled, **grid))[0]["metric"] < 0.7
    enc.unpersist()


def test_ranked_auc_of_ties(spark):
    from pyspark.ml.linalg import Vectors
    rows = [(Vectors.dense(1 - s, s), y) for s, y in [(0.2, 0), (0.2, 1), (0.7, 1), (0.7, 0), (0.9, 1), (0.1, 0)]]
    df = spark.createDataFrame(rows, ["rawPrediction", "label"])
    pairs = [(a[0][1], b[0][1]) for a in rows for b in rows if a[1] == 1 and b[1] == 0]
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
    assert math.isclose(M.ranked_auc(df).first()["auc"], want)


def test_node_statistics_of_all_tasks_fit_the_heap(spark):
    df = trips(spark, 30, 600)
    enc = MD.encode(df, MD.fit_encoder(df))
    heap = spark._jvm.java.lang.Runtime.getRuntime().maxMemory() >> 20
    at_once = spark.sparkContext.defaultParallelism
    own = 0.4 * (heap - 300)                         # beside Spark's managed memory
    assert 0.8 * own < MD.task_memory_mb(spark) * at_once < 1.2 * own
    alone = MD.train_forest(enc, 2, SMALL)
    cv = MD.grid_search(enc, [2], [2], [2])
    for model in (alone, cv.bestModel):
        assert 1 <= model.getMaxMemoryInMB() and model.getMaxMemoryInMB() * at_once <= own
    few = MD.within_memory(spark, MD.ModelOptions(memory_mb=2))
    assert few.memory_mb == 2 and few.max_depth == MD.FOREST_DEPTH
