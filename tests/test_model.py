"""Features, encoder, balancing, forest and metrics."""

import math

import pytest
from pyspark.sql import functions as F

from aerowx.operators import features as FT
from aerowx.operators import metrics as M
from aerowx.operators import model as MD
from aerowx.plans import preprocess as PP
from aerowx.plans.learn import learn
from aerowx.sources import fixtures as FX
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def ml(spark):
    return PP.ml_table(FX.flights(spark, SF_SMALL), FX.weather(spark, SF_SMALL),
                       FX.stations(spark, SF_SMALL)).persist()


def test_live_feature_frame(ml):
    df = FT.prepare_features(ml, 45)
    assert df.columns == ["ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "Hour_SO", "Hour_SA", "Target"]
    num, txt = FT.feature_columns(df)
    assert num == ["Hour_SO", "Hour_SA"] and txt == ["ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID"]


def test_weather_feature_frame(ml):
    df = FT.prepare_features(ml, 45, weather=True, n_origin=1, n_dest=0)
    cols = set(df.columns)
    assert "2_WO_01H" in cols and "2_WD_00H" in cols and "2_WO_02H" not in cols
    assert not any(c.startswith("0_W") for c in cols)                  # airport ids gone
    assert "Hour_1_WO_00H" in cols and "Year_1_WO_00H" not in cols     # granularity 0,0,0
    assert "6_WO_00H_FG+" in cols and "6_WO_00H" not in cols
    assert FT.granularity(df, True, True, True).columns == df.columns


def test_multi_hot_substring_semantics(spark):
    df = spark.createDataFrame([("-RA FG+",), ("MIFG",), (None,), ("FZRA",)], "`6_WO_00H` string")
    out = FT.multi_hot(df).collect()
    assert (out[0]["6_WO_00H_RA"], out[0]["6_WO_00H_FG"], out[0]["6_WO_00H_FG+"]) == (1, 1, 1)
    assert (out[1]["6_WO_00H_FG"], out[1]["6_WO_00H_MIFG"], out[1]["6_WO_00H_FZFG"]) == (1, 1, 0)
    assert sum(out[2][f"6_WO_00H_{c}"] for c in FT.WEATHER_CODES) == 0
    assert (out[3]["6_WO_00H_RA"], out[3]["6_WO_00H_FZRA"]) == (1, 1)


def test_select_hours(ml):
    df = FT.select_hours(ml, 3, 0)
    assert df.columns == ["WO_03H", "WO_02H", "WO_01H", "WO_00H", "WD_00H"]


def test_encoder_and_balance(ml):
    feats = FT.prepare_features(ml, 45)
    model = MD.fit_encoder(feats)
    enc = MD.encode(feats, model)
    assert enc.count() == feats.count()
    counts = {r.label: r["count"] for r in M.label_counts(enc).collect()}
    assert counts[0] > counts[1]          # threshold 45 makes 0 the majority
    bal = {r.label: r["count"] for r in M.label_counts(MD.balance(enc, seed=42)).collect()}
    assert bal[1] == counts[1] and abs(bal[0] - counts[1]) < 0.25 * counts[1]
    again = {r.label: r["count"] for r in M.label_counts(MD.balance(enc, seed=42)).collect()}
    assert again == bal


def test_metrics_exact_on_labels(spark):
    lab = FX.labels(spark, SF_SMALL).select(F.col("quality").alias("label"),
                                            F.col("toxic").cast("double").alias("prediction"))
    rows = [(r.label, r.prediction) for r in lab.collect()]
    tp = sum(1 for y, p in rows if y == 1 and p == 1)
    fp = sum(1 for y, p in rows if y == 0 and p == 1)
    fn = sum(1 for y, p in rows if y == 1 and p == 0)
    tn = sum(1 for y, p in rows if y == 0 and p == 0)
    c = M.confusion(lab).collect()[0]
    assert (c.tp, c.fp, c.fn, c.tn) == (tp, fp, fn, tn)
    m = M.prf(lab).collect()[0]
    p, r = tp / (tp + fp), tp / (tp + fn)
    assert math.isclose(m.precision, p) and math.isclose(m.recall, r)
    assert math.isclose(m.f1, 2 * p * r / (p + r))
    auc = M.auc(lab)
    assert math.isclose(auc, (tp / (tp + fn) + tn / (tn + fp)) / 2, rel_tol=1e-9)
    assert math.isclose(M.hard_auc(lab).collect()[0].auc, auc, rel_tol=1e-9)


def test_learn_end_to_end_is_repeatable(ml):
    small = MD.ModelOptions(max_depth=4)
    a = learn(ml, threshold=45, num_trees=3, options=small, seed=7)
    b = learn(ml, threshold=45, num_trees=3, options=small, seed=7)
    for v in (a.auc, a.precision, a.recall):
        assert 0.0 <= v <= 1.0
    assert (a.auc, a.precision, a.recall) == (b.auc, b.precision, b.recall)
    assert a.encoded_rows == 1333
    assert sum(a.labels_before.values()) == 1333 and a.labels_after[1] == a.labels_before[1]
    assert a.labels_after[0] < a.labels_before[0]


def test_feature_names_follow_the_vector(ml):
    assert MD.feature_names(FT.prepare_features(ml, 45)) == [
        ("feature 0", "indexed_ORIGIN_AIRPORT_ID"), ("feature 1", "indexed_DEST_AIRPORT_ID"),
        ("feature 2", "Hour_SO"), ("feature 3", "Hour_SA")]


def test_all_date_granularities(ml):
    from itertools import product
    for year, month, day in product((False, True), repeat=3):
        cols = FT.prepare_features(ml, 45, year=year, month=month, day=day).columns
        for flag, part in ((year, "Year"), (month, "Month"), (day, "Day")):
            assert (f"{part}_SO" in cols) == flag and (f"{part}_SA" in cols) == flag
        assert "Hour_SO" in cols


def test_learn_on_weather_features_of_all_hours(ml):
    r = learn(ml, num_trees=2, weather=True, year=True, month=True, day=True, partitions=4, salt=2,
              options=MD.ModelOptions(max_depth=3, min_instances=5, subsampling=0.8), seed=7)
    assert r.encoded_rows > 1000 and 0.0 <= r.auc <= 1.0


def test_colocate_keeps_rows_and_spreads_a_hot_key(spark):
    df = spark.range(4000).select(F.lit("a").alias("k"), "id")
    for salt, parts in ((1, 1), (8, 8)):
        out = MD.colocate(df, 32, "k", salt=salt)
        assert out.count() == 4000
        assert out.select(F.spark_partition_id().alias("p")).distinct().count() in range(min(parts, 2), parts + 1)
