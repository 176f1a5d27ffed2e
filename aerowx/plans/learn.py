"""Learning plan: chunks -> features -> encoder -> balance -> forest -> metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from aerowx.operators.features import prepare_features
from aerowx.operators.metrics import auc, label_counts, prf
from aerowx.operators.model import (ModelOptions, balance, colocate, encode, fit_encoder,
                                    in_parts, split, train_forest)
from aerowx.session import cut_lineage


@dataclass
class LearnResult:
    encoded_rows: int
    auc: float
    precision: float
    recall: float
    f1: float
    predictions: DataFrame
    labels_before: dict[int, int]   # rows by label, before and after balancing
    labels_after: dict[int, int]


def learn(ml: DataFrame, threshold: float = 45, num_trees: int = 10, *,
          weather: bool = False, n_origin: int = 11, n_dest: int = 11,
          year: bool = False, month: bool = False, day: bool = False,
          partitions: int | None = None, salt: int = 1, seed: int = 42,
          options: ModelOptions = ModelOptions(),
          fit_on_train_only: bool = False, score_col: str = "prediction") -> LearnResult:
    """Learning table -> trained and scored forest.  ``year``, ``month`` and
    ``day`` keep those date parts; ``options`` are the encoder's and the
    forest's."""
    feats = prepare_features(ml, threshold, weather, n_origin, n_dest, year, month, day, key=True)
    feats = colocate(feats, partitions, "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", salt=salt)
    # Reliable checkpoint of the feature frame into the shared
    # spark.checkpoint.dir: the preprocess plan runs once for the encoder
    # fits and the encoding.  Samples and parts are drawn by the rows' keys,
    # so they are the same whatever the partitioning.
    feats = cut_lineage(feats)
    train_only = split(feats, seed=seed)[0] if fit_on_train_only else None
    seen = in_parts(feats, seed=seed)[0] if fit_on_train_only else None
    enc = encode(feats, fit_encoder(feats, options, train_only, seed=seed), seen=seen).persist()
    counts = lambda df: {int(r["label"]): r["count"] for r in label_counts(df).collect()}
    before = counts(enc)
    bal = balance(enc, seed=seed)
    after = counts(bal)
    train, test = split(bal, seed=seed)
    pred = train_forest(train, num_trees, options, seed).transform(test).persist()
    a = auc(pred, score_col=score_col)
    m = prf(pred).collect()[0]
    pred.unpersist()
    enc.unpersist()
    return LearnResult(sum(before.values()), a, m["precision"], m["recall"], m["f1"], pred, before, after)
