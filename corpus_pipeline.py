"""A training corpus from the documents table, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor
kept, and returns a DataFrame with the columns of documents (the last one:
one row per row of the mix with its token digests).  ``run`` writes every
stage's result as Parquet in the shared checkpoint folder and reads it back
for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from aerowx.llm.byte_bpe import encode_and_decode
from aerowx.llm.common import materialize, table
from aerowx.llm.exact_dedup import keep_first_copies
from aerowx.llm.lang_id import keep_identified
from aerowx.llm.minhash_dedup import keep_representatives
from aerowx.llm.mixing import mixed_rows

RANKS = "byte_bpe_multi_50k.tiktoken"
NEAR_PERCENT = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language shows; those without a letter or with a
    narrow margin go."""
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return keep_first_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group linked by similarity 0.8 or more, the smallest doc_id."""
    return keep_representatives(docs, NEAR_PERCENT)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their weights: every row as often as it is taken."""
    return mixed_rows(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests of every row of the mix: doc_id, n_tokens, ids_sha256,
    decoded_sha256."""
    return encode_and_decode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("byte_bpe", byte_bpe),
]

#: SQL can express neither the classifier nor the encoding; tests/llm holds
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
