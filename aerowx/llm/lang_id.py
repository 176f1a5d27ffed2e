"""Language identification by compression.

For every language a raw-content zstandard dictionary is filled with a
bounded sample of labelled texts.  A text is cut into pieces, each piece is
compressed with every dictionary, and the language whose dictionary gives the
smallest total wins.  The margin is the share by which the winner beats the
runner-up; a text whose margin is narrow is rejected.

Every piece is compressed behind the same short filler, which all
dictionaries contain: zstandard stores very short inputs as they are, and
with the filler even a few words show what the dictionary saves.

Defined cases: null text, or text without a letter, is ``und`` with score 0
and rejected; equal sizes go to the language with more labelled rows, then to
the smaller code; texts under ``MIN_BYTES`` bytes are too short to measure a
margin and are not rejected for it; without any labelled row every text is
``und``; very long texts are judged whole, piece by piece; repeated rows are
judged alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, release_memory, slices

UND = "und"
#: The bounded sample that the classifier learns from: this many texts of each
#: language, copies counted once, in the order of a hash, and so much of each.
SAMPLE_TEXTS = 64
SAMPLE_BYTES = 2048
#: All languages are kept.  Beyond this many each has fewer and then shorter
#: texts, so that the model stays within FULL_LANGS * SAMPLE_TEXTS *
#: SAMPLE_BYTES bytes (and a filler for each language), and a task takes the
#: dictionaries this many at a time.
FULL_LANGS = 128
PIECE_BYTES = 2048
LEVEL = 6
#: A margin below this is narrow.
MIN_MARGIN = 0.01
MIN_BYTES = 64

FILLER = bytes(range(128, 256))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a document is kept from learning: crc32(id as text) mod folds = 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def share_of(n_langs: int) -> tuple[int, int]:
    """(texts, bytes of each) that a language has in a model of so many."""
    room = FULL_LANGS * SAMPLE_TEXTS * SAMPLE_BYTES // max(1, n_langs)
    texts = max(1, min(SAMPLE_TEXTS, room // SAMPLE_BYTES))
    return texts, max(1, min(SAMPLE_BYTES, room // texts))


def learn(labelled: DataFrame) -> dict[str, bytes]:
    """Dictionaries by language, most frequent language first, from the text
    and lang of ``labelled``.  What reaches the driver is bounded by the
    parameters above, but for a row and a filler of each language."""
    rows = (labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
            .select("lang", F.substring(F.lower("text"), 1, SAMPLE_BYTES).alias("text"))
            .withColumn("place", F.xxhash64("text")))
    # only hashes are dealt out; copies of a text are one place in the order
    places = materialize(rows.groupBy("lang", "place").agg(F.count("*").alias("n")), "lang-places")
    counts = places.groupBy("lang").agg(F.sum("n").alias("n"))
    langs = [r["lang"] for r in counts.orderBy(F.desc("n"), "lang").collect()]
    n_texts, n_bytes = share_of(len(langs))
    order = Window.partitionBy("lang").orderBy("place")
    chosen = (places.withColumn("n", F.row_number().over(order)).where(F.col("n") <= n_texts)
              .select("lang", "place"))
    # the places are as few as the sample's texts, so the rows stay where they
    # are; of the few texts that share a hash, the smallest
    sample = (rows.join(F.broadcast(chosen), ["lang", "place"], "left_semi").groupBy("lang", "place")
              .agg(F.min(F.substring("text", 1, n_bytes)).alias("text")))
    texts: dict[str, list[bytes]] = {}
    for r in sample.orderBy("lang", "place").collect():
        texts.setdefault(r["lang"], []).append(r["text"].encode()[:n_bytes])
    return {lang: b"\n".join(texts[lang]) + FILLER for lang in langs if lang in texts}


@lru_cache(maxsize=1)
def _compressors(model: tuple[tuple[str, bytes], ...]):
    import zstandard as z
    found = []
    for lang, data in model:
        dictionary = z.ZstdCompressionDict(data, dict_type=z.DICT_TYPE_RAWCONTENT)
        params = z.ZstdCompressionParameters.from_level(
            LEVEL, source_size=PIECE_BYTES, dict_size=len(data), min_match=3, write_content_size=0,
            write_checksum=0, write_dict_id=0, format=z.FORMAT_ZSTD1_MAGICLESS)
        dictionary.precompute_compress(compression_params=params)
        found.append((lang, z.ZstdCompressor(dict_data=dictionary, compression_params=params)))
    return found


def pieces_of(text: str | None) -> list[bytes]:
    """The pieces of a text, each behind the filler; none without a letter."""
    if text is None or not any(map(str.isalpha, text)):
        return []
    raw = text.lower().encode("utf-8", "replace")
    return [FILLER + raw[i:i + PIECE_BYTES] for i in range(0, len(raw), PIECE_BYTES)]


def smallest(pieces: list[bytes], compressors, first: int = 0, found=()) -> list[tuple[int, int]]:
    """The two smallest (total, number of the language), with those found in
    the dictionaries before ``first``."""
    sizes = ((sum(len(c.compress(p)) for p in pieces), i) for i, (_, c) in enumerate(compressors, first))
    return sorted([*found, *sizes])[:2]


def verdict(pieces: list[bytes], sizes: list[tuple[int, int]], langs: list[str]) -> tuple[str, float, bool]:
    if not pieces or not sizes:
        return UND, 0.0, True
    best, second = (sizes + [(2 * sizes[0][0], 0)])[:2]  # with one language only, nothing is narrow
    margin = 1.0 - best[0] / second[0]
    n_bytes = sum(map(len, pieces)) - len(FILLER) * len(pieces)
    return langs[best[1]], margin, n_bytes >= MIN_BYTES and margin < MIN_MARGIN


def classify(text: str | None, compressors) -> tuple[str, float, bool]:
    """(language, margin, rejected) of one text."""
    pieces = pieces_of(text)
    return verdict(pieces, smallest(pieces, compressors) if pieces else [], [lang for lang, _ in compressors])


def classify_all(texts: list[str | None], model: tuple[tuple[str, bytes], ...]) -> list[tuple[str, float, bool]]:
    """``classify`` for many texts and a model of any number of languages,
    whose dictionaries are held FULL_LANGS at a time."""
    if len(model) <= FULL_LANGS:
        compressors = _compressors(model)
        return [classify(t, compressors) for t in texts]
    sizes: list[list[tuple[int, int]]] = [[] for _ in texts]
    for first in range(0, len(model), FULL_LANGS):
        compressors = _compressors(model[first:first + FULL_LANGS])
        for i, t in enumerate(texts):
            if pieces := pieces_of(t):
                sizes[i] = smallest(pieces, compressors, first, sizes[i])
    langs = [lang for lang, _ in model]
    return [verdict(pieces_of(t), s, langs) for t, s in zip(texts, sizes)]


def identify(docs: DataFrame, model: dict[str, bytes]) -> DataFrame:
    """``docs`` (id, text) -> id, lang_pred, score, rejected; the model is
    carried to the tasks, its size is bounded by the parameters above."""
    packed = tuple(model.items())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            lang, score, rejected = zip(*classify_all(b.column("text").to_pylist(), packed))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rejected, pa.bool_())], names=["id", "lang_pred", "score", "rejected"])
        release_memory()

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(
        run, f"id {id_type}, lang_pred string, score double, rejected boolean")


def train_rows(docs: DataFrame) -> DataFrame:
    """The labelled rows that may be learnt from."""
    return docs.where(~held_out(F.col("doc_id"))).select("lang", "text")


def language_id(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected.
    ``docs`` needs doc_id, text and lang; lang is only read from rows that are
    not held out, and only to learn."""
    found = identify(docs.select(F.col("doc_id").alias("id"), "text"), learn(train_rows(docs)))
    return found.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"),
                        "lang_pred", "score", "rejected")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    model = tuple(learn(train_rows(docs)).items())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            yield b.filter(pa.array([not rejected for _, _, rejected in
                                     classify_all(b.column("text").to_pylist(), model)], pa.bool_()))
        release_memory()

    return docs.mapInArrow(run, docs.schema)
