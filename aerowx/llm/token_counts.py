"""Token counts of sections from one encoding of the whole document.

A document is encoded once.  Every token covers a run of the text's bytes, so
running sums of the tokens' lengths map tokens to characters; a token that
holds only part of a character covers that character.  The token spans are
joined to the sections they overlap, and a token that crosses a boundary is
allocated by a rule:

``most``   the section that holds most of its characters, the earlier one if
           two hold as many
``first``  the section that holds its first character that any section holds
``share``  every section by its share of the token's characters

Sections are (name, start, stop) in characters, in order and without overlap;
text between them belongs to none.  With ``most`` and ``first`` the counts of
sections that cover the whole text add up to the document's count.

Defined cases: null text counts as empty; null sections count as none; an
empty section has no tokens; repeated rows are counted alike; the lines of a
very long text are found in time that grows with their number; empty input gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound, prefix_sums, slices, text_or_empty

RULES = ("most", "first", "share")
SECTIONS = "array<struct<name:string,start:int,stop:int>>"
COUNTS = "array<struct<name:string,start:int,stop:int,n_tokens:double,n_crossing:bigint>>"


@lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str):
    """(encoding, byte lengths of all tokens)."""
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("sections", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def token_spans(text: str, ranks_path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """First character and character after the last of every token."""
    encoding, lengths = encoder(ranks_path, pattern)
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    if len(raw) == 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    ids = np.array(encoding.encode_ordinary(text), dtype=np.int64)
    stop = np.cumsum(lengths[ids])
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    return char[stop - lengths[ids]], char[stop - 1] + 1


def allocate(first: np.ndarray, last: np.ndarray, start: np.ndarray, stop: np.ndarray,
             rule: str = "most") -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) of every section: the interval join of token
    spans [first, last) with section spans [start, stop), both in order."""
    lo = np.searchsorted(stop, first, side="right")  # sections that end before the token
    hi = np.searchsorted(start, last, side="left")
    n = np.maximum(hi - lo, 0)
    token = np.repeat(np.arange(len(first)), n)
    section = np.arange(len(token)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    common = np.minimum(last[token], stop[section]) - np.maximum(first[token], start[section])
    token, section, common = (x[common > 0] for x in (token, section, common))
    if rule == "share":
        weight = common / (last - first)[token]
    else:
        by = np.lexsort((section, -common, token)) if rule == "most" else np.arange(len(token))
        token, section, common = token[by], section[by], common[by]
        head = np.concatenate(([True], token[1:] != token[:-1])) if len(token) else np.zeros(0, dtype=bool)
        token, section, common = token[head], section[head], common[head]
        weight = np.ones(len(token))
    crossing = common < (last - first)[token]
    return (np.bincount(section, weight, minlength=len(start)),
            np.bincount(section[crossing], minlength=len(start)))


def line_sections(text: Column) -> Column:
    """The lines of a text with their line ends, named by number from 0."""
    sizes = bound(F.split(text, "\n", -1), lambda lines: F.transform(
        lines, lambda x, i: F.length(x) + (i < F.size(lines) - 1).cast("int")))
    return bound(sizes, lambda n: F.transform(
        F.zip_with(n, prefix_sums(n), lambda n, at: F.struct(n.alias("n"), at.alias("at"))),
        lambda x, i: F.struct(i.cast("string").alias("name"), x["at"].alias("start"),
                              (x["at"] + x["n"]).alias("stop")))).cast(SECTIONS)


def count_tokens(docs: DataFrame, ranks_path: str, pattern: str, rule: str = "most") -> DataFrame:
    """``docs`` (id, text, sections) -> one row per document: id, n_tokens,
    sections with their counts."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.struct([("name", pa.string()), ("start", pa.int32()), ("stop", pa.int32()),
                            ("n_tokens", pa.float64()), ("n_crossing", pa.int64())])
        for b in slices(batches, "text"):
            totals, counts = [], []
            for text, sections in zip(b.column("text").to_pylist(), b.column("sections").to_pylist()):
                first, last = token_spans(text or "", ranks_path, pattern)
                start, stop = (np.array([s[k] for s in sections or []], dtype=np.int64) for k in ("start", "stop"))
                tokens, crossing = allocate(first, last, start, stop, rule)
                totals.append(len(first))
                counts.append([s | {"n_tokens": t, "n_crossing": c} for s, t, c in
                               zip(sections or [], tokens.tolist(), crossing.tolist())])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(totals, pa.int64()),
                                              pa.array(counts, pa.list_(fields))],
                                             names=["id", "n_tokens", "sections"])

    cols = docs.select("id", "text", F.col("sections").cast(SECTIONS).alias("sections"))
    return cols.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, n_tokens long, sections {COUNTS}")


def tokens_by_line(docs: DataFrame, ranks_path: str, pattern: str, rule: str = "most") -> DataFrame:
    """One row per line of every document: doc_id, line, start, stop,
    n_tokens, n_crossing, doc_tokens.  ``docs`` needs doc_id and text."""
    rows = docs.select(F.col("doc_id").alias("id"), text_or_empty().alias("text"))
    counted = count_tokens(rows.withColumn("sections", line_sections(F.col("text"))), ranks_path, pattern, rule)
    line = F.explode("sections").alias("s")
    n = F.col("s.n_tokens") if rule == "share" else F.col("s.n_tokens").cast("long")
    return counted.select("id", F.col("n_tokens").alias("doc_tokens"), line).select(
        F.col("id").alias("doc_id"), F.col("s.name").cast("int").alias("line"), "s.start", "s.stop",
        n.alias("n_tokens"), "s.n_crossing", "doc_tokens")
