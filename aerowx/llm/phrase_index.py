"""Benchmark decontamination over a positional inverted index of the corpus.

**Index.**  Every document is cut into words, and every word is stored as a
posting.  A task numbers its documents' words one after another, with a gap of
``GAP`` unused addresses between documents, and writes one row per block of
documents and term: the term's 64-bit hash and its sorted addresses (as
differences).  The index is partitioned by document, so building it moves
nothing between tasks.

**Search.**  The test items' words are counted in the index.  A window (ten
consecutive words of an item, or the whole of a shorter one) is looked up from
its rarest two words: the addresses of each, less the word's offset in the
item, are places where the item would start, and their intersection keeps the
places where both agree.  Only those are followed further: the window's other
words are looked up in the same block, and a place where a whole window's words
stand gives a match.  With a ``slop`` the lists agree within that many places;
a window whose words all lie within ``slop`` of where the phrase has them, seen
from its rarest word, is a proximity match (an exact one is one as well).

The joins are on the term and then on (block, term), of which the index has one
row, so a word or passage that every document holds is spread over the blocks.

Defined cases: null or empty texts have no words; an item without words occurs
nowhere; rows are told apart even if their doc_id is null or repeated; items
with the same id are one item, whose windows are those of all its rows, and a
null item_id counts as an empty one; words are compared as 64-bit hashes; empty
tables give no items or no rows; other columns are ignored.  A text of any
length is one document of one block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, release_memory, slices, text_or_empty
from .minhash_dedup import mix, numbers

WINDOW = 10
GAP = 64                  # unused addresses between documents; the slop is smaller
BLOCK_BYTES = 16 << 20    # text of a block, with DOCUMENT_BYTES more for each document
DOCUMENT_BYTES = 256
PIECE = 2 << 20           # bytes whose words are hashed at once
BIN = 4096                # addresses of a bin, in which matches meet their documents

_U = np.uint64
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F] of lower-cased text, as bytes of UTF-8.
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

INDEX = "block long, term long, n long, addresses binary, ids array<{id}>, starts array<long>, sizes array<long>"


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words of each text).  The text is worked off in
    pieces of about ``PIECE`` bytes, cut between words."""
    buf = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    hashes, starts, lo = [], [], 0
    while lo < len(buf):
        hi = lo + PIECE
        while hi < len(buf) and not (outside := ~_IN_WORD[_LOWER[buf[hi:hi + PIECE]]]).any():
            hi += PIECE                                    # inside a very long word
        hi = min(hi + int(outside.argmax()), len(buf)) if hi < len(buf) else len(buf)
        h, at = _piece_hashes(_LOWER[buf[lo:hi]])
        hashes.append(h)
        starts.append(at + lo)
        lo = hi
    ends = np.cumsum([len(t) + 1 for t in texts])
    sizes = np.diff(np.searchsorted(np.concatenate(starts), np.concatenate(([0], ends))))
    return np.concatenate(hashes), sizes


def _piece_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each word of a piece."""
    inside = _IN_WORD[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    start, stop = edge[0::2], edge[1::2]
    if len(start) == 0:
        return np.empty(0, dtype=np.int64), start
    lens = stop - start
    at = np.flatnonzero(inside)
    first = np.cumsum(lens) - lens
    weight = numbers(int(lens.max()), 11)
    summed = np.add.reduceat((buf[at].astype(_U) + _U(1)) * weight[np.arange(len(at)) - np.repeat(first, lens)], first)
    return mix(summed + lens.astype(_U)).view(np.int64), start


def to_bytes(addresses: np.ndarray) -> bytes:
    """Sorted addresses as differences of 32 bits."""
    return np.diff(addresses, prepend=0).astype("<u4").tobytes()


def from_bytes(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, dtype="<u4").astype(np.int64))


def index_block(block: int, ids: pa.Array, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """The rows of a block: one with its documents, then one per term."""
    terms, sizes = word_hashes(texts)
    starts = np.cumsum(sizes + GAP) - sizes
    address = np.arange(len(terms)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    order = np.argsort(terms, kind="stable")
    terms, address = terms[order], address[order]
    cut = np.flatnonzero(np.diff(terms, prepend=terms[0] - 1 if len(terms) else 0))
    n = np.diff(cut, append=len(terms))
    # differences within a term; its first address stands as it is
    step = np.diff(address, prepend=0)
    step[cut] = address[cut]
    raw = step.astype("<u4").tobytes()
    offsets = np.concatenate((cut, [len(terms)])) * 4
    none = lambda t, k: pa.nulls(k, t)
    schema = ["block", "term", "n", "addresses", "ids", "starts", "sizes"]
    longs = pa.list_(pa.int64())
    yield pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), none(pa.int64(), 1), none(pa.int64(), 1), none(pa.binary(), 1),
         pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
         pa.array([starts.tolist()], longs), pa.array([sizes.tolist()], longs)], schema)
    for lo in range(0, len(cut), 20000):
        hi = min(lo + 20000, len(cut))
        part = raw[offsets[lo]:offsets[hi]]
        blobs = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(
            (offsets[lo:hi + 1] - offsets[lo]).astype(np.int32)), pa.py_buffer(part)])
        k = hi - lo
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(k, block)), pa.array(terms[cut[lo:hi]]), pa.array(n[lo:hi].astype(np.int64)), blobs,
             none(pa.list_(ids.type), k), none(longs, k), none(longs, k)], schema)


@dataclass(frozen=True)
class PhraseIndex:
    """``postings``: (block, term, n, addresses); ``documents``: (block, doc,
    id, start, size), ``doc`` being the number in the block."""
    postings: DataFrame
    documents: DataFrame


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> PhraseIndex:
    """Write the positional index of whole texts to the shared folder."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

        def close():
            together = pa.concat_arrays(ids)
            return index_block(task << 32 | number, together, texts)

        for b in slices(batches, "text", BLOCK_BYTES):
            got = [t.encode("utf-8", "replace") for t in b.column(1).to_pylist()]
            more = sum(map(len, got)) + DOCUMENT_BYTES * len(got)
            if texts and size + more > BLOCK_BYTES:
                yield from close()
                number, ids, texts, size = number + 1, [], [], 0
            ids.append(b.column(0))
            texts += got
            size += more
        if texts:
            yield from close()
        release_memory()

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    index = materialize(rows.mapInArrow(run, INDEX.format(id=id_type)), "phrase-index")
    return PhraseIndex(
        index.where(F.col("term").isNotNull()).select("block", "term", "n", "addresses"),
        index.where(F.col("term").isNull()).select("block", F.posexplode(F.arrays_zip("ids", "starts", "sizes")).alias("doc", "_d"))
        .select("block", "doc", F.col("_d.ids").alias("id"), F.col("_d.starts").alias("start"),
                F.col("_d.sizes").alias("size")))


def item_words(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, row, offset, length, term): the words of every item row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), 0
        for b in slices(batches, "text"):
            terms, sizes = word_hashes([t.encode("utf-8", "replace") for t in b.column(1).to_pylist()])
            row = np.repeat(np.arange(len(sizes)), sizes)
            first = np.cumsum(sizes) - sizes
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row)), pa.array((task << 32) + seen + row),
                 pa.array(np.arange(len(terms)) - first[row]), pa.array(sizes[row]), pa.array(terms)],
                ["item", "row", "offset", "length", "term"])
            seen += len(sizes)

    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                        text_or_empty(text_col).alias("text"))
    return materialize(rows.mapInArrow(run, "item string, row long, offset long, length long, term long"), "phrase-items")


def rarest_pairs(words: DataFrame, frequency: DataFrame, window: int) -> DataFrame:
    """(row, first, last, o1, t1, o2, t2): for the windows from offset
    ``first`` to ``last`` - ``window`` + 1, their rarest word and the next
    rarest (the same word in windows of one).  Windows with a word that the
    corpus lacks are left out."""
    known = words.join(frequency, "term", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    size = F.least(F.col("length"), F.lit(window))
    ahead = Window.partitionBy("row").orderBy("offset").rowsBetween(0, window - 1)
    ranked = known.withColumn("_r", F.slice(F.array_sort(F.collect_list(F.struct("n", "offset", "term")).over(ahead)), 1, 2))
    windows = (ranked.where((F.col("offset") + size <= F.col("length")) & (F.col("_r")[0]["n"] > 0))
               .select("row", "item", "offset", size.alias("size"), F.col("_r")[0].alias("a"),
                       F.coalesce(F.get("_r", F.lit(1)), F.col("_r")[0]).alias("b")))
    return windows.groupBy("row", "item", "size", F.col("a.offset").alias("o1"), F.col("a.term").alias("t1"),
                           F.col("b.offset").alias("o2"), F.col("b.term").alias("t2")).agg(
        F.min("offset").alias("first"), (F.max("offset") + F.max("size") - 1).alias("last"))


def _within(places: np.ndarray, others: np.ndarray, slop: int) -> np.ndarray:
    """Signed distance from each place to the nearest of the (sorted) others;
    ``slop`` + 1 where none is within ``slop``."""
    at = np.searchsorted(others, places)
    far = np.full(len(places), slop + 1, dtype=np.int64)
    for i in (at - 1, at):
        ok = (i >= 0) & (i < len(others))
        d = np.where(ok, others[np.clip(i, 0, len(others) - 1)] - places, slop + 1) if len(others) else far
        far = np.where(np.abs(d) < np.abs(far), d, far)
    return far


def _intersect(slop: int):
    """Places where the item starts by both lists."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, (o1, o2, a1, a2) in enumerate(zip(*(b.column(b.schema.get_field_index(c)).to_pylist()
                                                       for c in ("o1", "o2", "a1", "a2")))):
                start = from_bytes(a1) - o1
                start = start[np.abs(_within(start, from_bytes(a2) - o2, slop)) <= slop]
                if len(start):
                    row = b.slice(i, 1)
                    take = pa.array(np.zeros(len(start), dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [row.column(row.schema.get_field_index(c)).take(take)
                         for c in ("block", "row", "item", "size", "o1", "first", "last")] + [pa.array(start)],
                        ["block", "row", "item", "size", "o1", "first", "last", "start"])
    return run


def _stand(slop: int):
    """For each word of a followed place: how far from its place it stands."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            starts, raw, offsets = (b.column(b.schema.get_field_index(c)) for c in ("starts", "addresses", "offset"))
            flat = starts.flatten().to_numpy()
            ends = starts.offsets.to_numpy() - starts.offsets[0].as_py()
            out = np.empty(len(flat), dtype=np.int64)
            for i, (blob, o) in enumerate(zip(raw.to_pylist(), offsets.to_pylist())):
                lo, hi = ends[i], ends[i + 1]
                out[lo:hi] = _within(flat[lo:hi] + o, from_bytes(blob), slop)
            near = np.flatnonzero(np.abs(out) <= slop)
            row = np.repeat(np.arange(b.num_rows), np.diff(ends))[near]
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(c)).take(pa.array(row))
                 for c in ("block", "row", "item", "size", "o1", "offset")]
                + [pa.array(flat[near]), pa.array(out[near] == 0)],
                ["block", "row", "item", "size", "o1", "offset", "start", "exact"])
    return run


def matches(index: PhraseIndex, items: DataFrame, window: int = WINDOW, slop: int = 0,
            id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(block, item, exact, from, to, anchor): runs of item words, of a window's
    length or more, that stand in the corpus in their order at the addresses
    ``from`` to ``to`` (``exact``), or within ``slop`` places of those.  At
    ``anchor`` stands the rarest word."""
    if not 0 <= slop < GAP // 2:
        raise ValueError(f"slop lies between 0 and {GAP // 2 - 1}")
    words = item_words(items, id_col, text_col)
    asked = words.select("term").distinct()
    # postings of the items' words only; Spark ships the terms if their bytes allow
    held = index.postings.join(asked, "term", "left_semi")
    frequency = materialize(held.groupBy("term").agg(F.sum("n").alias("n")), "phrase-frequency")
    pairs = materialize(rarest_pairs(words, frequency, window), "phrase-pairs")
    rare = index.postings.join(pairs.select(F.col("t1").alias("term")).union(pairs.select("t2")).distinct(),
                               "term", "left_semi").select("block", "term", "addresses")
    one = rare.select("block", F.col("term").alias("t1"), F.col("addresses").alias("a1"))
    two = rare.select("block", F.col("term").alias("t2"), F.col("addresses").alias("a2"))
    agreed = (pairs.join(one, "t1").join(two, ["block", "t2"])
              .mapInArrow(_intersect(slop), "block long, row long, item string, size long, o1 long, first long, "
                                            "last long, start long"))
    agreed = materialize(agreed, "phrase-places")
    # every word of the windows around an agreed place
    follow = (agreed.groupBy("block", "row", "item", "size", "o1", "start")
              .agg(F.min("first").alias("first"), F.max("last").alias("last"))
              .groupBy("block", "row", "item", "size", "o1", "first", "last").agg(F.collect_list("start").alias("starts")))
    follow = follow.select("*", F.explode(F.sequence("first", "last")).alias("offset"))
    follow = follow.join(words.select("row", "offset", "term"), ["row", "offset"])
    stands = follow.join(held.select("block", "term", "addresses"), ["block", "term"]).mapInArrow(
        _stand(slop), "block long, row long, item string, size long, o1 long, offset long, start long, exact boolean")
    stands = materialize(stands, "phrase-stands") if slop else stands
    found = _runs(stands.where("exact"), True)
    return found.unionByName(_runs(stands, False)) if slop else found


def _runs(stands: DataFrame, exact: bool) -> DataFrame:
    """Runs of consecutive offsets, of a window's length or more."""
    place = Window.partitionBy("block", "row", "o1", "start").orderBy("offset")
    island = stands.withColumn("island", F.col("offset") - F.row_number().over(place))
    runs = island.groupBy("block", "row", "item", "size", "o1", "start", "island").agg(
        F.min("offset").alias("lo"), F.max("offset").alias("hi"))
    return runs.where(F.col("hi") - F.col("lo") + 1 >= F.col("size")).select(
        "block", "item", (F.col("start") + F.col("lo")).alias("from"), (F.col("start") + F.col("hi")).alias("to"),
        (F.col("start") + F.col("o1")).alias("anchor")).groupBy("block", "item", "from", "to").agg(
        F.min("anchor").alias("anchor")).withColumn("exact", F.lit(exact))


def _bins(lo: Column, hi: Column) -> Column:
    return F.explode(F.sequence(F.floor(lo / BIN), F.floor(hi / BIN)))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 2) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside an exact match),
    n_items and items_sha256 (items with an exact match), contaminated, and
    n_near_items (items with a proximity match, those included)."""
    index = build_index(docs)
    found = materialize(matches(index, items, window, slop), "phrase-matches")
    spans = index.documents.where("size > 0").select(
        "block", "doc", "start", (F.col("start") + F.col("size") - 1).alias("end"))
    spans = spans.select("*", _bins(F.col("start"), F.col("end")).alias("bin"))
    placed = found.withColumn("bin", F.floor(F.col("anchor") / BIN)).join(spans, ["block", "bin"]).where(
        F.col("anchor").between(F.col("start"), F.col("end")))
    placed = materialize(placed.select("block", "doc", "item", "exact", "from", "to"), "phrase-placed")
    by_item = (placed.groupBy("block", "doc", "item").agg(F.max("exact").alias("exact"))
               .groupBy("block", "doc").agg(
                   F.count_if("exact").alias("n_items"), F.count("*").alias("n_near_items"),
                   F.sha2(F.array_join(F.sort_array(F.collect_list(F.when(F.col("exact"), F.col("item")))), ","), 256)
                   .alias("items_sha256")))
    hits = (placed.where("exact").select("block", "doc", "from", "to").distinct()
            .select("block", "doc", F.explode(F.sequence("from", "to")).alias("address")).distinct()
            .groupBy("block", "doc").agg(F.count("*").alias("n_hit")))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    per_doc = by_item.join(hits, ["block", "doc"], "left")
    return index.documents.join(per_doc, ["block", "doc"], "left").select(
        F.col("id").alias("doc_id"), F.col("size").alias("n_words"), zero("n_hit"), zero("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), zero("n_near_items"))
