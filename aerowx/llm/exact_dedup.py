"""Exact dedup with an extendible-hash index on shared files.

Keys are the 64-bit hashes of the texts.  The directory maps the first
``global depth`` bits of a key to a bucket; it starts with one bucket and,
whenever a bucket holds more keys than its capacity, the bucket splits on its
next bit, and the directory doubles when the bucket already used all of the
directory's bits.  Every bucket is one contiguous range of keys.

Each input task first collapses equal texts, so a text that a third of all
rows share leaves a task a few times at most.  The collapsed rows are dealt to
the owner of their bucket.  An owner walks its keys in order, chains texts
that share a key, compares their bytes, and writes one index entry per
distinct text to the shared folder.  Documents then look their entry up.

Defined cases: a null text counts as empty; rows repeated with the same
doc_id and text are one document and carry the same decision; a null doc_id
ranks below every other (a group of null ids only keeps a null id); empty
input gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

BUCKET_KEYS = 256
#: The directory never has more than 2**MAX_DEPTH entries, which bounds what
#: the driver holds and what is broadcast; a bucket that is still overfull at
#: that depth simply has a longer run of keys.
MAX_DEPTH = 16
RUN_BYTES = 32 << 20

ENTRY = "key long, n_chain int, sha256 string, keep_id long, group_size long"


def split_buckets(counts: dict[int, int], capacity: int = BUCKET_KEYS,
                  max_depth: int = MAX_DEPTH) -> tuple[int, list[tuple[int, int]]]:
    """Grow a directory from one bucket until no bucket is overfull.

    ``counts``: keys per prefix of ``max_depth`` bits.  Returns the global
    depth and the buckets as (prefix, local depth), in key order.
    """
    total = {(0, 0): sum(counts.values())}
    full = [(0, 0)] if total[0, 0] > capacity else []
    inside = {(0, 0): sorted(counts.items())}
    depth, done = 0, [] if full else [(0, 0)]
    while full:
        prefix, local = full.pop()
        depth = max(depth, local + 1)  # the directory doubles
        halves: tuple[list, list] = ([], [])
        for p, n in inside.pop((prefix, local)):
            halves[p >> (max_depth - local - 1) & 1].append((p, n))
        for bit, part in enumerate(halves):
            child = (prefix << 1 | bit, local + 1)
            if sum(n for _, n in part) > capacity and local + 1 < max_depth:
                inside[child] = part
                full.append(child)
            else:
                done.append(child)
    return depth, sorted(done, key=lambda b: b[0] << (max_depth - b[1]))


def _key(text):
    return F.xxhash64(text)


def _prefix(key, bits: int):
    """The first ``bits`` bits of the key, as a number."""
    return F.shiftrightunsigned(key, 64 - bits).cast("int") if bits else F.lit(0)


def build_directory(docs: DataFrame, capacity: int = BUCKET_KEYS) -> tuple[int, DataFrame]:
    """(global depth, directory rows (slot, bucket)); at most 2**MAX_DEPTH
    counts reach the driver."""
    spark = docs.sparkSession
    keys = docs.select(_key(text_or_empty()).alias("key")).distinct()
    counts = {r["p"]: r["n"] for r in
              keys.groupBy(_prefix(F.col("key"), MAX_DEPTH).alias("p")).agg(F.count("*").alias("n")).collect()}
    depth, buckets = split_buckets(counts, capacity)
    slots = [((prefix << (depth - local)) + i, b)
             for b, (prefix, local) in enumerate(buckets) for i in range(1 << (depth - local))]
    return depth, spark.createDataFrame(slots, "slot int, bucket int")


def _collapse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal texts of a task's run of rows become one row."""
    def merged(run):
        t = pa.Table.from_batches(run).group_by(["bucket", "key", "text"]).aggregate(
            [("doc_id", "max"), ("n", "sum")])
        t = t.rename_columns({"doc_id_max": "doc_id", "n_sum": "n"})
        return t.select(["bucket", "key", "text", "doc_id", "n"]).to_batches()

    run, size = [], 0
    for b in batches:
        run.append(b)
        size += b.nbytes
        if size >= RUN_BYTES:
            run, size = list(merged(run)), 0
            yield from run
            run = []
    if run:
        yield from merged(run)


def _chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owner task: rows arrive by (bucket, key); texts that share a key form a
    chain and are told apart by their bytes."""
    import hashlib

    def entries(key, chain):
        return [(key, i, hashlib.sha256(text).hexdigest(), keep, n)
                for i, (text, (keep, n)) in enumerate(chain.items())]

    def batch(rows):
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
            names=["key", "n_chain", "sha256", "keep_id", "group_size"])

    now, chain, rows = None, {}, []
    for b in batches:
        for key, text, doc_id, n in zip(*(b.column(b.schema.get_field_index(c)).to_pylist()
                                          for c in ("key", "bytes", "doc_id", "n"))):
            if key != now:
                rows += entries(now, chain)
                now, chain = key, {}
            best, total = chain.get(text, (None, 0))
            if doc_id is not None and (best is None or doc_id > best):
                best = doc_id
            chain[text] = (best, total + n)
        if len(rows) >= 4096:
            yield batch(rows)
            rows = []
    rows += entries(now, chain)
    if rows:
        yield batch(rows)


def build_index(docs: DataFrame, capacity: int = BUCKET_KEYS) -> DataFrame:
    """The index: one entry (key, n_chain, sha256, keep_id, group_size) per
    distinct text, written to the shared folder."""
    depth, directory = build_directory(docs, capacity)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("key", _key(F.col("text"))).withColumn("slot", _prefix(F.col("key"), depth))
    rows = (rows.join(F.broadcast(directory), "slot")  # at most 2**MAX_DEPTH rows of two ints
                .select("bucket", "key", "text", "doc_id", F.lit(1).cast("long").alias("n")))
    runs = rows.mapInArrow(_collapse, "bucket int, key long, text string, doc_id long, n long")
    owned = (runs.select("bucket", "key", F.col("text").cast("binary").alias("bytes"), "doc_id", "n")
                 .repartition("bucket").sortWithinPartitions("bucket", "key"))
    return materialize(owned.mapInArrow(_chain, ENTRY), "dedup-index")


def exact_dedup(docs: DataFrame, capacity: int = BUCKET_KEYS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.
    ``docs`` needs doc_id and text."""
    index = build_index(docs, capacity).select("key", "sha256", "keep_id", "group_size")
    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key(text_or_empty()).alias("key"),
                       F.sha2(text_or_empty().cast("binary"), 256).alias("sha256"))
    return mine.join(index, ["key", "sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha256").alias("text_sha256"))


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of equal texts
    the row with the largest doc_id, repeated rows once."""
    index = build_index(docs).select("key", "sha256", "keep_id")
    sha = F.sha2(text_or_empty().cast("binary"), 256)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"),
                       _key(text_or_empty()).alias("key"), sha.alias("sha256"))
    # both sides of the join are unique on (key, sha256, id) but for repeated rows
    rows = rows.join(index, (rows.key == index.key) & (rows.sha256 == index.sha256)
                     & rows.id.eqNullSafe(index.keep_id), "left_semi")
    return rows.dropDuplicates(["sha256", "id"]).select("row.*")
