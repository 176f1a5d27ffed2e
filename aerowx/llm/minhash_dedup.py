"""Near-duplicate documents: MinHash bands, sequential Bayesian verification.

A document's set holds the hashes of its distinct five-word shingles.
Documents with equal sets are one node.  Nodes whose signatures agree on a
band of hashes are candidates.  A candidate pair's signatures are compared in
batches; after each batch the posterior probability that the similarity
reaches the threshold, given the matches so far and a uniform prior, is
bounded, and the pair is dropped once it is below the miss probability.  The
survivors are verified on the full sets.

Components need a spanning set of links, not all of them.  First every node is
compared with the smallest and the largest node of each of its bands, which
joins most groups.  Then, in the bands that still hold more than one
component, the pairs between different components are compared, block by
block: a band of any size is dealt out as pairs of blocks of bounded weight,
and a block pair only reports the links that join components.  No pair of a
band goes unexamined and none is written but for those.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.  A text with fewer
than five words has its whole sequence as one shingle.  Shingles are compared
by 64-bit hashes, nodes are named by 128 bits.

Defined cases: null text, or text without words, has an empty set and is
linked with nothing; a null doc_id ranks above every other, so a component
only has a null id if all its ids are null; where several texts of a component
have its smallest id, or all ids are null, the smallest text hash is kept; rows
that share a doc_id and text share their answer, rows that only share a doc_id,
or have none, are documents of their own; empty input gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, slices, text_or_empty
from .components import components

WORDS = 5
ROWS, BANDS = 4, 24
HASHES, BATCH = 128, 32
#: A pair at the threshold is missed by the bands with probability
#: (1 - t**ROWS)**BANDS (2e-8 at 0.85), by each posterior bound with MISS.
MISS = 1e-8
#: Shingles in a block of a band.
BLOCK_SHINGLES = 1 << 19
SLICE_BYTES = 2 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixer (shifts and odd multiplications)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _ODD + _U(seed)) | _U(1)


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    raw = [(t or "").encode("utf-8", "replace").lower() for t in texts]  # bytes: A-Z only
    buf = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw])
    space = _IS_SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    start, stop = edge[0::2], edge[1::2]
    if len(start) == 0:
        return [np.empty(0, dtype=np.uint64)] * len(raw)
    lens = stop - start
    inside = np.flatnonzero(~space)
    place = inside - np.repeat(start, lens)
    weight = numbers(int(lens.max()), 1)
    first = np.concatenate(([0], np.cumsum(lens)[:-1]))
    word = mix(np.add.reduceat((buf[inside].astype(np.uint64) + _U(1)) * weight[place], first) + lens.astype(np.uint64))
    factor = numbers(WORDS, 2)
    bounds = np.searchsorted(start, np.concatenate(([0], ends)))
    out = []
    if len(word) >= WORDS:
        rolled = sum((word[i:len(word) - WORDS + 1 + i] * factor[i] for i in range(1, WORDS)),
                     word[:len(word) - WORDS + 1] * factor[0])
        rolled = mix(rolled + _U(WORDS))
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        n = hi - lo
        if n >= WORDS:
            out.append(np.unique(rolled[lo:hi - WORDS + 1]))
        elif n:
            out.append(mix(np.sum(word[lo:hi] * factor[:n], keepdims=True) + _U(n)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def node_name(s: np.ndarray) -> bytes | None:
    """128 bits that name a set; None for the empty set."""
    if len(s) == 0:
        return None
    a, b = np.sum(mix(s ^ _U(0x5851F42D4C957F2D))), np.sum(mix(s + _ODD))
    return mix(np.array([a + _U(len(s)), b ^ _U(len(s))], dtype=np.uint64)).astype(">u8").tobytes()


def min_hashes(s: np.ndarray) -> np.ndarray:
    """The smallest of each of HASHES hash functions over a set, 32 bits."""
    a, b = numbers(HASHES, 3)[:, None], numbers(HASHES, 4)[:, None]
    low = np.full(HASHES, np.iinfo(np.uint32).max, dtype=np.uint64)
    for i in range(0, len(s), 512):
        low = np.minimum(low, ((s[None, i:i + 512] * a + b) >> _U(32)).min(axis=1))
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    parts = mix(low[:ROWS * BANDS].reshape(BANDS, ROWS) + np.arange(BANDS, dtype=np.uint64)[:, None] * _ODD)
    return mix((parts * numbers(ROWS, 5)).sum(axis=1)).view(np.int64)


@lru_cache(maxsize=8)
def least_matches(percent: int, miss: float = MISS) -> tuple[tuple[int, int], ...]:
    """(hashes compared, matches that a pair must have by then to go on).

    With a uniform prior the similarity after m of n matches is
    Beta(m + 1, n - m + 1), whose tail above t is the binomial sum below.
    """
    t = percent / 100
    found = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, 0
        while m <= n:
            tail += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        found.append((n, m))
    return tuple(found)


def plausible(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of two signature matrices stay after all batches."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), dtype=np.int32)
    done = 0
    for n, least in least_matches(percent):
        matches[alive] += (a[alive, done:n] == b[alive, done:n]).sum(axis=1, dtype=np.int32)
        alive = alive[matches[alive] >= least]
        done = n
    keep = np.zeros(len(a), dtype=bool)
    keep[alive] = True
    return keep


def similar(inter, na, nb, percent: int):
    """percent of the union, in whole numbers."""
    return (100 * inter >= percent * (na + nb - inter)) & (inter > 0)


def signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, HASHES)


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, text -> doc_id, text_key, n_shingles, node, sig, bands."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE_BYTES):
            sets = shingle_sets(b.column("text").to_pylist())
            low = [min_hashes(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([node_name(s) for s in sets], pa.binary()),
                pa.array([None if x is None else x.astype(np.uint16).tobytes() for x in low], pa.binary()),
                pa.array([None if x is None else band_keys(x) for x in low], pa.list_(pa.int64())),
            ], names=["doc_id", "text_key", "n_shingles", "node", "sig", "bands"])

    return docs.mapInArrow(run, "doc_id long, text_key binary, n_shingles long, node binary, sig binary, "
                                "bands array<long>")


def full_sets(texts: DataFrame) -> DataFrame:
    """text -> node, shingles (binary, 64-bit hashes in order)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE_BYTES):
            sets = shingle_sets(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([node_name(s) for s in sets], pa.binary()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())],
                                             names=["node", "shingles"])

    return texts.mapInArrow(run, "node binary, shingles binary")


def plausible_pairs(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, sig_a, sig_b) that the posterior bounds leave."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                keep = plausible(signatures(b.column("sig_a")), signatures(b.column("sig_b")), percent)
                yield b.select(["a", "b"]).filter(pa.array(keep))

    return pairs.mapInArrow(run, "a binary, b binary")


def verified_pairs(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, set_a, set_b) whose full sets are similar."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("set_a").to_pylist(), b.column("set_b").to_pylist()):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                keep.append(bool(similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent)))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(run, "a binary, b binary")


def intersections(rows: list[np.ndarray], cols: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, as matrix products
    over the shingles that more than one of the sets holds."""
    both = rows + cols
    owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
    _, code, count = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    shared = count > 1
    rank = np.cumsum(shared) - 1
    keep = shared[code]
    owner, code = owner[keep], rank[code[keep]]
    out = np.zeros((len(rows), len(cols)), dtype=np.float32)  # exact up to 2**24 shingles
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    for lo in range(0, int(shared.sum()), 2048):
        i, j = np.searchsorted(code, (lo, lo + 2048))
        m = np.zeros((len(both), 2048), dtype=np.float32)
        m[owner[i:j], code[i:j] - lo] = 1
        out += m[:len(rows)] @ m[len(rows):].T
    return out.astype(np.int64)


class Roots:
    """Union-find over small numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def joining_links(left, right, percent: int) -> list[tuple[bytes, bytes]]:
    """Links between the members of two blocks that join components.

    A block is a list of (node, component, signature, set); ``right`` is None
    to compare a block with itself.  Pairs already joined are left out, the
    others go through the batches, and what stays is verified in full."""
    other = left if right is None else right
    comps = {c: i for i, c in enumerate(dict.fromkeys(x[1] for x in left + other))}
    roots = Roots(len(comps))
    ca, cb = (np.array([comps[x[1]] for x in s]) for s in (left, other))
    sa, sb = (np.stack([np.frombuffer(x[2], dtype=np.uint16) for x in s]) for s in (left, other))
    sets_a, sets_b = ([np.frombuffer(x[3], dtype=np.uint64) for x in s] for s in (left, other))
    size_a, size_b = (np.array([len(x) for x in s]) for s in (sets_a, sets_b))
    found = []
    for lo in range(0, len(left), 128):
        for to in range(lo if right is None else 0, len(other), 512):
            now = np.array([roots.find(i) for i in range(len(comps))])
            i, j = np.nonzero(now[ca[lo:lo + 128]][:, None] != now[cb[to:to + 512]][None, :])
            i, j = i + lo, j + to
            if right is None:
                i, j = i[i < j], j[i < j]
            if len(i) == 0:
                continue
            # no similarity can exceed the ratio of the sizes
            fits = 100 * np.minimum(size_a[i], size_b[j]) >= percent * np.maximum(size_a[i], size_b[j])
            i, j = i[fits], j[fits]
            keep = plausible(sa[i], sb[j], percent)
            i, j = i[keep], j[keep]
            if len(i) == 0:
                continue
            rows, ri = np.unique(i, return_inverse=True)
            cols, cj = np.unique(j, return_inverse=True)
            inter = intersections([sets_a[k] for k in rows], [sets_b[k] for k in cols])[ri, cj]
            good = similar(inter, size_a[i], size_b[j], percent)
            for x, y in zip(i[good].tolist(), j[good].tolist()):
                if roots.join(int(ca[x]), int(cb[y])):
                    found.append((left[x][0], other[y][0]))
    return found


def block_links(members: DataFrame, percent: int) -> DataFrame:
    """members (key, row, col, side, node, comp, sig, shingles), one group per
    (key, row, col) -> links (a, b)."""
    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(*(table.column(c).to_pylist() for c in ("side", "node", "comp", "sig", "shingles"))))
        left, right = ([r[1:] for r in rows if r[0] == s] for s in (0, 1))
        row, col = table.column("row")[0].as_py(), table.column("col")[0].as_py()
        found = [] if not left or (row != col and not right) else joining_links(
            left, None if row == col else right, percent)
        return pa.table({"a": pa.array([f[0] for f in found], pa.binary()),
                         "b": pa.array([f[1] for f in found], pa.binary())})

    return members.groupBy("key", "row", "col").applyInArrow(run, "a binary, b binary")


def links(docs: DataFrame, sketched: DataFrame, percent: int, written: list[str]) -> DataFrame:
    """Component roots (node, root) of all nodes that are linked; tables that
    only this needs are added to ``written``."""
    nodes = sketched.where("node IS NOT NULL")
    classes = materialize(nodes.dropDuplicates(["node"]).select("node", "sig", "bands", "text_key", "n_shingles"),
                          "near-classes", written)
    rows = classes.select("node", "n_shingles", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"),
                                      F.count("*").alias("n"), F.sum("n_shingles").alias("weight")).where("n > 1")
    crowded = materialize(rows.join(buckets, "key"), "near-buckets", written)

    # full sets of the nodes that have a candidate
    involved = crowded.select("node").distinct()
    wanted = classes.join(involved, "node", "left_semi").select("text_key")
    texts = docs.join(wanted, "text_key", "left_semi").dropDuplicates(["text_key"]).select("text")
    sets = materialize(full_sets(texts).join(classes.select("node", "sig"), "node").dropDuplicates(["node"]),
                       "near-sets", written)

    ends = F.explode(F.array("first", "last"))
    pairs = crowded.select(F.col("node").alias("a"), ends.alias("b")).where("a <> b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sig = classes.select("node", "sig")
    a, b = (sig.select(F.col("node").alias(c), F.col("sig").alias(f"sig_{c}")) for c in "ab")
    survivors = materialize(plausible_pairs(pairs.join(a, "a").join(b, "b").select("a", "b", "sig_a", "sig_b"),
                                            percent), "near-survivors", written)
    a, b = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}")) for c in "ab")
    star = materialize(verified_pairs(survivors.join(a, "a").join(b, "b").select("a", "b", "set_a", "set_b"),
                                      percent), "near-star", written)
    roots = materialize(components(star), "near-roots", written)

    # bands that still hold several components, beyond the pairs just examined
    now = (crowded.where("n > 2").join(roots, "node", "left")
           .select("key", "node", "weight", F.coalesce("root", "node").alias("comp")))
    open_keys = (now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                 .where("lo <> hi").select("key"))
    n_blocks = F.ceil(F.col("weight") / BLOCK_SHINGLES).cast("int")
    dealt = (now.join(open_keys, "key", "left_semi")
             .withColumn("blocks", n_blocks)
             .withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("block", "other").alias("row"), F.greatest("block", "other").alias("col"),
                     (F.col("block") > F.col("other")).cast("int").alias("side"), "node", "comp"))
    more = materialize(block_links(dealt.join(sets, "node"), percent), "near-more", written)
    return components(star.unionByName(more))


def text_key() -> Column:
    """The SHA-256 of a text; null counts as empty."""
    return F.unhex(F.sha2(text_or_empty().cast("binary"), 256))


def judged(docs: DataFrame, percent: int) -> DataFrame:
    """One row per document: doc_id, text_key, n_shingles, component_id, kept."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("text_key", text_key())
    sketched = materialize(sketch(rows), "near-sketch")
    written: list[str] = []
    roots = materialize(links(rows.select("text_key", "text"), sketched, percent, written), "near-roots")
    discard(docs.sparkSession, written)
    named = sketched.select("doc_id", "text_key", "n_shingles", "node").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    # written apart: the join below then deals its rows anew, and a component
    # that holds a third of them can be split
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key"))
    least = materialize(named.where("root IS NOT NULL").groupBy("root").agg(first.alias("first"))
                        .select("root", F.col("first.doc_id").alias("least"), F.col("first.text_key").alias("least_key")),
                        "near-least")
    found = named.join(least, "root", "left")
    alone = F.col("root").isNull()
    chosen = F.col("doc_id").eqNullSafe(F.col("least")) & (F.col("text_key") == F.col("least_key"))
    return found.select("doc_id", "text_key", "n_shingles",
                        F.when(alone, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
                        F.when(alone, True).otherwise(chosen).alias("kept"))


def near_dedup(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.  ``docs``
    needs doc_id and text."""
    return judged(docs, percent).drop("text_key")


def keep_representatives(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, one for each component, with all their
    columns; only rows that share both doc_id and text count as one document."""
    kept = judged(docs, percent).where("kept").select(F.col("doc_id").alias("kept_id"),
                                                      F.col("text_key").alias("kept_key"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), text_key().alias("key"))
    return (rows.join(kept, (rows.key == kept.kept_key) & rows.id.eqNullSafe(kept.kept_id), "left_semi")
            .dropDuplicates(["key", "id"]).select("row.*"))
