"""Centroid clustering of vectors, each vector's centroid found by a tournament
of bisector tests.

Vectors are turned into integers, ``floor(scale * x)``.  For two centroids
``a < b`` the points at least as near to ``a`` are those with
``x . 2(b - a) <= |b|^2 - |a|^2``.  A round computes that integer normal and
threshold for every pair once; a vector then meets the centroids in order of
their numbers, and the sign of one linear test drops the loser, so it takes
k - 1 tests.  Zero keeps the smaller number.  The distance to the winner is
computed in the end, exactly.

Each round is one pass over the vectors.  A task adds its vectors up per
centroid; Spark adds the tasks' sums, and at most k rows of sums reach the
driver, where the new centroids are ``floor(sum / count)``.

Defined cases: a vector takes part if it has exactly ``dim`` components, none
null or not finite; others (a null vector, too) give no row.  Repeated rows
each count and each give a row; a null id is a null id in the result and hashes
as an empty one.  With fewer than k vectors there are that many centroids; with
none the result is empty.  Equal starting hashes (a repeated id) go by the
vector's components.  Components whose integer is beyond 2**27 in size are taken
as 2**27, so that distances and a task's sums are exact in 64 bits; sums of
distances stop at the largest long.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

LONG_MAX = (1 << 63) - 1
ROWS = 4096          # vectors tested at once


def limit(dim: int) -> int:
    """The largest component for which every test and distance fits 64 bits."""
    return math.isqrt((1 << 60) // dim)


def whole_vectors(col: pa.Array, dim: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, integer components) of the vectors that take part."""
    sizes = pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == dim)
    if len(rows) == 0:
        return rows, np.empty((0, dim), dtype=np.int64)
    flat = col.take(pa.array(rows)).flatten().cast(pa.float64())
    x = flat.to_numpy(zero_copy_only=False).reshape(-1, dim)      # nulls are NaN
    fine = np.isfinite(x).all(axis=1)
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(scale * x[fine]), -limit(dim), limit(dim))
    return rows[fine], whole.astype(np.int64)


def bisectors(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normals and thresholds of all pairs: (k, k, dim) and (k, k)."""
    size = (centroids * centroids).sum(axis=1)
    return 2 * (centroids[None, :, :] - centroids[:, None, :]), size[None, :] - size[:, None]


def tournament(x: np.ndarray, normals: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """The number of the nearest centroid of each vector (ties: the smaller)."""
    best = np.zeros(len(x), dtype=np.int64)
    for challenger in range(1, len(thresholds)):
        side = np.einsum("ij,ij->i", x, normals[best, challenger]) - thresholds[best, challenger]
        best[side > 0] = challenger
    return best


def assign(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and exact squared distance of each vector."""
    normals, thresholds = bisectors(centroids)
    cluster = np.concatenate([tournament(x[i:i + ROWS], normals, thresholds) for i in range(0, len(x), ROWS)])
    return cluster, ((x - centroids[cluster]) ** 2).sum(axis=1)


def start_centroids(vectors: DataFrame, k: int, dim: int, scale: float, seed: int) -> np.ndarray:
    """The k vectors of smallest sha256 of ``seed:id``; a task passes on its k
    smallest only."""
    def smallest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list = []
        for b in batches:
            rows, x = whole_vectors(b.column(1), dim, scale)
            ids = b.column(0).take(pa.array(rows)).to_pylist()
            named = ((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v)
                     for i, v in zip(ids, x.tolist()))
            kept = heapq.nsmallest(k, heapq.merge(kept, sorted(named)))
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in kept], pa.string()),
                                              pa.array([v for _, v in kept], pa.list_(pa.int64()))], ["hash", "v"])

    first = vectors.mapInArrow(smallest, "hash string, v array<long>").orderBy("hash", "v").limit(k).collect()
    return np.array([r["v"] for r in first], dtype=np.int64).reshape(len(first), dim)


def move(vectors: DataFrame, centroids: np.ndarray, dim: int, scale: float) -> np.ndarray:
    """One round: the centroids after every vector joined its nearest one."""
    k = len(centroids)

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for b in batches:
            _, x = whole_vectors(b.column(1), dim, scale)
            if len(x):
                cluster, _ = assign(x, centroids)
                for c in np.unique(cluster):
                    total[c] += x[cluster == c].sum(axis=0)
                count += np.bincount(cluster, minlength=k)
        met = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met.astype(np.int32)), pa.array(count[met]), pa.array(total[met].tolist(), pa.list_(pa.int64()))],
            ["cluster", "n", "total"])

    parts = vectors.mapInArrow(sums, "cluster int, n long, total array<long>")
    parts = parts.select("cluster", "n", F.posexplode("total").alias("i", "s"))
    added = parts.groupBy("cluster", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    moved = centroids.copy()
    for r in added.collect():                         # at most k * dim rows
        moved[r["cluster"], r["i"]] = int(r["s"]) // r["n"]
    return moved


def fingerprint(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(df: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: float = 64.0, seed: int = 1,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per vector that takes part: the id, ``cluster``, squared ``distance``,
    ``cluster_inertia`` and ``inertia`` (distances summed over the cluster and
    over all) and ``centroid_sha256`` of the final centroid."""
    spark = df.sparkSession
    id_type = df.schema[id_col].dataType.simpleString()
    vectors = df.select(F.col(id_col).alias(id_col), F.col(vector_col).alias("v"))
    centroids = start_centroids(vectors, k, dim, scale, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = move(vectors, centroids, dim, scale)

    def assigned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, x = whole_vectors(b.column(1), dim, scale)
            if len(rows):
                number, distance = assign(x, centroids)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows)), pa.array(number.astype(np.int32)), pa.array(distance)],
                    [id_col, "cluster", "distance"])

    near = materialize(vectors.mapInArrow(assigned, f"`{id_col}` {id_type}, cluster int, distance long"), "clusters")
    per = near.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    sums = {r["cluster"]: int(r["s"]) for r in per.collect()}        # at most k rows
    known = [(c, min(s, LONG_MAX), min(sum(sums.values()), LONG_MAX), fingerprint(centroids[c]))
             for c, s in sorted(sums.items())]
    facts = spark.createDataFrame(
        known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return near.join(F.broadcast(facts), "cluster").select(
        id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
