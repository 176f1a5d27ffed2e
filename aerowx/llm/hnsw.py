"""Approximate nearest neighbours: a hierarchical navigable small-world graph
per shard, shard results merged.

Equal vectors are one point of the index; a point keeps its smallest ids, as
many as a query may return, so a vector that a third of all rows share is one
point.  Points are dealt to shards of bounded size by a hash.  A task builds
the graph of one shard and stores it as flat arrays: for every level the nodes
and a matrix of neighbour numbers, filled up with -1.  Every block of queries
visits every shard of its dimension, and the best results of all shards are
merged.

Nearness is the largest inner product.  Vectors get one more component that
makes all norms of a shard equal, queries get a zero there: products with a
query stay as they are, and among the stored vectors a large product now means
a small distance, which the graph needs.

Scores are exactly rounded sums of the products in double precision, on the
original vectors.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows without an id, take no part; vectors meet only vectors
of their own dimension; repeated rows count once; ties go to the smaller id;
with few candidates a query returns them all; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

K = 20
#: Points in a shard, queries in a block.
SHARD_POINTS = 8192
BLOCK_QUERIES = 4096
#: Neighbours per node (twice as many on the lowest level), and the breadth of
#: the search while building and while asking.
LINKS = 16
BUILD_BREADTH = 80
ASK_BREADTH = 120
SEED = 7


class Graph:
    """One shard's graph: ``vectors`` (n, d), and per level ``nodes`` and a
    neighbour matrix over them; level 0 holds all nodes."""

    def __init__(self, vectors: np.ndarray, levels: list[np.ndarray], links: list[np.ndarray], entry: int):
        self.vectors, self.links, self.entry = vectors, links, entry
        self.levels = levels
        self.row = [{int(v): i for i, v in enumerate(nodes)} for nodes in levels[1:]]
        self.seen = np.zeros(len(vectors), dtype=np.int32)
        self.stamp = 0

    def neighbours(self, node: int, level: int) -> np.ndarray:
        row = self.links[level][node if level == 0 else self.row[level - 1][node]]
        return row[row >= 0]

    def search(self, q: np.ndarray, start: list[tuple[float, int]], breadth: int, level: int) -> list[tuple[float, int]]:
        """The best nodes found from ``start``, as (score, node), best first."""
        self.stamp += 1
        seen, stamp = self.seen, self.stamp
        best = list(start)
        heapq.heapify(best)
        todo = [(-s, n) for s, n in start]
        heapq.heapify(todo)
        for _, n in start:
            seen[n] = stamp
        while todo:
            s, node = heapq.heappop(todo)
            if -s < best[0][0] and len(best) >= breadth:
                break
            near = self.neighbours(node, level)
            near = near[seen[near] != stamp]
            if len(near) == 0:
                continue
            seen[near] = stamp
            scores = self.vectors[near] @ q
            if len(best) >= breadth:
                good = scores > best[0][0]
                near, scores = near[good], scores[good]
            for s, n in zip(scores.tolist(), near.tolist()):
                if len(best) < breadth:
                    heapq.heappush(best, (s, n))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, n))
                else:
                    continue
                heapq.heappush(todo, (-s, n))
        return sorted(best, reverse=True)

    def ask(self, q: np.ndarray, breadth: int) -> list[tuple[float, int]]:
        at = [(float(self.vectors[self.entry] @ q), self.entry)]
        for level in range(len(self.links) - 1, 0, -1):
            at = self.search(q, at, 1, level)[:1]
        return self.search(q, at, breadth, 0)


def spread(vectors: np.ndarray, found: list[tuple[float, int]], most: int) -> list[int]:
    """Neighbours in many directions: a candidate is taken if it is nearer to
    the node than to every neighbour taken so far; the nearest others fill up."""
    nodes = [n for _, n in found]
    between = vectors[nodes] @ vectors[nodes].T
    taken: list[int] = []
    for i, (s, _) in enumerate(found):
        if len(taken) == most:
            break
        if not taken or s > between[i, taken].max():
            taken.append(i)
    chosen = set(taken)
    taken += islice((i for i in range(len(nodes)) if i not in chosen), most - len(taken))
    return [nodes[i] for i in taken]


def equal_norms(vectors: np.ndarray) -> np.ndarray:
    norms = np.einsum("ij,ij->i", vectors, vectors)
    return np.column_stack([vectors, np.sqrt(np.maximum(norms.max() - norms, 0.0))])


def build(vectors: np.ndarray, seed: int = SEED) -> Graph:
    """The graph of the rows of ``vectors`` (with equal norms)."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    height = np.minimum((-np.log(1 - rng.random(n)) / math.log(LINKS)).astype(int), 12)
    top = int(height.max())
    levels = [np.flatnonzero(height >= level).astype(np.int32) for level in range(top + 1)]
    width = [2 * LINKS] + [LINKS] * top
    links = [np.full((len(nodes), w), -1, dtype=np.int32) for nodes, w in zip(levels, width)]
    entry = int(levels[top][0])
    g = Graph(vectors, levels, links, entry)
    order = [entry, *(i for i in range(n) if i != entry)]
    for node in order[1:]:
        q = vectors[node]
        at = [(float(vectors[entry] @ q), entry)]
        for level in range(top, -1, -1):
            if level > height[node]:
                at = g.search(q, at, 1, level)[:1]
                continue
            at = g.search(q, at, BUILD_BREADTH, level)
            mine = spread(vectors, at[:2 * LINKS], LINKS)
            rows = links[level]
            place = node if level == 0 else g.row[level - 1][node]
            rows[place, :len(mine)] = mine
            for other in mine:
                row = rows[other if level == 0 else g.row[level - 1][other]]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = node
                    continue
                ids = np.append(row, node)
                scores = vectors[ids] @ vectors[other]
                ranked = sorted(zip(scores.tolist(), ids.tolist()), reverse=True)
                row[:] = spread(vectors, ranked, len(row))
    return g


def valid(vector: Column) -> Column:
    """Whether a vector takes part."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(vector.isNotNull() & F.forall(vector, number) & F.exists(vector, lambda x: x != 0), F.lit(False))


def points(rows: DataFrame, k: int = K) -> DataFrame:
    """rows (id, vector) -> vector, ids: the smallest k + 1 ids of each
    distinct vector.  Ranks are limited before rows are shuffled."""
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    few = rows.distinct().withColumn("place", place).where(F.col("place") <= k + 1)
    return few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))


INDEX = ("dim int, shard int, vectors binary, ids binary, id_ends binary, level_nodes array<binary>, "
         "level_links array<binary>, entry int")


def build_index(rows: DataFrame, k: int = K, shard_points: int = SHARD_POINTS) -> DataFrame:
    """The index, written to the shared folder: one row of flat arrays per
    shard."""
    found = materialize(points(rows, k).withColumn("dim", F.size("vector")), "ann-points")
    sizes = materialize(found.groupBy("dim").agg(F.ceil(F.count("*") / shard_points).alias("n_shards")), "ann-sizes")
    n_shards = sizes.agg(F.sum("n_shards")).first()[0] or 1
    dealt = found.join(sizes, "dim").withColumn(
        "shard", F.pmod(F.xxhash64("vector"), F.col("n_shards")).cast("int"))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        dim, ids = table["dim"][0].as_py(), table["ids"].to_pylist()
        order = sorted(range(len(ids)), key=lambda i: ids[i][0])  # the graph doesn't depend on arrival
        ids = [ids[i] for i in order]
        vectors = np.array([table["vector"][i].as_py() for i in order], dtype=np.float64).reshape(-1, dim)
        g = build(equal_norms(vectors))
        return pa.Table.from_pylist([{
            "dim": dim, "shard": table["shard"][0].as_py(), "vectors": g.vectors.tobytes(),
            "ids": np.concatenate(ids).astype(np.int64).tobytes(),
            "id_ends": np.cumsum([len(i) for i in ids]).astype(np.int64).tobytes(),
            "level_nodes": [x.tobytes() for x in g.levels], "level_links": [x.tobytes() for x in g.links],
            "entry": g.entry}], pa.schema([
                ("dim", pa.int32()), ("shard", pa.int32()), ("vectors", pa.binary()), ("ids", pa.binary()),
                ("id_ends", pa.binary()), ("level_nodes", pa.list_(pa.binary())),
                ("level_links", pa.list_(pa.binary())), ("entry", pa.int32())]))

    # a task per shard: few bytes, but minutes of work, so they are not merged
    dealt = dealt.select("dim", "shard", "ids", "vector").repartitionByRange(n_shards, "dim", "shard")
    return materialize(dealt.groupBy("dim", "shard").applyInArrow(run, INDEX), "ann-index")


def stored_graph(row: dict) -> tuple[Graph, list[np.ndarray]]:
    """(graph, ids of each point) of an index row."""
    vectors = np.frombuffer(row["vectors"], dtype=np.float64).reshape(-1, row["dim"] + 1)
    levels = [np.frombuffer(x, dtype=np.int32) for x in row["level_nodes"]]
    links = [np.frombuffer(x, dtype=np.int32).reshape(len(nodes), -1) for x, nodes in zip(row["level_links"], levels)]
    ids = np.split(np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["id_ends"], dtype=np.int64)[:-1])
    return Graph(vectors, levels, links, row["entry"]), ids


def search_index(index: DataFrame, queries: DataFrame, k: int = K, breadth: int = ASK_BREADTH) -> DataFrame:
    """queries (id, vector) -> query_id, rank, vec_id, score."""
    shards = index.select(F.col("dim").alias("of"), F.col("shard").alias("ask_shard"))
    asked = queries.distinct().withColumn("dim", F.size("vector"))
    blocks = asked.groupBy("dim").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("n_blocks"))
    asked = asked.join(blocks, "dim").withColumn("block", F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int"))
    asked = (asked.join(shards, F.col("dim") == F.col("of"))
             .select(F.col("dim").alias("ask_dim"), "ask_shard", F.col("block").alias("ask_block"), "id", "vector"))
    served = (index.join(blocks, "dim")
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).drop("n_blocks"))

    def run(shard: pa.Table, block: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if shard.num_rows and block.num_rows:
            graph, ids = stored_graph(shard.to_pylist()[0])
            for query, vector in zip(block["id"].to_pylist(), block["vector"].to_pylist()):
                hits = []
                for _, node in graph.ask(np.array([*vector, 0.0]), max(breadth, k + 1))[:k + 1]:
                    score = math.fsum(map(float.__mul__, vector, graph.vectors[node, :-1].tolist()))
                    hits += ((-score, i) for i in ids[node].tolist() if i != query)
                out += ((query, i, -s) for s, i in heapq.nsmallest(k, hits))
        cols = list(zip(*out)) or [(), (), ()]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()),
                         "score": pa.array(cols[2], pa.float64())})

    n_tasks = 4 * max(1, served.select("dim").count())  # more than groups, so few share a task
    served = served.repartition(n_tasks, "dim", "shard", "block")
    asked = asked.repartition(n_tasks, "ask_dim", "ask_shard", "ask_block")
    hits = served.groupBy("dim", "shard", "block").cogroup(
        asked.groupBy("ask_dim", "ask_shard", "ask_block")).applyInArrow(
        run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (hits.distinct().withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def nearest(rows: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """The k nearest rows of each query among all others; ``rows`` needs
    vec_id and embedding."""
    usable = rows.where(F.col("vec_id").isNotNull() & valid(F.col("embedding")))
    usable = usable.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector"),
                           is_query.alias("asks"))
    return search_index(build_index(usable.select("id", "vector"), k), usable.where("asks").select("id", "vector"), k)
