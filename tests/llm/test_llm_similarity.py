"""Near copies, nearest neighbours, mixes and the pipeline against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aerowx.llm import hnsw, minhash_dedup, mixing
from aerowx.llm.components import components

SCHEMA = "doc_id long, text string, node string, key string, row string, kept string"


def rows_of(df):
    return [r.asDict() for r in df.collect()]


class Union(dict):
    def find(self, i):
        while self.setdefault(i, i) != i:
            i = self[i]
        return i

    def join(self, i, j):
        i, j = self.find(i), self.find(j)
        self[max(i, j)] = min(i, j)


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(docs, percent):
    """doc_id -> (set size, smallest id linked with it)."""
    sets = [(i, shingles(t)) for i, t in docs]
    up = Union()
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            k = len(a & b)
            if k and 100 * k >= percent * (len(a) + len(b) - k):
                up.join(i, j)
    return {i: (len(s), up.find(i)) for i, s in sets}


def near_copies(seed, n, words, edits):
    """A chain and a star of edited copies of one text."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randint(0, 5000)}" for _ in range(words)]
    out, now = [" ".join(base)], list(base)
    for _ in range(n):
        now[rnd.randrange(words)] = f"c{rnd.randint(0, 9999)}"
        out.append(" ".join(now))
        star = list(base)
        for _ in range(rnd.randint(0, edits)):
            star[rnd.randrange(words)] = f"s{rnd.randint(0, 9999)}"
        out.append(" ".join(star))
    return out


@pytest.fixture(scope="module")
def corpus():
    texts = [None, "", " \t", "one", "ONE", "one two three four", "One Two three four", "a b c d e", "a b c d e f",
             "É a b c d", "é a b c d", "word " * 3000, "word " * 5000]
    for seed in range(4):
        texts += near_copies(seed, 14, 60 * (seed + 1), 4 + 3 * seed)
    random.Random(9).shuffle(texts)
    return list(enumerate(texts, 1))


@pytest.mark.parametrize("percent, block", [(85, minhash_dedup.BLOCK_SHINGLES), (80, 500)])
def test_near_dedup(spark, corpus, percent, block, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK_SHINGLES", block)  # 500: bands of several blocks
    docs = spark.createDataFrame([(i, t, "n", "k", "r", "x") for i, t in corpus], SCHEMA)
    got = {r["doc_id"]: r for r in rows_of(minhash_dedup.near_dedup(docs, percent))}
    want = brute_components(corpus, percent)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())
    assert len({c for _, c in want.values()}) < len(corpus) - 40  # the copies do group


def test_near_dedup_cases(spark):
    docs = spark.createDataFrame([(5, "a b c d e f", "n", "k", "r", "x")] * 2 + [
        (None, "a b c d e f", "n", "k", "r", "x"), (7, None, "n", "k", "r", "x"), (None, "q", "n", "k", "r", "x")], SCHEMA)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in
                  rows_of(minhash_dedup.near_dedup(docs))), key=str)
    assert got == sorted([(5, 2, 5, True)] * 2 + [(None, 2, 5, False), (7, 0, 7, True), (None, 1, None, True)], key=str)
    kept = minhash_dedup.keep_representatives(docs)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in rows_of(kept)) == ["5", "7", "None"]
    assert rows_of(minhash_dedup.near_dedup(spark.createDataFrame([], SCHEMA))) == []


def test_texts_without_an_id_of_their_own_stay(spark):
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(None, "first clean text of five words"), (None, "second clean text of five words"), (None, "third"),
            (3, near), (5, near + " more"), (5, "a different text under the same id"), (6, "six one"), (6, "six two"),
            (None, "p " + near.upper().replace("W", "v")), (None, "q " + near.upper().replace("W", "v")), (None, "third")]
    docs = spark.createDataFrame([(i, t, "n", "k", "r", "x") for i, t in rows], SCHEMA)
    for _ in range(2):  # and again the same
        got = [(r["doc_id"], r["text"]) for r in rows_of(minhash_dedup.keep_representatives(docs))]
        alike = [t for i, t in got if i is None and "v1" in t]  # near copies of each other without an id
        assert len(alike) == 1
        assert sorted(((i, t) for i, t in got if "v1" not in t), key=str) == sorted(
            {*rows[:4], *rows[5:8]}, key=str)


def test_shingle_sets_are_the_texts_sets(corpus):
    texts = [t for _, t in corpus]
    for got, text in zip(minhash_dedup.shingle_sets(texts), texts):
        assert len(got) == len(shingles(text))
    a, b = minhash_dedup.shingle_sets(["x  a b\tc d", "X a b c D"])
    assert a.tolist() == b.tolist()


def test_posterior_bounds():
    for percent in (80, 85):
        last = 0
        for n, least in minhash_dedup.least_matches(percent):
            t = percent / 100
            # the posterior tail by numeric integration of the Beta density
            grid = np.linspace(0, 1, 200_001)
            for m, below in ((least - 1, True), (least, False)):
                density = grid ** m * (1 - grid) ** (n - m)
                tail = density[grid >= t].sum() / density.sum()
                assert (tail < minhash_dedup.MISS) == below
            assert last < least < n * t
            last = least


def test_signatures_estimate_similarity():
    rnd = random.Random(4)
    universe = minhash_dedup.mix(np.arange(4000, dtype=np.uint64))
    for share in (0.3, 0.6, 0.9):
        errors = []
        for _ in range(40):
            both = rnd.sample(range(4000), 600)
            k = int(600 * share)
            a, b = universe[both[:k] + both[k:(k + 600) // 2]], universe[both[:k] + both[(k + 600) // 2:]]
            errors.append(np.mean(minhash_dedup.min_hashes(np.sort(a)) == minhash_dedup.min_hashes(np.sort(b))) - k / 600)
        assert abs(np.mean(errors)) < 0.02


def test_components(spark):
    rnd = random.Random(6)
    links = [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(230)] + [(i, i + 1) for i in range(500, 560)]
    links += [(700, i) for i in range(701, 800)] + links[:20] + [(900, 900)]
    up = Union()
    for a, b in links:
        up.join(a, b)
    got = {r["node"]: r["root"] for r in rows_of(components(spark.createDataFrame(links, "a int, b int")))}
    assert got == {i: up.find(i) for a, b in links for i in (a, b) if a != b}
    assert rows_of(components(spark.createDataFrame([], "a int, b int"))) == []


# nearest neighbours

def brute_nearest(vectors, query, k):
    scores = sorted(((-math.fsum(a * b for a, b in zip(v, vectors[query])), i) for i, v in vectors.items() if i != query))
    return [(i, -s) for s, i in scores[:k]]


def recall(got, vectors, k):
    hits = total = 0
    for q, found in got.items():
        assert [r["rank"] for r in found] == list(range(1, len(found) + 1))
        want = brute_nearest(vectors, q, k)
        exact = dict(brute_nearest(vectors, q, len(vectors)))
        for r in found:
            assert r["score"] == exact[r["vec_id"]]
        assert [(-r["score"], r["vec_id"]) for r in found] == sorted((-r["score"], r["vec_id"]) for r in found)
        hits += len({i for i, _ in want} & {r["vec_id"] for r in found})
        total += len(want)
    return hits / total


def by_query(df):
    got = {}
    for r in sorted(rows_of(df), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r)
    return got


def test_nearest_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    vectors = {r.vec_id: list(map(float, r.embedding)) for r in rows.collect()}
    got = by_query(hnsw.nearest(rows, F.col("vec_id") % 20 == 0))
    assert set(got) == {i for i in vectors if i % 20 == 0} and all(len(f) == 20 for f in got.values())
    assert recall(got, vectors, 20) >= 0.9


def test_nearest_of_any_length_with_copies(spark, monkeypatch):
    rng = np.random.default_rng(8)
    vectors = {i: (rng.normal(size=8) * rng.uniform(0.1, 5)).astype(np.float32).astype(float).tolist() for i in range(900)}
    for i in range(300, 600):
        vectors[i] = vectors[300]  # a third of all rows share a vector
    bad = [(1000, None), (1001, []), (1002, [0.0] * 8), (1003, [1.0, None] + [0.0] * 6), (1004, [float("nan")] * 8),
           (1005, [float("inf")] * 8), (None, [1.0] * 8), (1020, None)]
    rows = spark.createDataFrame([(i, v, "x") for i, v in [*vectors.items(), *bad, (0, vectors[0])]],
                                 "vec_id long, embedding array<float>, vector string")
    index_of = hnsw.build_index
    monkeypatch.setattr(hnsw, "build_index", lambda r, k: index_of(r, k, 200))  # several shards
    got = by_query(hnsw.nearest(rows, F.col("vec_id") % 20 == 0))
    assert set(got) == {i for i in vectors if i % 20 == 0}
    assert recall(got, vectors, 20) >= 0.9
    # ties of equal vectors go to the smaller ids
    assert [r["vec_id"] for r in got[400]][:3] == [i for i, _ in brute_nearest(vectors, 400, 3)]


def test_nearest_small(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 0.0]), (3, [1.0, 2.0, 3.0])],
                                 "vec_id long, embedding array<float>")
    got = by_query(hnsw.nearest(rows, F.col("vec_id") == 0))
    assert [(r["vec_id"], r["score"]) for r in got[0]] == [(2, 1.0), (1, 0.5)]
    assert rows_of(hnsw.nearest(rows.limit(0), F.col("vec_id") == 0)) == []


# mixes

def brute_targets(sizes, weights=mixing.WEIGHTS, share=mixing.SHARE, epochs=mixing.EPOCHS):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    want, capped = share * sum(sizes.values()), set()
    while True:
        rest = want - sum(epochs * sizes[s] for s in capped)
        heavy = sum(weight[s] for s in names if s not in capped)
        target = {s: epochs * sizes[s] if s in capped else weight[s] * rest / heavy for s in names}
        over = {s for s in names if s not in capped and target[s] > epochs * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mix(spark):
    rnd = random.Random(7)
    docs = [(i, "w " * rnd.choice([0, 1, 3, 40, 400]), rnd.choice(["a", "b", "b", "b", "b", "Ä", "z", "é", None, ""]), "x")
            for i in range(1200)]
    docs += [(5000, None, "a", "x"), (5001, "w " * 20_000, "huge", "x"), (5002, None, "none", "x"), docs[3]]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, target string")
    got = rows_of(mixing.mix(frame))
    again = rows_of(mixing.mix(frame.repartition(7)))
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(docs)
    sizes, taken, of = {}, {}, {}
    for i, text, source, _ in docs:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
        of[i] = source
    target = brute_targets(sizes)
    for r in got:
        s = of[r["doc_id"]]
        taken[s] = taken.get(s, 0) + r["taken"]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s], rel=1e-12)
        assert r["taken"] == r["size"] * r["repetitions"] <= 2 * r["size"]
    largest = {s: max(len((t or "").split()) for _, t, x, _ in docs if x == s) for s in sizes}
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 20  # half a document
    mixed = mixing.mixed_rows(frame)
    assert mixed.columns == frame.columns
    assert mixed.count() == sum(r["repetitions"] for r in got)


@pytest.mark.parametrize("same", [lambda i: (None, "w " * 10), lambda i: (None, f"w{i} " * 10),
                                  lambda i: (7, "w " * 10), lambda i: (None, None)])
def test_mix_of_rows_without_ids_of_their_own(spark, same):
    """A third of a source has no id or the same one, with equal or different
    texts; the target is met to half a document all the same."""
    docs = [(i, "v " * 10, "big", i) for i in range(100, 700)]
    docs += [(*same(i), "big", i) for i in range(300)]
    docs += [(i, "u " * 10, "small", i) for i in range(1000, 1090)] + [(None, "t " * 10, "zero", 0)] * 60
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, place long").repartition(5)
    got = rows_of(mixing.mix(frame))
    again = rows_of(mixing.mix(frame.repartition(17)))
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(docs)
    by_target = {}
    for r in got:
        d = by_target.setdefault((r["source_size"], r["target"]), [0])
        d[0] += r["taken"]
        assert r["taken"] == r["size"] * r["repetitions"] <= 2 * r["size"]
    assert len(by_target) == 3
    for (_, target), (taken,) in by_target.items():
        assert abs(taken - target) <= 5  # half a document
    mixed = mixing.mixed_rows(frame)
    assert mixed.columns == frame.columns
    assert mixed.count() == sum(r["repetitions"] for r in got)


def test_mix_of_nothing(spark):
    schema = "doc_id long, text string, source string"
    assert rows_of(mixing.mix(spark.createDataFrame([], schema))) == []
    assert rows_of(mixing.mixed_rows(spark.createDataFrame([], schema))) == []
    got = rows_of(mixing.mix(spark.createDataFrame([(1, None, "a"), (2, "", None)], schema)))
    assert [(r["target"], r["taken"]) for r in got] == [(0.0, 0)] * 2


# pipeline

def test_pipeline(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "source_mix", "byte_bpe"]
    kept = [rows_of(docs)]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), "test-stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append(rows_of(docs))
    assert {r["doc_id"] for r in kept[1]} == {r["doc_id"] for r in kept[0] if any(map(str.isalpha, r["text"]))}
    last = {}
    for r in kept[1]:
        last[r["text"]] = max(r["doc_id"], last.get(r["text"], -1))
    assert sorted(r["doc_id"] for r in kept[2]) == sorted(last.values())
    roots = brute_components([(r["doc_id"], r["text"]) for r in kept[2]], corpus_pipeline.NEAR_PERCENT)
    assert sorted(r["doc_id"] for r in kept[3]) == sorted({c for _, c in roots.values()})
    import tiktoken

    from aerowx.llm.byte_bpe import codec
    ranks = codec(public_tokenizers.path(corpus_pipeline.RANKS), public_tokenizers.PATTERN).ranks
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows_of(corpus_pipeline.run(spark, sf_dir))
    want = []
    for r in kept[4]:
        ids = enc.encode_ordinary(r["text"])
        want.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(r["text"].encode()).hexdigest()))
    assert sorted(tuple(r.values()) for r in got) == sorted(want)
