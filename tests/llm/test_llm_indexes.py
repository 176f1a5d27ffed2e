"""Spelling variants, bisector clusters and the phrase index against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from aerowx.llm import bisector_clusters as bc
from aerowx.llm import phrase_index as pi
from aerowx.llm import queries
from aerowx.llm import spelling_variants as sv
from aerowx.llm.common import table
from conftest import SF_SMALL

DOCS = "doc_id long, text string, block string, word string, n string, term string, start string"


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], DOCS)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ------------------------------------------------------------------ 11

def brute_variants(docs, damage=97):
    c = Counter()
    for i, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % damage == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            c[w] += 1
    c = {w: n for w, n in c.items() if len(w) >= 5 and n >= 3}
    near, same = defaultdict(set), defaultdict(list)
    for w in c:
        for i in range(len(w)):
            same[w[:i], w[i + 1:]].append(w)
            shorter = w[:i] + w[i + 1:]
            if shorter in c:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in same.values():
        for a in group:
            near[a].update(b for b in group if b != a)
    form = {}
    for w in c:
        best = min(near[w], key=lambda x: (-c[x], x), default=None)
        if best and c[best] >= 2 * c[w]:
            form[w] = best
    out = {}
    for w, n in c.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), c[form[w]] if w in form else None)
    return out


def variants(df, **options):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
            for r in rows_of(sv.spelling_variants(df, **options))}


def test_variants_of_the_table(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
           for r in rows_of(queries.op11_spelling_variants(spark, SF_SMALL))}
    assert got == brute_variants(docs) and len(got) > 1000


def test_variants_in_small_chunks_of_few_groups(spark):
    rnd = np.random.default_rng(5)
    words = ["".join(rnd.choice(list("abcé"), rnd.integers(5, 8))) for _ in range(700)]
    docs = [(int(i), " ".join(rnd.choice(words, 60))) for i in range(120)]
    want = brute_variants(docs)
    for groups, chunk in ((1, 64), (3, 100), (8, 4096)):
        assert variants(docs_of(spark, docs), groups=groups, chunk_bytes=chunk) == want


def test_variants_of_odd_rows(spark):
    giant = "q" * 1500
    docs = [(1, None), (2, ""), (3, "12 .. \x00"), (None, "straße STRASSE Straße " * 4), (None, "straße"),
            (4, "Ünïcode ünïcode ÜNÏCODE×÷ ünicode" + " łódź hello" * 3), (4, "hello hella hells " * 3),
            (5, f"{giant} {giant} {giant} {giant[:-1]} {giant[:-1]} {giant[:-1]}p"), (6, " ".join([giant] * 5)),
            (7, "abcde abcdef abcdeg " * 200)]
    assert variants(docs_of(spark, docs)) == brute_variants(docs)
    assert variants(docs_of(spark, [])) == {} and variants(docs_of(spark, docs[:3])) == {}


def test_blocks_of_near_words_are_paired_once(spark):
    for block in ("2.0.3", "0.0.0"):
        mine = sv.neighbours(block)
        assert len(mine) == len(set(mine)) and mine[0] == block
        assert not any(block in sv.neighbours(other) for other in mine[1:])


# ------------------------------------------------------------------ 12

def brute_clusters(vectors, k=16, rounds=3):
    kept = []
    for i, v in vectors:
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(64.0 * float(x))) for x in v]))
    named = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    cent = [v for _, v in named[:k]]
    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cent))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        cent = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(cent)]
    got = [(i, *nearest(v)[::-1]) for i, v in kept]
    per = Counter()
    for _, c, d in got:
        per[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return sorted(((i, c, d, per[c], sum(per.values()), sha[c]) for i, c, d in got), key=str)


def clusters(df, **options):
    return sorted((tuple(r) for r in bc.cluster(df, **options).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=str)


def test_clusters_with_ties_and_odd_rows(spark):
    rnd = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rnd.integers(-2, 3, 64) / 64]) for i in range(150)]
    rows += [(i, rows[i][1]) for i in range(20)] + [(None, rows[0][1]), (7, rows[1][1])]      # repeats, a null id
    rows += [(900, None), (901, []), (902, [0.5] * 63), (903, [0.5] * 65), (904, [None] + [0.5] * 63),
             (905, [float("nan")] + [0.1] * 63), (906, [float("inf")] + [0.1] * 63), (907, [-0.001] * 64)]
    schema = "vec_id long, embedding array<float>, cluster string, v string, distance string"
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], schema)
    floats = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert clusters(df) == brute_clusters(floats)
    assert clusters(df.repartition(5), k=3, rounds=1) == brute_clusters(floats, 3, 1)
    few = df.where("vec_id < 4")
    assert clusters(few) == brute_clusters([r for r in floats if r[0] is not None and r[0] < 4])
    assert clusters(df.where("vec_id BETWEEN 900 AND 904")) == [] and clusters(df.limit(0)) == []


def test_clusters_of_far_vectors_do_not_overflow(spark):
    rows = [(i, [s * 1e300] * 64) for i, s in enumerate((1, -1, 1, -1))] + [(9, [0.0] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r[0]: r[1:3] for r in clusters(df, k=2, rounds=0)}
    assert got[0] == got[2] and got[1] == got[3] and got[0] != got[1]


def test_the_tournament_finds_the_nearest_of_all(spark):
    rnd = np.random.default_rng(1)
    cent, x = rnd.integers(-3, 4, (12, 8)), rnd.integers(-3, 4, (5000, 8))
    cent[7] = cent[2]
    got, distance = bc.assign(x, cent)
    every = ((x[:, None, :] - cent[None]) ** 2).sum(axis=2)
    assert (got == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


# ------------------------------------------------------------------ 13

def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def brute_hits(docs, items, window=10, slop=2):
    windows, count = [], Counter(w for _, t in docs for w in words_of(t))
    for i, t in items:
        ws = words_of(t)
        size = min(window, len(ws))
        windows += [("" if i is None else str(i), ws[o:o + size]) for o in range(len(ws) - size + 1) if size]
    out = []
    for d, t in docs:
        ws, hit, found, near = words_of(t), set(), set(), set()
        places = defaultdict(list)
        for p, w in enumerate(ws):
            places[w].append(p)
        for item, win in windows:
            if not all(w in places for w in win):
                continue
            r = min(range(len(win)), key=lambda k: (count[win[k]], k))
            for p in places[win[r]]:
                if ws[max(p - r, 0):p - r + len(win)] == win and p >= r:
                    hit.update(range(p - r, p - r + len(win)))
                    found.add(item)
                if all(any(abs(q - (p - r + k)) <= slop for q in places[w]) for k, w in enumerate(win)):
                    near.add(item)
        out.append((d, len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit), len(near)))
    return sorted(out, key=str)


def hits(docs, items, **options):
    return sorted((tuple(r) for r in pi.decontaminate(docs, items, **options).collect()), key=str)


def items_of(spark, rows, kind="long"):
    return spark.createDataFrame([(*r, "x") for r in rows], f"item_id {kind}, text string, doc string")


def test_planted_passages_and_odd_rows(spark):
    rnd = np.random.default_rng(2)
    word = lambda: "".join(rnd.choice(list("abcde"), rnd.integers(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(int(rnd.integers(12, 30)))) for i in range(10, 16)]
    items += [(1, "Ab"), (2, "zz qq"), (3, ""), (4, None), (None, "k1 k2 k3"), (12, text(15)), (12, items[2][1]),
              (20, " ".join(["aa"] * 25)), (9, "wörter über Äpfel")]
    docs = [(i, text(300)) for i in range(12)]
    for n, (i, t) in enumerate(items):
        ws = words_of(t)
        swapped = [*ws[:3], *ws[4:6], *ws[3:4], *ws[6:]]
        docs += [(100 + n, f"{text(20)} {(t or '').upper()}, {text(20)}"), (200 + n, t), (300 + n, text(9) + " " + " ".join(swapped)),
                 (400 + n, " ".join(ws[2:12]) + ".\n" + " ".join(ws[1:11])), (500 + n, " ".join(ws[:9]))]
    docs += [(None, None), (None, ""), (None, items[0][1]), (None, items[0][1]), (7, "  \t.."), (7, "x" * 300000),
             (8, " ".join(["aa"] * 200)), (9, "wörter über äpfel wörter über Äpfel")]
    df, it = docs_of(spark, docs), items_of(spark, items)
    want = brute_hits(docs, items)
    assert hits(df, it) == want and sum(r[5] for r in want) > 30
    assert hits(df.repartition(7), it.repartition(3)) == want
    assert [r[:6] for r in hits(df, it, slop=0)] == [r[:6] for r in want]
    assert hits(df, it, window=4, slop=1) == brute_hits(docs, items, 4, 1)


def test_empty_tables_and_text_ids(spark):
    docs = [(1, "one two three"), (2, None)]
    assert hits(docs_of(spark, docs), items_of(spark, [])) == brute_hits(docs, [])
    assert hits(docs_of(spark, []), items_of(spark, [(1, "one")])) == []
    items = [("b", "two"), ("a", "three"), ("ä", "one two")]
    assert hits(docs_of(spark, docs), items_of(spark, items, "string")) == brute_hits(docs, items)


def test_many_blocks_give_the_same_rows(spark, monkeypatch):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    rows = [pa.array([i for i, _ in docs]), [(t or "").encode() for _, t in docs]]
    whole = list(pi.index_block(0, rows[0], rows[1]))
    assert sum(b.column(2).null_count == 0 and sum(b.column(2).to_pylist()) or 0 for b in whole) == \
        sum(len(words_of(t)) for _, t in docs)
    got = [tuple(r) for r in queries.op13_decontamination(spark, SF_SMALL).collect()]
    assert sorted(got, key=str) == brute_hits(docs, items)


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_words_are_the_same_however_the_bytes_are_cut(monkeypatch, piece):
    texts = ["Über den Wörtern", "", "a" * 50 + " b", "...", "x1 y2"]
    raw = [t.encode() for t in texts]
    want = pi.word_hashes(raw)
    monkeypatch.setattr(pi, "PIECE", piece)
    got = pi.word_hashes(raw)
    assert (got[0] == want[0]).all() and got[1].tolist() == want[1].tolist() == [len(words_of(t)) for t in texts]
