"""Spelling variants: words one edit apart, found by blocked Gram matrices.

**Words.**  Maximal runs of letters are counted over whole texts, task by task,
and added up by Spark.

**Candidates.**  A word is the vector of its letter counts.  One replaced letter
leaves two words at squared distance 2, one inserted or deleted letter at 1.
Words are put into blocks by their counts over ``GROUPS`` groups of letters
(which also gives their length); an edit moves a word to its own block, to one
with one letter more in one group, or to one with a letter moved between two
groups, so only those blocks are paired, each pair once.  Blocks are cut into
chunks of bounded bytes, by a hash of the word; chunk pairs are dealt out
singly, so a block that holds a third of all words is many tasks' work.  For a
pair of chunks one NumPy product gives all squared distances,
``|a|^2 + |b|^2 - 2 a.b``; pairs at 1 (lengths differ by one) or 2 (equal
lengths) are kept and their edits verified on the code points.

**Forms.**  Each chunk pair passes on, per word, how many near words it met and
the best of them; Spark adds these up.  Forms are followed to their last by
pointer doubling: a form has at least ``ratio`` times the word's count, so a
chain is short.

Defined cases: null texts and texts without letters have no words; a word of any
length is one word (chunks are cut by bytes); a null doc_id hashes as an empty
one; repeated rows count each; ties go to the smaller word in code-point order;
empty input gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release_memory, slices, text_or_empty

MIN_LETTERS = 5
MIN_COUNT = 3
RATIO = 2
DAMAGE = 97               # a run whose hash this divides loses one letter
GROUPS = 8
CHUNK_BYTES = 4096        # letters of a chunk of a block
SHORT = 64                # runs up to so many bytes are hashed by table
HELD_BYTES = 48 << 20     # counted words that a task holds before it passes them on

_U = np.uint64
#: Bytes of [A-Za-zÀ-ÿ] in UTF-8: letters, and C3 with what follows it.
_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[0x41:0x5B] = _PLAIN[0x61:0x7B] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: Letters that a counted word can have, as code points of one byte.
_LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)])


def _crc_table() -> np.ndarray:
    """What one zero byte does to a CRC-32, by its low byte."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


def runs(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """(runs of letters, A-Z lower-cased, as UTF-8; runs of each text)."""
    buf = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    lead = buf == 0xC3
    inside = _PLAIN[buf] | lead
    inside[1:] |= lead[:-1]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    start, stop = edge[0::2], edge[1::2]
    ends = np.cumsum([len(t) + 1 for t in texts])
    per_text = np.diff(np.searchsorted(start, np.concatenate(([0], ends))))
    offsets = np.concatenate(([0], np.cumsum(stop - start))).astype(np.int32)
    letters = _LOWER[buf[inside]]
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]), per_text


def run_hashes(distinct: list[bytes], number: np.ndarray, text: np.ndarray, ids: list[bytes]) -> np.ndarray:
    """The CRC-32 of ``<id>:<run>`` for each run (``number`` of its distinct
    run, ``text`` it stands in).  A CRC of two parts is that of the first,
    carried over as many zero bytes as the second has, xor that of the second."""
    own = np.array([zlib.crc32(w) for w in distinct], dtype=np.uint32)
    size = np.array([len(w) for w in distinct], dtype=np.int64)
    table = _crc_table()
    carried = np.empty((SHORT + 1, len(ids)), dtype=np.uint32)
    carried[0] = [zlib.crc32(i + b":") for i in ids]
    for k in range(1, SHORT + 1):
        carried[k] = table[carried[k - 1] & np.uint32(0xFF)] ^ (carried[k - 1] >> np.uint32(8))
    length = size[number]
    out = carried[np.minimum(length, SHORT), text] ^ own[number]
    for i in np.flatnonzero(length > SHORT):
        out[i] = zlib.crc32(distinct[number[i]], zlib.crc32(ids[text[i]] + b":"))
    return out


def counted(texts: list[bytes], ids: list[bytes], damage: int, min_letters: int) -> pa.Table:
    """(word, n) of the given texts; shorter words are left out."""
    found, per_text = runs(texts)
    coded = found.dictionary_encode()
    number = coded.indices.to_numpy()
    distinct = coded.dictionary.to_pylist()
    text = np.repeat(np.arange(len(texts)), per_text)
    hashes = run_hashes(distinct, number, text, ids) if len(number) else np.empty(0, dtype=np.uint32)
    hurt = hashes % np.uint32(damage) == 0
    n = np.bincount(number[~hurt], minlength=len(distinct))
    extra: Counter = Counter()
    for k, h in zip(number[hurt].tolist(), hashes[hurt].tolist()):
        word = distinct[k].decode()
        at = h % len(word)
        extra[word[:at] + word[at + 1:]] += 1
    words = pa.concat_arrays([coded.dictionary.cast(pa.string()), pa.array(list(extra), pa.string())])
    t = pa.table({"word": words, "n": np.concatenate((n, np.fromiter(extra.values(), np.int64, len(extra))))})
    return t.filter(pc.and_(pc.greater_equal(pc.utf8_length(t["word"]), min_letters), pc.greater(t["n"], 0)))


def word_counts(docs: DataFrame, damage: int = DAMAGE, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of at least ``min_letters`` letters that occur at
    least ``min_count`` times."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def added():
            t = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
            return t.rename_columns(["word", "n"])

        for b in slices(batches, "text", 2 << 20):
            texts = [t.encode("utf-8", "replace") for t in b.column(1).to_pylist()]
            held.append(counted(texts, [i.encode() for i in b.column(0).to_pylist()], damage, min_letters))
            size += held[-1].nbytes
            if size > HELD_BYTES:
                held = [added()]
                size = held[0].nbytes
                if size > HELD_BYTES // 2:      # little repeats here
                    yield from held[0].to_batches(max_chunksize=20000)
                    held, size = [], 0
        if held:
            yield from added().to_batches(max_chunksize=20000)
        del held
        release_memory()

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       text_or_empty(text_col).alias("text"))
    parts = rows.mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ------------------------------------------------------------------ blocks

def letter_counts(words: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(words x letters counts, code points of each word)."""
    points = [np.frombuffer(w.encode("latin-1"), dtype=np.uint8) for w in words]
    column = np.full(256, -1)
    column[_LETTERS] = np.arange(len(_LETTERS))
    row = np.repeat(np.arange(len(points)), [len(p) for p in points])
    flat = column[np.concatenate(points)] if points else np.empty(0, dtype=np.int64)
    counts = np.bincount(row * len(_LETTERS) + flat, minlength=len(points) * len(_LETTERS))
    return counts.reshape(len(points), len(_LETTERS)), points


def letter_groups(words: DataFrame, groups: int = GROUPS) -> np.ndarray:
    """The group of each letter: letters by falling total, each to the group
    of least total so far.  One row of totals per letter reaches the driver."""
    def totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(_LETTERS), dtype=np.int64)
        for b in slices(batches, "word", 1 << 20):
            total += letter_counts(b.column(0).to_pylist())[0].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["letter", "n"])

    rows = words.select("word").mapInArrow(totals, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n"))
    load, group = [0] * groups, np.zeros(len(_LETTERS), dtype=np.int64)
    for r in sorted(rows.collect(), key=lambda r: (-r["n"], r["letter"])):
        g = load.index(min(load))
        group[r["letter"]] = g
        load[g] += r["n"]
    return group


def _block_name(c: np.ndarray) -> str:
    return ".".join(map(str, c.tolist()))


def with_blocks(words: DataFrame, group: np.ndarray, groups: int) -> DataFrame:
    """Every word with its block: its letters in each group, joined by dots."""
    into = np.eye(groups, dtype=np.int64)[group]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "word", 1 << 20):
            counts, _ = letter_counts(b.column(0).to_pylist())
            keys, which = np.unique(counts @ into, axis=0, return_inverse=True)
            names = pa.array([_block_name(k) for k in keys], pa.string())
            yield pa.RecordBatch.from_arrays([names.take(pa.array(which.ravel())), *b.columns], ["block", "word", "n"])

    return words.mapInArrow(run, "block string, word string, n long")


def neighbours(block: str) -> list[str]:
    """The blocks that this one is paired with: itself, one letter more, or a
    letter moved to a later group (from an earlier one it is the other's turn)."""
    c = list(map(int, block.split(".")))
    out = [block]
    for i in range(len(c)):
        c[i] += 1
        out.append(".".join(map(str, c)))
        for j in range(i):
            if c[j]:
                c[j] -= 1
                out.append(".".join(map(str, c)))
                c[j] += 1
        c[i] -= 1
    return out


# ------------------------------------------------------------------ pairs

class Chunk:
    """Words of one block, in code-point order, with counts and letters."""

    def __init__(self, words: list[str], n: np.ndarray):
        order = sorted(range(len(words)), key=words.__getitem__)
        self.words, self.n = [words[i] for i in order], n[order]
        counts, points = letter_counts(self.words)
        # products are exact in 32 bits up to 2**24
        self.counts = counts.astype(np.float32 if len(points[0]) <= 4096 else np.float64)
        self.size = (self.counts * self.counts).sum(axis=1)
        self.points = np.stack(points)          # the words of a block have one length


def near_pairs(a: Chunk, b: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of words of ``a`` and ``b`` (as long, or one letter longer)
    that are one edit apart."""
    gap = b.points.shape[1] - a.points.shape[1]
    distance = a.size[:, None] + b.size[None, :] - 2 * (a.counts @ b.counts.T)
    i, j = np.nonzero(distance == (2 if gap == 0 else 1))
    keep = []
    for lo in range(0, len(i), 1 << 16):
        s, t = a.points[i[lo:lo + (1 << 16)]], b.points[j[lo:lo + (1 << 16)]]
        if gap == 0:
            keep.append((s != t).sum(axis=1) == 1)
        else:   # equal up to the inserted letter, and one place on behind it
            behind = np.cumsum(s != t[:, :-1], axis=1) > 0
            keep.append(~(behind & (s != t[:, 1:])).any(axis=1))
    ok = np.concatenate(keep) if keep else np.empty(0, dtype=bool)
    return i[ok], j[ok]


def met(of: Chunk, other: Chunk, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """Per word of ``of``: near words met in ``other``, and the best of them."""
    order = np.lexsort((j, -other.n[j], i))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.diff(i, prepend=-1))
    best = j[first]
    return pa.RecordBatch.from_arrays(
        [pa.array([of.words[k] for k in i[first].tolist()], pa.string()), pa.array(np.diff(first, append=len(i))),
         pa.array(other.n[best]), pa.array([other.words[k] for k in best.tolist()], pa.string())],
        ["word", "n_near", "best_n", "best"])


def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive by home chunk, the home's own words first."""
    home = name = None
    for b in batches:
        for r in b.to_pylist():
            chunk = Chunk(r["words"], np.array(r["ns"], dtype=np.int64))
            if (r["home"], r["home_chunk"]) != name:
                name, home = (r["home"], r["home_chunk"]), chunk
                i, j = near_pairs(home, home)
            else:
                i, j = near_pairs(home, chunk)
            if len(i):
                yield met(home, chunk, i, j)
                if chunk is not home:
                    yield met(chunk, home, j, i)
    release_memory()


def near_words(words: DataFrame, groups: int = GROUPS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(word, n_near, best_n, best): per word with near words their number and
    the one of largest n (ties: smallest)."""
    placed = materialize(with_blocks(words, letter_groups(words, groups), groups), "spelling-words")
    sizes = materialize(placed.groupBy("block").agg(
        F.ceil(F.sum(F.octet_length("word")) / chunk_bytes).cast("int").alias("chunks")), "spelling-blocks")
    chunks = materialize(
        placed.join(sizes, "block").withColumn("chunk", F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int"))
        .groupBy("block", "chunk").agg(F.collect_list(F.struct("word", "n")).alias("w"))
        .select("block", "chunk", F.col("w.word").alias("words"), F.col("w.n").alias("ns")), "spelling-chunks")

    def paired(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(h, t) for h in b.column(0).to_pylist() for t in neighbours(h)]
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in rows], pa.string()),
                                              pa.array([t for _, t in rows], pa.string())], ["home", "block"])

    # block pairs where both exist, then chunk pairs, a row for each
    blocks = sizes.select("block").mapInArrow(paired, "home string, block string").join(sizes, "block")
    blocks = blocks.join(sizes.select(F.col("block").alias("home"), F.col("chunks").alias("homes")), "home")
    upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    pairs = blocks.select("*", upto(F.col("homes")).alias("home_chunk")).select("*", upto(F.col("chunks")).alias("chunk"))
    pairs = pairs.where((F.col("home") != F.col("block")) | (F.col("home_chunk") < F.col("chunk")))
    others = pairs.join(chunks, ["block", "chunk"]).select("home", "home_chunk", F.lit(1).alias("role"), "words", "ns")
    own = chunks.select(F.col("block").alias("home"), F.col("chunk").alias("home_chunk"), F.lit(0).alias("role"),
                        "words", "ns")
    dealt = own.unionByName(others).repartition("home", "home_chunk").sortWithinPartitions("home", "home_chunk", "role")
    some = dealt.mapInArrow(compare, "word string, n_near long, best_n long, best string")
    return some.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                    F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best"))).alias("b")).select(
        "word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last.  Each round
    doubles the steps taken, until none moves."""
    roots = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = roots.select(F.col("word").alias("w"), F.col("root").alias("further"))
        moved = materialize(roots.join(on, roots["root"] == on["w"], "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "spelling-roots")
        roots = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return roots


def spelling_variants(docs: DataFrame, damage: int = DAMAGE, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT,
                      ratio: int = RATIO, groups: int = GROUPS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per word: n, n_near, its form (the near word of largest n, if that is
    ``ratio`` times its own or more) with form_n, and the root that the forms
    lead to."""
    words = materialize(word_counts(docs, damage, min_letters, min_count), "spelling-counts")
    near = near_words(words, groups, chunk_bytes)
    known = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best")).alias("form"),
        F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_n")).alias("form_n")), "spelling-forms")
    roots = follow(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
