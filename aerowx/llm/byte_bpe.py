"""Byte-level BPE encoding and decoding with DuckDB inside Spark tasks.

A text is cut into words by the tokenizer's pattern; each distinct word of a
run of documents is encoded once.  The words' bytes become token-position rows
(word, position, token, next token); a recursive query joins them to the merge
table and contracts, in every word at once, the leftmost pair of the smallest
rank, until no word has a pair left to merge.  Decoding joins the tokens of a
document to the vocabulary's bytes and concatenates them by an ordered
aggregation.

Ranks come from a file of base64 byte strings and ranks whose path is a
parameter.  Id sequences are little-endian unsigned 32-bit integers in a
binary column.

Words over ``LONG_WORD`` bytes would take one recursion step for every merge
over all their rows, which is quadratic; a small heap does the same merges in
the same order for them.

Defined cases: null text counts as empty; an empty text has no token and
decodes to empty bytes; strings of special tokens are ordinary text; repeated
rows are encoded alike; other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import sys
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import encode_pieces, release_memory, slices

LONG_WORD = 256
#: Words in one recursive query and the sum of their squared bytes: the
#: recursion keeps every step, at most half the square in rows for a word.
#: Then tokens in one decoding query, pieces and bytes that a worker keeps
#: before it starts anew, bytes of text taken at a time.
BLOCK_WORDS = 20_000
BLOCK_SQUARES = 8_000_000
BLOCK_TOKENS = 1 << 18
CACHE_ENTRIES = 300_000
CACHE_BYTES = 96 << 20
SLICE_BYTES = 4 << 20

#: The code points of Unicode's White_Space property, which is
#: what the pattern's \s stands for.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Where a space has white space beside it, a match of the pattern may hold
#: both; everywhere else matches end at spaces, and a text can be encoded piece
#: by piece, each with the space before it.
BLANK_RUN = f" [{SPACE}]|[{SPACE}] "

CONTRACT = """
WITH RECURSIVE state(step, word, pos, token, nxt) AS (
  SELECT 0, word, pos, token, nxt FROM first_state
  UNION ALL
  (WITH ranked AS (
     SELECT s.*, m.rank FROM state s LEFT JOIN merges m ON m.pair = s.token::BIGINT * 4294967296 + s.nxt),
   best AS (  -- of the smallest rank, the leftmost position
     SELECT word, min(rank::BIGINT * 1048576 + pos) AS k FROM ranked WHERE rank IS NOT NULL GROUP BY word),
   merge AS (SELECT word, (k >> 20)::INTEGER AS token, (k & 1048575)::INTEGER AS pos FROM best)
   -- the row at the position goes, the one after it becomes the merged token
   SELECT r.step + 1, r.word, CASE WHEN r.pos > m.pos THEN r.pos - 1 ELSE r.pos END,
          CASE WHEN r.pos = m.pos + 1 THEN m.token ELSE r.token END,
          CASE WHEN r.pos = m.pos - 1 THEN m.token ELSE r.nxt END
   FROM ranked r JOIN merge m ON r.word = m.word WHERE r.pos <> m.pos)),
last AS (SELECT word, max(step) AS step FROM state GROUP BY word)
SELECT word, token FROM state JOIN last USING (word, step) ORDER BY word, pos
"""

#: The connection runs one thread, so the aggregation meets the pieces in the
#: order of the sorted rows.
DECODE = """
SELECT doc, unhex(string_agg(hex, '')) AS bytes
FROM (SELECT doc, hex FROM tokens JOIN vocabulary USING (token) ORDER BY doc, pos) GROUP BY doc
"""


def blocks(words: list[tuple[str, bytes]]) -> Iterator[list[tuple[str, bytes]]]:
    """Runs of (word, bytes) whose recursion fits the memory of the database."""
    lo = squares = 0
    for i, (_, b) in enumerate(words):
        squares += len(b) ** 2
        if i > lo and (squares > BLOCK_SQUARES or i - lo == BLOCK_WORDS):
            yield words[lo:i]
            lo, squares = i, len(b) ** 2
    if words:
        yield words[lo:]


def held_bytes(key: str, ids: bytes) -> int:
    """About what an entry of a cache takes, its place in the table included."""
    return sys.getsizeof(key) + sys.getsizeof(ids) + 100


class Codec:
    """Ranks, merge table and caches of one Python worker."""

    def __init__(self, ranks_path: str, pattern: str):
        import duckdb
        import regex
        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pattern = regex.compile(pattern.replace(r"\S", f"[^{SPACE}]").replace(r"[^\s", f"[^{SPACE}")
                                     .replace(r"\s", f"[{SPACE}]"))
        self.byte_tokens = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "256MB", "temp_directory": ""})
        pairs = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items()
                 for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        left, right, rank = (np.array(c, dtype=np.int64) for c in zip(*pairs))
        self._table("merges", pair=left * 4294967296 + right, rank=rank.astype(np.int32))
        self._table("vocabulary", token=np.fromiter(self.ranks.values(), dtype=np.int32),
                    hex=[t.hex().upper() for t in self.ranks])
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.held = 0

    def _table(self, name, **cols):
        self.db.register("incoming", pa.table(cols))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def merge_words(self, words: list[str]) -> None:
        """Encode new words into the cache."""
        raw = [w.encode("utf-8", "replace") for w in words]
        self.words.update((w, self.merge_long(b)) for w, b in zip(words, raw) if len(b) > LONG_WORD)
        short = [(w, b) for w, b in zip(words, raw) if len(b) <= LONG_WORD]
        for block in blocks(short):
            lens = np.array([len(b) for _, b in block])
            ends = np.cumsum(lens)
            token = self.byte_tokens[np.frombuffer(b"".join(b for _, b in block), dtype=np.uint8)]
            nxt = np.append(token[1:], -1)
            nxt[ends - 1] = -1
            self.db.register("first_state", pa.table({
                "word": np.repeat(np.arange(len(block), dtype=np.int32), lens),
                "pos": (np.arange(len(token)) - np.repeat(ends - lens, lens)).astype(np.int32),
                "token": token, "nxt": nxt.astype(np.int32)}))
            got = self.db.sql(CONTRACT).to_arrow_table()
            self.db.unregister("first_state")
            stop = np.cumsum(np.bincount(got["word"].to_numpy(), minlength=len(block))) * 4
            ids = got["token"].to_numpy().astype("<u4").tobytes()
            start = 0
            for (w, _), end in zip(block, stop.tolist()):
                self.words[w] = ids[start:end]
                start = end

    def merge_long(self, raw: bytes) -> bytes:
        """The same contractions for one long word, with a heap of pairs."""
        parts: list[bytes | None] = [raw[i:i + 1] for i in range(len(raw))]
        after = list(range(1, len(raw) + 1))
        before = list(range(-1, len(raw) - 1))

        def pair(i):
            j = after[i]
            both = parts[i] + parts[j] if j < len(parts) else None
            return (self.ranks[both], i, both) if both in self.ranks else None

        heap = [p for p in map(pair, range(len(raw))) if p]
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            if parts[i] is None or after[i] >= len(parts) or parts[i] + parts[after[i]] != both:
                continue  # one of the two has been merged meanwhile
            j = after[i]
            parts[i], parts[j], after[i] = both, None, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (p := pair(k)):
                    heapq.heappush(heap, p)
        return np.array([self.ranks[p] for p in parts if p is not None], dtype="<u4").tobytes()

    def ids_of(self, words: Iterable[str]) -> list[bytes]:
        words = list(words)
        new = {w for w in words if w not in self.words}
        if new:
            self.merge_words(list(new))
            self.held += sum(held_bytes(w, self.words[w]) for w in new)
        return list(map(self.words.__getitem__, words))

    def ids_of_pieces(self, pieces: list[str]) -> list[bytes]:
        fresh = [p for p in pieces if p not in self.pieces]
        cut = [self.pattern.findall(p) for p in fresh]
        ids = iter(self.ids_of(chain.from_iterable(cut)))
        for p, words in zip(fresh, cut):
            self.pieces[p] = b"".join(islice(ids, len(words)))
            self.held += held_bytes(p, self.pieces[p])
        return list(map(self.pieces.__getitem__, pieces))

    def encode(self, texts: pa.Array) -> list[bytes]:
        if len(self.pieces) > CACHE_ENTRIES or self.held > CACHE_BYTES:
            self.pieces.clear()
            self.words.clear()
            self.held = 0
        texts = pc.fill_null(texts, "")
        apart = pc.match_substring_regex(texts, BLANK_RUN)
        found = iter(encode_pieces(texts.filter(pc.invert(apart)), self.ids_of_pieces, 4, keep_blank=True))
        whole = (b"".join(self.ids_of(self.pattern.findall(t))) for t in texts.filter(apart).to_pylist())
        return [next(whole if a else found) for a in apart.to_pylist()]

    def decode(self, sequences: list[bytes | None]) -> list[bytes]:
        """Sequences are cut into runs of at most a block, so that one long
        document needs no more memory than many short ones."""
        runs = [(i, s[at:at + 4 * BLOCK_TOKENS]) for i, s in enumerate(sequences) if s
                for at in range(0, len(s), 4 * BLOCK_TOKENS)]
        out: list[list[bytes]] = [[] for _ in sequences]
        lo = 0
        while lo < len(runs):
            hi, size = lo, 0
            while hi < len(runs) and (hi == lo or size + len(runs[hi][1]) <= 4 * BLOCK_TOKENS):
                size += len(runs[hi][1])
                hi += 1
            block = runs[lo:hi]
            ids = np.frombuffer(b"".join(r for _, r in block), dtype="<u4").astype(np.int32)
            self.db.register("tokens", pa.table({
                "doc": np.repeat(np.arange(len(block), dtype=np.int32), [len(r) // 4 for _, r in block]),
                "pos": np.arange(len(ids), dtype=np.int32), "token": ids}))
            for run, data in sorted(self.db.execute(DECODE).fetchall()):
                out[block[run][0]].append(data)
            self.db.unregister("tokens")
            lo = hi
        return list(map(b"".join, out))


@lru_cache(maxsize=2)
def codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """``docs`` (id, text) -> id, n_tokens, ids; with ``decoded`` also
    ``bytes``, decoded from the ids in the same pass over the rows."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for b in slices(batches, "text", SLICE_BYTES):
            ids = c.encode(b.column("text"))
            cols = [b.column("id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decoded:
                cols.append(pa.array(c.decode(ids), pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=["id", "n_tokens", "ids", "bytes"][:len(cols)])
        release_memory()

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(
        run, f"id {id_type}, n_tokens long, ids binary" + ", bytes binary" * decoded)


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``encoded`` (id, n_tokens, ids) -> with ``bytes``, which the ids stand for."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for b in slices(batches, "ids", SLICE_BYTES):
            data = c.decode(b.column("ids").to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(data, pa.binary())],
                                             names=[*b.schema.names, "bytes"])
        release_memory()

    cols = encoded.select("id", "n_tokens", "ids")
    id_type = cols.schema["id"].dataType.simpleString()
    return cols.mapInArrow(run, f"id {id_type}, n_tokens long, ids binary, bytes binary")


def encode_and_decode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.
    ``docs`` needs doc_id and text."""
    found = encode(docs.select(F.col("doc_id").alias("id"), "text"), ranks_path, pattern, decoded=True)
    return found.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("bytes", 256).alias("decoded_sha256"))
