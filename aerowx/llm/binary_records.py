"""Token ids as length-delimited binary records with a separate offset index.

A data file is a run of records, in ascending doc_id order over all files:

    length    u64  bytes of the payload
    check     u32  masked CRC-32 of the eight length bytes
    payload        the serialized sequence
    check     u32  masked CRC-32 of the payload

A payload is: flags u8 (1: doc_id is null), width u8 (bytes of an id: 2 or 4),
doc_id i64, then the ids.  All numbers are little-endian.  The mask rotates
the CRC right by 15 bits and adds a constant, so that a checksum of data that
holds checksums stays sound.

The index file beside it has one entry per record: offset u64, length u64,
first token of the record within the file u64.  With it a reader fetches any
record alone, in any order (``read_record``).

Texts are range-partitioned by doc_id; one task encodes, frames and writes one
file under the shared folder, through the file system that the folder's URI
names (``pyarrow.fs``).  A file's name is unique to the attempt; the manifest,
itself written to the shared folder, lists the files that count, so lost or
doubled attempts leave nothing in the result.

The tokenizer is one that drops white space and cuts letters and digits from
marks, so a text's ids are the ids of its pieces between blanks and line ends,
one after the other, and a piece's are those of its word and the marks behind
it.  Each distinct word is encoded once.

Defined cases: null text counts as empty and gives the end id only; null
doc_ids come last, equal doc_ids in the order of their texts; very long texts
are one record each, as any other; empty input gives empty results; other
columns are ignored.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerowx.session import scratch_path

from .common import encode_pieces, materialize, slices, text_or_empty

END_ID = 1
CACHE_PIECES = 1_200_000
MARKS = ".,;:!?#$%&*|)\""
MARK_SET = frozenset(MARKS)
READ_BYTES = 4 << 20
#: Fixed value: the constant that the checksum mask adds.
MASK_DELTA = 0xA282EAD8

MANIFEST = "part int, path string, records long, tokens long, bytes long"
LENGTH, CHECK, HEAD, ENTRY = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<BBq"), struct.Struct("<QQQ")


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = LENGTH.pack(len(payload))
    return b"".join((length, CHECK.pack(masked_crc(length)), payload, CHECK.pack(masked_crc(payload))))


def index_entry(offset: int, length: int, first_token: int) -> bytes:
    return ENTRY.pack(offset, length, first_token)


def payload_of(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return HEAD.pack(doc_id is None, width, doc_id or 0) + ids


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    is_null, width, doc_id = HEAD.unpack_from(payload)
    return None if is_null else doc_id, np.frombuffer(payload, dtype=f"<u{width}", offset=HEAD.size).astype("<u4")


def read_records(stream) -> Iterator[bytes]:
    """Payloads of a data file, in order, with both checks."""
    while head := stream.read(12):
        (n,), (check,) = LENGTH.unpack_from(head), CHECK.unpack_from(head, 8)
        if masked_crc(head[:8]) != check:
            raise ValueError("damaged record length")
        body = stream.read(n + 4)
        if len(body) != n + 4 or masked_crc(body[:n]) != CHECK.unpack_from(body, n)[0]:
            raise ValueError("damaged record")
        yield body[:n]


def index_path(path: str) -> str:
    return path.removesuffix(".rec") + ".idx"


def open_file(uri: str):
    """(file system, path) of a URI."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def read_record(uri: str, i: int) -> tuple[int | None, np.ndarray, int]:
    """Record ``i`` of a file by its index: doc_id, ids, first token."""
    fs, path = open_file(uri)
    with fs.open_input_file(index_path(path)) as f:
        offset, n, start = ENTRY.unpack(f.read_at(ENTRY.size, i * ENTRY.size))
    with fs.open_input_file(path) as f:
        import io
        payload = next(read_records(io.BytesIO(f.read_at(n + 16, offset))))
    return *parse(payload), start


@lru_cache(maxsize=None)  # at most one entry for each character
def ends_word(c: str) -> bool:
    """Whether a word that ends in ``c`` still ends in a letter or a digit
    once the tokenizer has normalized it."""
    return c.isalnum() and unicodedata.normalize("NFC", c).lower().isalnum()


class Pieces:
    """A tokenizer with the ids of the pieces it has met, of one Python worker."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()
                        if t.special and not (t.normalized or t.single_word)}
        # without a special token every piece goes alone
        self.holds_special = re.compile("|".join(map(re.escape, self.special))).search
        self.known: dict[str, bytes] = {}

    def learn(self, pieces: list[str]) -> None:
        """Encode new pieces into the cache.  Blocks of them go through the
        tokenizer as one text with a special token between them; pieces that
        hold a special token themselves go alone."""
        dtype = f"<u{self.width}"
        for lo in range(0, len(pieces), 4096):
            block = pieces[lo:lo + 4096]
            alone = list(filter(self.holds_special, block))
            plain = list(filterfalse(self.holds_special, block))
            if plain:
                (between, mark), = list(self.special.items())[:1]
                ids = np.array(self.tokenizer.encode_batch_fast([between.join(plain)], add_special_tokens=False)[0].ids,
                               dtype=dtype)
                marks = np.flatnonzero(ids == mark)
                data = ids.tobytes()
                starts = np.concatenate(([0], marks + 1)) * self.width
                stops = np.concatenate((marks, [len(ids)])) * self.width
                self.known.update(zip(plain, map(data.__getitem__, map(slice, starts.tolist(), stops.tolist()))))
            for p, e in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)):
                self.known[p] = np.array(e.ids, dtype=dtype).tobytes()

    def encode(self, texts: pa.Array) -> list[bytes]:
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        return encode_pieces(texts, self.ids_of, self.width)

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        known = self.known
        fresh = [p for p in pieces if p not in known]
        # a word and the marks behind it are encoded apart, so "end", "end." and "end," share the word
        marked = [(p, w, p[len(w):]) for p in fresh
                  if p[-1:] in MARK_SET and (w := p.rstrip(MARKS)) and ends_word(w[-1])]
        parts = set(fresh)
        parts.difference_update([p for p, _, _ in marked])
        for _, word, marks in marked:
            parts.add(word)
            parts.add(marks)
        parts.difference_update(known.keys() & parts)
        self.learn(list(parts))
        known.update([(p, known[word] + known[marks]) for p, word, marks in marked])
        return list(map(known.__getitem__, pieces))


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Pieces:
    return Pieces(path)


#: Characters of a text that help to tell ranges apart.
RANGE_CHARS = 16


def write_records(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write all documents; returns the manifest: part, path, records, tokens,
    bytes, first_token (ids of all files before), one row per file.  ``docs``
    needs doc_id and text."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "llm-records")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        fs = None
        records = tokens = offset = 0
        for b in slices(batches, "text"):
            pieces = tokenizer(tokenizer_path)
            end = end_id.to_bytes(pieces.width, "little")
            if fs is None:
                part = TaskContext.get().partitionId()
                uri = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.rec"
                fs, path = open_file(uri)
                fs.create_dir(path.rpartition("/")[0], recursive=True)
                data, index = fs.open_output_stream(path), fs.open_output_stream(index_path(path))
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), pieces.encode(b.column("text"))):
                payload = payload_of(doc_id, ids + end, pieces.width)
                data.write(record := frame(payload))
                index.write(index_entry(offset, len(payload), tokens))
                records, tokens, offset = records + 1, tokens + len(ids) // pieces.width + 1, offset + len(record)
        if fs is not None:
            data.close()
            index.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "path": uri, "records": records, "tokens": tokens, "bytes": offset}],
                pa.schema([("part", pa.int32()), ("path", pa.string()), ("records", pa.int64()),
                           ("tokens", pa.int64()), ("bytes", pa.int64())]))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # rows without an id, or with the same, are spread over several ranges, and
    # files, by the beginnings of their texts; whole texts order them inside
    by_id = F.col("doc_id").asc_nulls_last()
    ordered = (rows.withColumn("beginning", F.substring("text", 1, RANGE_CHARS))
               .repartitionByRange(by_id, "beginning").drop("beginning").sortWithinPartitions(by_id, "text"))
    manifest = materialize(ordered.mapInArrow(write, MANIFEST), "records-manifest")
    first, placed = 0, []
    for r in manifest.orderBy("part").collect():  # one row per file
        placed.append((*r, first))
        first += r["tokens"]
    return spark.createDataFrame(placed, f"{MANIFEST}, first_token long")


def read_files(manifest: DataFrame) -> DataFrame:
    """All records of the files of a manifest, checked: doc_id, start (ids of
    all documents before it), n_tokens, ids (binary, unsigned 32-bit)."""
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            doc_id, start, n, ids = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(doc_id, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("first_token").to_pylist()):
                fs, name = open_file(path)
                rows, size = [], 0
                with fs.open_input_stream(name, buffer_size=1 << 20) as stream:
                    for payload in read_records(stream):
                        doc_id, ids = parse(payload)
                        rows.append((doc_id, start, len(ids), ids.tobytes()))
                        start += len(ids)
                        size += len(payload)
                        if size >= READ_BYTES:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)

    files = manifest.select("path", "first_token")
    spread = files.repartition(max(1, manifest.count()), "path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def write_and_read(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    return read_files(write_records(docs, tokenizer_path)).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
