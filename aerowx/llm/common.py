"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerowx.session import scratch_path

#: Arrow batches are regrouped to about this many text bytes, so that the
#: memory of a task does not depend on how long the documents are.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read by Spark (any store Spark reaches)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, written: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage, survives lost executors, and lets several
    consumers read one computation.  The folder is added to ``written``, for
    ``discard`` once nothing reads it any more."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    if written is not None:
        written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, written: list[str]) -> None:
    """Remove folders that ``materialize`` wrote, in whatever store they are."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while written:
        path = spark._jvm.org.apache.hadoop.fs.Path(written.pop())
        path.getFileSystem(conf).delete(path, True)


def text_or_empty(col: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where it stands in the
    function of a transform, which would compute it for every entry."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


PREFIX_BLOCK = 256


def prefixes(numbers: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each entry of an int array, 0 and the entries before it joined (by a
    sum or the greatest).  That is done in blocks, and over the blocks' results
    then: appending to one array would copy it for every entry."""
    none = F.array().cast("array<int>")
    empty = F.struct(F.lit(0).alias("at"), none.alias("seen"))
    add = lambda d, n: F.struct(join(d["at"], n).alias("at"), F.array_append(d["seen"], d["at"]).alias("seen"))

    def whole(numbers: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / PREFIX_BLOCK).cast("int")),
                             lambda b: F.slice(numbers, b * PREFIX_BLOCK + 1, F.lit(PREFIX_BLOCK)))
        inside = F.transform(blocks, lambda b: F.aggregate(b, empty, add))
        before = F.aggregate(inside, empty, lambda d, b: add(d, b["at"]), lambda d: d["seen"])
        return F.flatten(F.zip_with(inside, before, lambda b, n: F.transform(b["seen"], lambda x: join(x, n))))

    return bound(numbers, lambda n: F.when(F.size(n) > 0, whole(n)).otherwise(none))


def prefix_sums(lengths: Column) -> Column:
    """For each entry of an int array the sum of those before it."""
    return prefixes(lengths, lambda a, b: a + b)


def slices(batches: Iterable[pa.RecordBatch], text_col: str,
           max_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of at most about ``max_bytes`` of text (one
    document is never cut)."""
    for b in batches:
        if b.num_rows == 0:
            continue
        col = b.column(b.schema.get_field_index(text_col))
        if b.num_rows == 1 or col.nbytes <= max_bytes:
            yield b
            continue
        lens = pc.binary_length(col).fill_null(0).to_pylist()
        lo = size = 0
        for i, n in enumerate(lens):
            if i > lo and size + n > max_bytes:
                yield b.slice(lo, i - lo)
                lo, size = i, 0
            size += n
        yield b.slice(lo)


def release_memory() -> None:
    """Give freed memory back to the system at a task's end: Python workers
    stay alive between tasks, beside those of other operators."""
    import ctypes
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library can
        ctypes.CDLL(None).malloc_trim(0)


def encode_pieces(texts: pa.Array, ids_of: Callable[[list[str]], list[bytes]], width: int,
                  keep_blank: bool = False) -> list[bytes]:
    """Ids of texts whose pieces between blanks can be encoded each alone.

    Arrow cuts the texts and numbers the distinct pieces, ``ids_of`` encodes
    those, and the ids are dealt back by number.  Without ``keep_blank``, line
    ends count as blanks and blanks are dropped; with it, only spaces cut and
    each goes with the piece that follows.  ``width`` is the bytes of an id.
    """
    cut = pc.split_pattern(texts if keep_blank else pc.replace_substring(texts, "\n", " "), " ")
    pieces = cut.flatten()
    ends = cut.offsets.to_numpy()
    ends = ends - ends[0]
    if keep_blank:  # the first piece of a text has no blank before it
        inner = np.ones(len(pieces), dtype=bool)
        inner[ends[:-1][ends[:-1] < len(pieces)]] = False
        space, nothing = (pa.scalar(x, pieces.type) for x in (" ", ""))
        pieces = pc.binary_join_element_wise(pc.if_else(pa.array(inner), space, nothing), pieces, nothing)
    numbered = pieces.dictionary_encode()
    of_piece = ids_of(numbered.dictionary.to_pylist())
    n = np.fromiter(map(len, of_piece), dtype=np.int64, count=len(of_piece)) // width
    start = np.cumsum(n) - n
    number = numbered.indices.to_numpy()
    size = n[number]
    stop = np.concatenate(([0], np.cumsum(size)))
    ids = np.frombuffer(b"".join(of_piece), dtype=f"<u{width}")
    dealt = ids[np.arange(stop[-1]) + np.repeat(start[number] - stop[:-1], size)]
    at = stop[ends].tolist()
    return [dealt[a:b].tobytes() for a, b in zip(at, at[1:])]
