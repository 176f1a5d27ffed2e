"""The learning table as Parquet chunks.

The reference writes 20 random 5 % splits with 20 separate jobs.  Here the
chunk number is a seeded hash of the row's trip columns, and one job writes
every chunk as a ``chunk=<i>`` partition; readers can prune chunks by
partition filter.

A write goes to a folder of its own, ``data-<id>``, and only when it is complete
does the small file ``_current`` name that folder, in one rename.  Readers follow
it, so a write that fails half-way leaves the chunks before it as they were.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerowx.session import remove

CURRENT = "_current"
DATA = "data-"
N_CHUNKS = 20
KEY_COLUMNS = ("ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "CRS_DEP_TIMESTAMP",
               "SCHEDULED_ARRIVAL_TIMESTAMP", "Class")


def chunk_id(n: int = N_CHUNKS, seed: int = 42, cols=KEY_COLUMNS):
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), F.lit(n)).cast("int")


def with_chunks(df: DataFrame, n: int = N_CHUNKS, seed: int = 42) -> DataFrame:
    return df.withColumn("chunk", chunk_id(n, seed))


def write_chunks(df: DataFrame, path: str, n: int = N_CHUNKS, seed: int = 42,
                 rebalance: bool = False) -> None:
    """One job: ``chunk`` column + ``partitionBy("chunk")``.

    There is no shuffle; each task sorts its own rows by chunk and writes at
    most ``n`` files.  A wide row takes several times its Parquet bytes in a
    shuffle, whose files lie on disk beside those of the joins before it until
    the chunks are written.  ``rebalance`` adds the ``REBALANCE(chunk)`` hint:
    one shuffle of the output, after which AQE splits each chunk (1/n of all
    rows) into advisory-sized tasks and coalesces small ones, for fewer and
    larger files.  (A plain ``repartition("chunk")`` would put 1/n of all rows
    in one task.)

    Chunks that ``path`` held are replaced once the new ones are complete;
    then, and not before, the old files go."""
    out = with_chunks(df, n, seed)
    if rebalance:
        out = out.hint("rebalance", "chunk")
    data = f"{DATA}{uuid.uuid4().hex[:12]}"
    out.write.partitionBy("chunk").parquet(f"{path}/{data}")
    _publish(df.sparkSession, path, data)


def _files(spark: SparkSession, path: str):
    """(file context, path class) of the store that ``path`` is in."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    store = where.getFileSystem(conf)
    return store, jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), conf), jvm.org.apache.hadoop.fs.Path


def _publish(spark: SparkSession, path: str, data: str) -> None:
    """Point ``_current`` to the new folder, then remove what was before it."""
    store, context, Path = _files(spark, path)
    draft = Path(f"{path}/{CURRENT}-{data}")
    with_name = store.create(draft, True)
    with_name.write(bytearray(data.encode()))
    with_name.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(draft, store.makeQualified(Path(f"{path}/{CURRENT}")), how)
    for entry in store.listStatus(Path(path)):
        name = entry.getPath().getName()
        if name != data and (name.startswith((DATA, "chunk=", f"{CURRENT}-")) or name == "_SUCCESS"):
            remove(spark, f"{path}/{name}")


def current(spark: SparkSession, path: str) -> str:
    """The folder that holds the chunks: the one ``_current`` names, or
    ``path`` itself if it has no such file (written by other means)."""
    store, _, Path = _files(spark, path)
    named = Path(f"{path}/{CURRENT}")
    if not store.exists(named):
        return path
    reader = store.open(named)
    size = store.getFileStatus(named).getLen()
    data = bytes(reader.readNBytes(int(size))).decode()
    reader.close()
    return f"{path}/{data}"


def read_chunks(spark: SparkSession, path: str, chunks: list[int] | None = None) -> DataFrame:
    """All chunks (or the listed ones, pruned at planning time)."""
    df = spark.read.parquet(current(spark, path))
    if chunks is not None:
        df = df.where(F.col("chunk").isin(list(chunks)))
    return df.drop("chunk")


def chunk_dirs(spark: SparkSession, path: str) -> list[str]:
    """The chunk folders that a written table has (a chunk without rows has
    none); at most ``n`` numbers reach the driver."""
    path = current(spark, path)
    found = spark.read.parquet(path).select("chunk").distinct().collect()
    return [f"{path}/chunk={r.chunk}" for r in sorted(found)]


def read_chunk_dirs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Union of separately written chunk directories (reference layout)."""
    return reduce(DataFrame.unionByName, [spark.read.parquet(p) for p in paths])
