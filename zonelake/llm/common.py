"""Helpers that several operators share: staged tables, slices of Arrow batches, hashes of words."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.session import scratch_path

#: Bytes of text that are worked on at once inside a task; one longer text is worked on alone.
CHUNK_BYTES = 2 << 20


#: Whether folders are noted for removal, and those that are.
_noting = [False]
_staged: list[str] = []


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    if _noting[0]:
        _staged.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_buckets(df: DataFrame, name: str, key: str, dealt: bool = False) -> DataFrame:
    """As :func:`stage`, dealt into buckets of ``key``, so that joins by it leave these rows where they are.

    ``dealt``: the rows come from a ``repartition`` by this key to as many partitions as shuffles have.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"staged_{path.rpartition('-')[2]}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if _noting[0]:
        _staged.append(path)
    out = (df if dealt else df.repartition(n, key)).write.format("parquet").option("compression", "zstd").option("path", path)
    out.bucketBy(n, key).sortBy(key).saveAsTable(table)
    return spark.table(table)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove what was staged inside the last such block, and note what is staged inside this one.

    For chains that write the result of each block before the next one begins: frames that still read the folders of an
    earlier block fail.  What is staged outside such blocks is not removed.
    """
    release(spark)
    _noting[0] = True
    try:
        yield
    finally:
        _noting[0] = False


def release(spark: SparkSession) -> None:
    """Remove the folders that are noted."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark._jsparkSession.sessionState().newHadoopConf()
    while _staged:
        path = hadoop.Path(_staged.pop())
        path.getFileSystem(conf).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of the frame is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_key(id_column: str, text_column: str):
    """A 64-bit key of a row's text; with the id it tells rows apart that repeat an id with another text."""
    return F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))


def text_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (first is 0) of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of text, or one row."""
    _, offsets = text_of(batch.column(column))
    start = 0
    while start < len(batch):
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), len(batch))
        yield batch.slice(start, stop - start)
        start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every bit of the input reaches every bit of the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def odd_powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)
