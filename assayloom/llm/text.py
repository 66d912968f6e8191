"""Shared steps of the text operators: slices, words, folds, fixed-width lists."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one step inside a task works on at once.
SLICE_BYTES = 8 << 20
#: Rows that a Python worker gets at once.
BATCH_ROWS = 2000


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of ``column``, or one row."""
    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size + 16)
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The texts of a batch, null as empty."""
    return pc.fill_null(batch[column], "")


def words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(offsets, words): text i has words[offsets[i]:offsets[i + 1]], cut at ASCII white space."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    keep = pc.greater(pc.binary_length(flat), 0)
    found = np.concatenate(([0], np.cumsum(keep.to_numpy(zero_copy_only=False), dtype=np.int64)))
    return found[lists.offsets.to_numpy()], flat.filter(keep)


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets, codes, distinct words): as ``words``, each word as its place among the distinct ones."""
    offsets, flat = words(texts)
    encoded = flat.dictionary_encode()
    return offsets, encoded.indices.to_numpy(), encoded.dictionary


def hashes(distinct: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hashes of strings."""
    values = distinct.to_pylist()
    return np.fromiter((xxhash.xxh3_64_intdigest(v, seed) for v in values), np.uint64, len(values))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each run values[offsets[i]:offsets[i + 1]], 0 for an empty one."""
    total = np.concatenate((np.zeros((1,) + values.shape[1:], values.dtype), np.cumsum(values, axis=0)))
    return total[offsets[1:]] - total[offsets[:-1]]


def tidied(step):
    """``step`` over Arrow batches, which gives its task's memory back at the end: workers go on to other tasks."""
    def run(batches):
        try:
            yield from step(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # a C library without it keeps its free memory
                pass
    return run


def binaries(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def width(df: DataFrame) -> int:
    """Shuffle width of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def bounded_batches(spark: SparkSession) -> None:
    """Have Spark pass texts to Python in batches of ``BATCH_ROWS`` rows at most.

    By default 10,000 texts go at once, in buffers outside the heap, one set per
    task. A session that asks for less keeps its own limit.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def clear_of(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, in bounded batches: an operator's own names cannot clash with others'."""
    bounded_batches(df.sparkSession)
    return df.select(*[F.col(f"`{c}`") for c in columns])
