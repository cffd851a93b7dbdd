"""Shared helpers: tables, stored intermediate results, Arrow text buffers, rolling hashes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import shared_folder

#: Bytes of text that a worker holds as numpy arrays at a time.
CHUNK_BYTES = 1 << 20
#: Bytes of text of a batch that a worker turns into Python or numpy objects at a time.
PIECE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder."""
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def sheltered(docs: DataFrame, *own: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with columns other than ``own`` under names that clash with nothing and need no
    quotes, and a function that gives a result its columns back."""
    names = [c if c in own else f"__column{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), lambda out: out.select(*names).toDF(*docs.columns)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage and
    survives the loss of executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings of an Arrow column laid end to end, and their n + 1 offsets.
    Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def row_chunks(off: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes each; a longer row stands alone."""
    n, a = len(off) - 1, 0
    while a < n:
        b = int(np.searchsorted(off, off[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def pieces(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into slices of about ``PIECE_BYTES`` bytes of text, so that what a
    worker makes of them stays small whatever the size of Spark's batches. Arrow's memory comes
    from the system's allocator, which gives large buffers back when they are freed."""
    pa.set_memory_pool(pa.system_memory_pool())
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
        for a, b in row_chunks(np.concatenate([[0], np.cumsum(size, dtype=np.int64)]), PIECE_BYTES):
            yield batch.slice(a, b - a)


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


class RollingHash:
    """Polynomial hashes modulo 2**64 of any substrings of a buffer, from prefix sums."""

    #: An odd 64-bit multiplier for each of two independent hashes.
    BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

    def __init__(self, size: int, which: int = 0):
        self.base = self.BASES[which]
        self.size = 0
        self._grow(size)

    def _grow(self, size: int) -> None:
        with np.errstate(over="ignore"):
            ones = np.full(size, self.base, np.uint64)
            ones[:1] = 1
            self.power = np.multiply.accumulate(ones)
            ones = np.full(size, _inverse(self.base), np.uint64)
            ones[:1] = 1
            self.inverse = np.multiply.accumulate(ones)
        self.size = size

    def prefix(self, buf: np.ndarray) -> np.ndarray:
        if len(buf) + 1 > self.size:
            self._grow(len(buf) + 1)
        out = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * self.power[:len(buf)], out=out[1:])
        return out

    def of(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (prefix[end] - prefix[start]) * self.inverse[start]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
