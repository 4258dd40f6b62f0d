"""What the operators of this package share: written intermediate tables, sizes, Arrow text buffers."""

from __future__ import annotations

import ctypes
import gc
import threading
import time
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from grainmill.sources.store import discard, new_path, shared_dir, written

__all__ = ["discard", "few", "lean", "mix64", "new_path", "parts", "pieces_of", "shared_dir", "slabs", "small", "spread", "trim", "utf8", "written"]

_tidy: list[threading.Thread] = []


def trim() -> None:
    """Give memory back that this process doesn't use."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):  # another C library has no such call
        libc.malloc_trim(0)


def _again() -> None:
    """A worker lives on between tasks, and would keep the most that any took."""
    libc = ctypes.CDLL(None)
    while hasattr(libc, "malloc_trim"):
        time.sleep(1.0)
        libc.malloc_trim(0)


def _start() -> None:
    if not _tidy:
        pa.set_memory_pool(pa.system_memory_pool())
        _tidy.append(threading.Thread(target=_again, daemon=True))
        _tidy[0].start()


def lean(f: Callable) -> Callable:
    """f for workers, which then give memory back that they don't use."""
    if f.__code__.co_flags & 0x20:  # a generator function

        @wraps(f)
        def scan(batches: Iterator) -> Iterator:
            _start()
            yield from f(batches)

        return scan

    if f.__code__.co_argcount == 3:

        @wraps(f)
        def both(key, left, right):
            _start()
            return f(key, left, right)

        return both

    @wraps(f)
    def group(rows):
        _start()
        return f(rows)

    return group


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces_of(df: DataFrame) -> int:
    """How many tasks a job over df should have: its scan's splits, and no fewer than a shuffle's."""
    return max(parts(df.sparkSession), df.rdd.getNumPartitions())


def few(df: DataFrame) -> DataFrame:
    """df in fewer partitions, for tables that are small next to the rows they sum up."""
    return df.coalesce(max(1, parts(df.sparkSession) // 16))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column, nulls as empty texts; row i is bytes[offsets[i]:offsets[i + 1]]."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def slabs(offsets: np.ndarray, most: int):
    """Row ranges (from, to) that hold at most `most` bytes each, or one row that holds more."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def spread(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places at[i] .. at[i] + size[i] of all i in a row."""
    ends = np.cumsum(size)
    return np.repeat(at - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def small(df: DataFrame, rows: int) -> DataFrame:
    """df marked for broadcast if it is proven to hold at most `rows` rows; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
