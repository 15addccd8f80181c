"""Arrow and numpy helpers shared by the text operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Bytes of text that one vectorised step works on; memory per task is a small multiple of it.
STEP_BYTES = 1 << 19

#: Rows of an Arrow batch between Spark and Python; Spark's own 10,000 long texts would be a lot for a task.
BATCH_ROWS = 1000


def bounded(df: DataFrame) -> DataFrame:
    """df, after holding its session's Arrow batches to BATCH_ROWS rows; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def steps(batches, column: str = "text", size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about size bytes of column, or a single row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def give_back() -> None:
    """Return memory that Arrow and the C library hold for reuse; a Python worker lives longer than its task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """run, a function of mapInArrow, with a give_back() once its last batch is out and what it held is freed."""

    @wraps(run)
    def tidied(batches):
        yield from run(batches)
        give_back()

    return tidied


def plain(texts: pa.Array) -> pa.Array:
    """Texts with null as the empty string, with 64-bit offsets from 0 (some kernels misread others)."""
    return recoded(pc.fill_null(texts.cast(pa.large_string()), ""))


def recoded(texts: pa.Array, table: np.ndarray | None = None) -> pa.Array:
    """texts in buffers of their own, each byte replaced by its entry in table."""
    data, offsets = utf8(texts)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(data if table is None else table[data]))


#: Byte table that puts A-Z in lower case and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the offset of each text (one more than texts)."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=texts.offset + len(texts) + 1)[texts.offset :]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]


def cut_binary(data: bytes, ends: np.ndarray) -> pa.Array:
    """data cut at ends (ascending, the last one its length) as a binary array, without a copy."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values within each [offsets[i], offsets[i + 1])."""
    total = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words (runs of anything but ASCII white space) of all texts in a row, and offsets by text."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    kept = pc.greater(pc.binary_length(flat), 0)
    if not pc.all(kept, min_count=0).as_py():
        flags = kept.to_numpy(zero_copy_only=False)
        total = np.concatenate([[0], np.cumsum(flags)]).astype(np.int64)
        offsets = total[offsets]
        flat = flat.filter(kept)
    return flat, offsets
