"""Arrow batches in parts of bounded size, as byte arrays."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

SLICE_BYTES = 2 << 20
ARROW_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session's Python stages, which the JVM and the worker both hold, to
    ``ARROW_BYTES`` (Spark's own bound is 64 MB); a smaller setting stays."""
    plain = re.fullmatch(r"(\d+)b?", spark.conf.get(_BATCH, None) or "")
    now = int(plain[1]) if plain else 0
    if not 0 < now <= ARROW_BYTES:
        spark.conf.set(_BATCH, str(ARROW_BYTES))



def slices(batch: pa.RecordBatch, text: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes of text each; a longer text is a part of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    begin = 0
    while begin < len(lengths):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + size, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and their offsets; null is empty."""
    column = pc.fill_null(column.cast(pa.binary()), b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def release() -> None:
    """Give freed memory back to the system: a Python worker stays alive after its task, beside the next ones."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function over batches, which releases memory when its task ends."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return wrapped
