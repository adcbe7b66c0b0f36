"""Arrow batches cut into slices whose texts are few and small enough to be Python objects."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

MOST_ROWS, MOST_BYTES = 256, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of this session hold about ``MOST_BYTES``, not 64 MB, on both sides."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(MOST_BYTES))


def release() -> None:
    """Gives freed memory back to the system: Spark's Python workers live on for other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def bounded(batches: Iterator[pa.RecordBatch], *texts: str) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``MOST_ROWS`` rows and ``MOST_BYTES`` of the columns ``texts``, or of one row.

    Order and rows stay; empty batches give nothing.
    """
    try:
        for batch in batches:
            yield from _cut(batch, texts)
    finally:
        release()


def _cut(batch: pa.RecordBatch, texts: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    sizes = np.ones(batch.num_rows, np.int64)
    for name in texts:
        sizes += pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(before, before[at] + MOST_BYTES, "right")) - 1
        end = min(max(end, at + 1), at + MOST_ROWS, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end
