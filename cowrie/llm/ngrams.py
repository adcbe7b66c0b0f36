"""Hashed character n-grams of whole texts, vectorised."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MIX = np.uint64(0x9E3779B97F4A7C15)
SLICE = 256


def buckets(text: str, low: int, high: int, bits: int) -> np.ndarray:
    """Buckets, below ``2**bits``, of all n-grams of ``low`` to ``high`` characters.

    The text is lower-cased, each run of white space becomes one space, and one space
    stands before and after it, so n-grams know where words begin.  Null and empty
    texts have none.
    """
    spaced = " ".join(text.lower().split()) if text else ""
    if not spaced:
        return np.empty(0, np.int64)
    codes = np.frombuffer(f" {spaced} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    codes = (codes + np.uint64(1)) * _MIX
    found = []
    rolled = codes
    shift = np.uint64(64 - bits)
    for n in range(1, min(high, len(codes)) + 1):
        if n > 1:
            rolled = rolled[:-1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        if n >= low:
            mixed = (rolled ^ (rolled >> np.uint64(31))) * _MIX
            found.append((mixed >> shift).astype(np.int64))
    return np.concatenate(found) if found else np.empty(0, np.int64)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """Columns of a few rows at a time as Python lists."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE).to_pydict()
