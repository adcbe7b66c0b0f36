"""Token ids of a corpus as files of Simple-8b blocks.

A token file is a folder with two Parquet tables, written by Spark's own committers so
that lost tasks leave nothing behind:

* ``blocks``: ``part, block, before, n_ids, words, escaped, doc_ids, lengths``.  A block
  holds whole documents, ``BLOCK_IDS`` ids or the one document that has more; ``before``
  counts the ids of its part before it, ``words`` and ``escaped`` are the coded ids.
* ``parts``: ``part, start``: the ids of all parts before it.

Parts follow each other in ascending order of ``doc_id``, and so do documents inside.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cowrie.llm import simple8b
from cowrie.llm.slices import bounded
from cowrie.llm.tokens import encoder

BLOCK_IDS = 32_768

_BLOCK = (
    "part int, block long, before long, n_ids long, words binary, escaped binary, "
    "doc_ids array<long>, lengths array<long>"
)
_BLOCK_ARROW = pa.schema([
    ("part", pa.int32()), ("block", pa.int64()), ("before", pa.int64()), ("n_ids", pa.int64()),
    ("words", pa.binary()), ("escaped", pa.binary()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
])


def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Slices of (doc_id, text) as Python lists; a null text is the empty one."""
    for part in bounded(batches, "text"):
        texts = part.column("text").to_pylist()
        yield part.column("doc_id").to_pylist(), [t or "" for t in texts]


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Encodes ``docs (doc_id, text)``, ends each document with ``end_id``, writes a file.

    Null texts are empty documents of the end id alone; other columns are ignored;
    repeated ids stay, ordered by their texts; a null id comes first; an empty table
    gives a file without blocks.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, np.array([end_id], "<u4").tobytes()
        part, block, before = TaskContext.get().partitionId(), 0, 0
        ids: list[bytes] = []
        held: list[tuple[int, int]] = []
        size = 0

        def close() -> pa.RecordBatch:
            values = np.frombuffer(b"".join(ids), "<u4")
            words, escaped = simple8b.encode(values)
            row = {
                "part": part, "block": block, "before": before, "n_ids": len(values),
                "words": words.astype("<u8").tobytes(), "escaped": escaped.astype("<u8").tobytes(),
                "doc_ids": [d for d, _ in held], "lengths": [n for _, n in held],
            }
            return pa.RecordBatch.from_pylist([row], _BLOCK_ARROW)

        for doc_ids, texts in texts_of(batches):
            for doc_id, text in zip(doc_ids, texts):
                code = encode(text) + end
                ids.append(code)
                held.append((doc_id, len(code) // 4))
                size += len(code) // 4
                if size >= BLOCK_IDS:
                    yield close()
                    block, before, size = block + 1, before + size, 0
                    ids.clear()
                    held.clear()
        if held:
            yield close()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(blocks, _BLOCK).write.parquet(f"{path}/blocks")
    totals = docs.sparkSession.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("ids"))
    # one row for each part, so this window is as small as the list of files
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("start"))
    starts.coalesce(1).write.parquet(f"{path}/parts")


def read(spark: SparkSession, path: str, digests: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens`` and ``ids`` of every document of a token file.

    With ``digests`` the unsigned crc32 of the ids, as little-endian unsigned 32-bit
    integers, comes as ``ids_crc32`` in place of the ids.
    """
    last = ("ids_crc32", pa.int64()) if digests else ("ids", pa.list_(pa.int64()))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), last])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):  # one block as Python objects at a time
                row = batch.slice(at, 1).to_pylist()[0]
                escaped = np.frombuffer(row["escaped"], "<u8")
                ids = simple8b.decode(np.frombuffer(row["words"], "<u8"), escaped, row["n_ids"]).astype("<u4")
                ends = np.cumsum(row["lengths"])
                cuts = np.split(ids, ends[:-1])
                found = [zlib.crc32(c.tobytes()) for c in cuts] if digests else [c.astype(np.int64) for c in cuts]
                starts = row["start"] + ends - np.array(row["lengths"])
                columns = [row["doc_ids"], starts, row["lengths"], found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
                )

    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    parts = spark.read.schema("part int, start long").parquet(f"{path}/parts")
    rows = blocks.join(parts, "part").select(
        (F.col("start") + F.col("before")).alias("start"), "n_ids", "words", "escaped", "doc_ids", "lengths"
    )
    kind = "ids_crc32 long" if digests else "ids array<long>"
    return rows.mapInArrow(documents, f"doc_id long, start long, n_tokens long, {kind}")
