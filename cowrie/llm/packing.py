"""Best-fit packing of documents into sequences by exact-complement hashing.

Lengths are whole numbers up to the capacity, so all choices are made on the counts of
the lengths: a table of ``capacity`` numbers, however large the corpus.  The plan it
gives is a short list of patterns (lengths that go together) with how often each is
used.  Spark then ranks the pieces of each length and looks their places up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cowrie.llm.token_files import texts_of
from cowrie.llm.tokens import encoder
from cowrie.session import shared_folder

CAPACITY = 2048
#: Pieces of one length that one task ranks, about.
RANKED_TOGETHER = 200_000


class Complements:
    """Counts of lengths with an index of the lengths, pairs and triples of a given sum."""

    def __init__(self, counts: np.ndarray) -> None:
        self.counts = counts

    def single(self, gap: int) -> tuple[int, ...] | None:
        return (gap,) if self.counts[gap] else None

    def pair(self, gap: int, most: int | None = None) -> tuple[int, ...] | None:
        """Two available lengths of sum ``gap``, the larger as large as may be."""
        high = min(gap - 1, most or gap - 1)
        low = -(-gap // 2)
        if high < low:
            return None
        there = self.counts[low : high + 1] > 0
        there &= self.counts[gap - high : gap - low + 1][::-1] > 0
        if gap % 2 == 0 and self.counts[low] < 2:
            there[0] = False
        found = np.flatnonzero(there)
        return (low + int(found[-1]), gap - low - int(found[-1])) if len(found) else None

    def triple(self, gap: int) -> tuple[int, ...] | None:
        """Three available lengths of sum ``gap``, in descending order."""
        for first in (np.flatnonzero(self.counts[-(-gap // 3) : gap - 1]) + -(-gap // 3))[::-1].tolist():
            self.counts[first] -= 1
            rest = self.pair(gap - first, first)
            self.counts[first] += 1
            if rest:
                return (first, *rest)
        return None

    def find(self, gap: int) -> tuple[int, ...] | None:
        return self.single(gap) or self.pair(gap) or self.triple(gap) if gap > 0 else None

    def times(self, lengths: tuple[int, ...]) -> int:
        """How often the lengths can be taken together."""
        return min(int(self.counts[x]) // lengths.count(x) for x in lengths)

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for x in lengths:
            self.counts[x] -= times


def plan(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with their multiplicities for ``counts[length]`` pieces.

    From the longest length down, gaps that one, two or three available lengths fill
    exactly are filled so, as often as the counts allow.  What has no exact complement
    goes, longest first, into the open sequence with the least sufficient room.
    """
    capacity = len(counts) - 1
    index = Complements(counts.astype(np.int64).copy())
    patterns: list[tuple[tuple[int, ...], int]] = []
    rest: list[tuple[int, int]] = []
    for length in range(capacity, 0, -1):
        while left := int(index.counts[length]):
            if length == capacity:
                index.take((length,), left)
                patterns.append(((length,), left))
                break
            index.counts[length] -= 1
            others = index.find(capacity - length)
            index.counts[length] += 1
            if not others:
                index.take((length,), left)
                rest.append((length, left))
                break
            together = (length, *others)
            times = index.times(together)
            index.take(together, times)
            patterns.append((together, times))
    rooms: dict[int, list[list]] = {}  # room: open patterns [lengths, multiplicity]
    for length, left in rest:
        while left:
            room = min((r for r in rooms if r >= length), default=None)
            if room is None:
                fit = capacity // length
                whole, extra = divmod(left, fit)
                for per, times in ((fit, whole), (extra, 1)):
                    if per and times:
                        rooms.setdefault(capacity - per * length, []).append([(length,) * per, times])
                break
            lengths, times = rooms[room].pop()
            used = min(times, left)
            if times > used:
                rooms[room].append([lengths, times - used])
            if not rooms[room]:
                del rooms[room]
            rooms.setdefault(room - length, []).append([(*lengths, length), used])
            left -= used
    patterns += [(tuple(lengths), times) for opened in rooms.values() for lengths, times in opened]
    return patterns


@dataclass(frozen=True)
class Places:
    """Runs of ranks: pieces ``first..`` of a length lie at ``offset`` of sequences from ``sequence``."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, patterns: list[tuple[tuple[int, ...], int]]) -> Places:
        used: dict[int, int] = {}
        runs, sequence = [], 0
        for lengths, times in patterns:
            offset = 0
            for length in lengths:
                runs.append((length, used.get(length, 0), sequence, offset))
                used[length] = used.get(length, 0) + times
                offset += length
            sequence += times
        table = np.array(sorted(runs), np.int64).reshape(-1, 4)
        return cls(*table.T)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.searchsorted(self.length, length, "right")
        begin = np.searchsorted(self.length, length, "left")
        for _ in range(int(np.log2(max(1, len(self.length)))) + 1):  # last run that begins at or before the rank
            middle = (begin + run) // 2
            right = self.first[np.minimum(middle, len(self.first) - 1)] <= rank
            begin, run = np.where(right, middle, begin), np.where(right, run, middle)
        return self.sequence[begin] + rank - self.first[begin], self.offset[begin]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, ids`` of whole ``docs (doc_id, text)``.

    A document is the ids of its text and ``end_id``; null and empty texts are the end
    id alone.  Only longer ones than ``capacity`` are cut.  ``ids`` are little-endian
    unsigned 32-bit integers; Spark drops them unread where nobody asks for them.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
        ("ids_crc32", pa.int64()), ("ids", pa.binary()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, step = encoder(tokenizer).encode, np.array([end_id], "<u4").tobytes(), 4 * capacity
        for doc_ids, texts in texts_of(batches):
            rows = []
            for doc_id, text in zip(doc_ids, texts):
                code = encode(text) + end
                for piece, at in enumerate(range(0, len(code), step)):
                    part = code[at : at + step]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
            )

    return docs.select("doc_id", "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    )


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to written ``rows (doc_id, piece, length, …)``.

    Lengths are 1 to ``capacity``.  Sequences are numbered from 0 and filled from offset 0
    without gaps.  Pieces of one length are dealt in the order of a hash, ties by the
    whole row.  Empty tables give empty results.
    """
    salts = 1 + rows.count() // RANKED_TOGETHER
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    counted = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    based = counted.select(
        "length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    # at most ``capacity`` rows, whatever the input
    histogram = counted.groupBy("length").agg(F.sum("_n").alias("n")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in histogram:
        if not 1 <= (row["length"] or 0) <= capacity:
            raise ValueError(f"a piece of length {row['length']} doesn't fit {capacity}")
        counts[row["length"]] = row["n"]
    places = Places.of(plan(counts))
    order = [F.col(c) for c in rows.columns if c not in ("length", "ids")]
    within = Window.partitionBy("length", "_salt").orderBy(*order)
    ranked = (
        salted.withColumn("_rank", F.row_number().over(within) - 1)
        .join(based, ["length", "_salt"])
        .withColumn("_rank", F.col("_rank") + F.col("_base"))
        .drop("_salt", "_base")
    )
    kept = [c for c in rows.columns]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sequence, offset = places.find(
                batch.column("length").to_numpy().astype(np.int64), batch.column("_rank").to_numpy().astype(np.int64)
            )
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*kept, "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, ids: bool = False) -> DataFrame:
    """The pieces of whole ``docs`` with their places; with ``ids`` also their tokens.

    Encoded once: the pieces are written to the shared folder and read from there.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "pieces")
    cut = pieces(docs, tokenizer, capacity, end_id)
    (cut if ids else cut.drop("ids")).write.parquet(folder)
    return pack(spark.read.schema((cut if ids else cut.drop("ids")).schema).parquet(folder), capacity)
