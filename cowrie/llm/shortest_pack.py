"""Packing by shortest pack first over the histogram of lengths.

A document is cut into whole sequences of ``capacity`` tokens and a shorter remainder.  The
remainders are packed on the counts of their lengths alone, at most ``capacity`` numbers
however large the corpus:

1. Lengths are placed longest first, each into the shortest pack, that is the one with most
   room.  Packs of one pattern (the same lengths in the same order) are one entry with a
   count, so placing a length changes counts of patterns, not packs.
2. Documents may be cut anywhere, so gaps of ``LEAST`` tokens and more are closed: the
   shortest packs are taken apart, as many as the gaps need, and fill the others, whole where
   they fit and cut where not.  What is left in the end, less than one sequence, becomes
   sequences of a power of two, which need no padding.  Smaller gaps stay padding: closing
   them would cut documents into crumbs.

Spark then ranks the remainders of each length and looks the ranks up in the patterns.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cowrie.llm.slices import bounded
from cowrie.llm.tokens import encoder
from cowrie.session import shared_folder

CAPACITY = 1024
#: Gaps below this stay open; at most ``LEAST - 1`` of ``CAPACITY`` tokens are padding.
LEAST = 32
#: Remainders of one length that one task ranks together, about.
RANKED_TOGETHER = 1000
#: Rows that one task of the first step can number.
_NUMBERS = 33


@dataclass(frozen=True)
class Part:
    """``length`` tokens from ``start`` of a remainder of ``whole`` tokens; in the n-th copy that of rank ``rank + n``."""

    whole: int
    rank: int
    start: int
    length: int

    def after(self, copies: int) -> Part:
        return Part(self.whole, self.rank + copies, self.start, self.length)

    def cut(self, at: int) -> tuple[Part, Part]:
        return Part(self.whole, self.rank, self.start, at), Part(self.whole, self.rank, self.start + at, self.length - at)


@dataclass(frozen=True)
class Pattern:
    """Parts that lie one after another in each of ``times`` sequences."""

    parts: tuple[Part, ...]
    times: int

    @property
    def total(self) -> int:
        return sum(p.length for p in self.parts)

    def split(self, copies: int) -> tuple[Pattern, Pattern | None]:
        """The first ``copies`` of it, and the others if there are any."""
        first = Pattern(self.parts, copies)
        left = self.times - copies
        return first, Pattern(tuple(p.after(copies) for p in self.parts), left) if left else None


class _ByLength:
    """Entries with a count, under whole numbers, with the least and the greatest at hand."""

    def __init__(self, most: int) -> None:
        self.entries: list[list] = [[] for _ in range(most + 1)]
        self.there = np.zeros(most + 1, bool)

    def put(self, at: int, entry) -> None:
        self.entries[at].append(entry)
        self.there[at] = True

    def pop(self, at: int):
        entry = self.entries[at].pop()
        self.there[at] = bool(self.entries[at])
        return entry

    def least(self) -> int | None:
        found = np.flatnonzero(self.there)
        return int(found[0]) if len(found) else None

    def greatest(self, most: int | None = None) -> int | None:
        found = np.flatnonzero(self.there if most is None else self.there[: most + 1])
        return int(found[-1]) if len(found) else None


def shortest_first(counts: np.ndarray) -> list[Pattern]:
    """Packs of whole remainders, ``counts[length]`` of each: longest first, into the shortest pack."""
    capacity = len(counts) - 1
    packs = _ByLength(capacity)
    for length in range(capacity, 0, -1):
        rank, left = 0, int(counts[length])
        while left:
            total = packs.least()
            if total is None or total + length > capacity:
                # no pack has room: new ones, each the shortest until it is full
                for each, times in ((capacity // length, left // (capacity // length)), (left % (capacity // length), 1)):
                    if each and times:
                        parts = tuple(Part(length, rank + k * times, 0, length) for k in range(each))
                        packs.put(each * length, Pattern(parts, times))
                        rank += each * times
                break
            pattern = packs.pop(total)
            used, others = pattern.split(min(left, pattern.times))
            if others:
                packs.put(total, others)
            packs.put(total + length, Pattern((*used.parts, Part(length, rank, 0, length)), used.times))
            rank, left = rank + used.times, left - used.times
    return [pattern for entries in packs.entries for pattern in entries]


def _open(total: int, capacity: int, least: int) -> bool:
    return capacity - total >= least and total & (total - 1) != 0


def closed(patterns: Iterable[Pattern], capacity: int, least: int = LEAST) -> list[Pattern]:
    """The same tokens in packs with gaps below ``least`` or, where shorter, of a power of two."""
    done: list[Pattern] = []
    packs, spare = _ByLength(capacity), _ByLength(capacity)
    for pattern in patterns:
        if _open(pattern.total, capacity, least):
            packs.put(pattern.total, pattern)
        else:
            done.append(pattern)
    while (total := packs.greatest()) is not None:
        pattern, gap = packs.pop(total), capacity - total
        length = spare.greatest(gap) or spare.greatest()
        if length is None:
            # the shortest packs are taken apart, as many as this gap needs
            shortest = packs.least()
            donor = pattern if shortest is None else packs.pop(shortest)
            wanted = -(-pattern.times * gap // (capacity if shortest is None else shortest))
            taken, left = donor.split(min(wanted, donor.times))
            if shortest is None:
                pattern = left
            elif left:
                packs.put(shortest, left)
            for part in taken.parts:
                spare.put(part.length, (part, taken.times))
            if pattern:
                packs.put(total, pattern)
            continue
        part, there = spare.pop(length)
        used, others = pattern.split(min(there, pattern.times))
        if others:
            packs.put(total, others)
        if there > used.times:
            spare.put(length, (part.after(used.times), there - used.times))
        if length > gap:
            part, rest = part.cut(gap)
            spare.put(rest.length, (rest, used.times))
        grown = Pattern((*used.parts, part), used.times)
        if _open(total + part.length, capacity, least):
            packs.put(total + part.length, grown)
        else:
            done.append(grown)
    return done + _powers(spare, capacity)


def _powers(spare: _ByLength, capacity: int) -> list[Pattern]:
    """What is left, one part after another, in full sequences and then sequences of powers of two."""
    done: list[Pattern] = []
    total = sum(part.length * times for entries in spare.entries for part, times in entries)
    sizes = [capacity] * (total // capacity)
    sizes += [1 << bit for bit in range(total.bit_length() - 1, -1, -1) if total % capacity >> bit & 1]
    held: list[Part] = []
    room = sizes.pop(0) if sizes else 0
    for entries in reversed(spare.entries):
        for part, times in entries:
            for copy in range(times):
                rest = part.after(copy)
                while rest.length:
                    now, rest = rest.cut(min(room, rest.length))
                    held.append(now)
                    room -= now.length
                    if not room:
                        done.append(Pattern(tuple(held), 1))
                        held, room = [], sizes.pop(0) if sizes else 0
    return done


@dataclass(frozen=True)
class Places:
    """Where the parts of each remainder lie, found by its length, the part's start and its rank.

    One row for each part of a pattern.  A length meets each total of packs at most once
    before it is placed, so there are fewer than ``capacity`` squared before gaps are closed.
    """

    capacity: int
    key: np.ndarray  # (length, start, first rank) as one number
    length: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    @classmethod
    def of(cls, patterns: Iterable[Pattern], capacity: int) -> Places:
        rows, sequence = [], 0
        for pattern in patterns:
            offset = 0
            for p in pattern.parts:
                rows.append((cls._key(capacity, p.whole, p.start, p.rank), p.length, sequence, offset))
                offset += p.length
            sequence += pattern.times
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        return cls(capacity, *table.T, sequence)

    @staticmethod
    def _key(capacity: int, whole, start, rank):
        bits = 62 - 2 * (capacity + 1).bit_length()
        return ((whole << (capacity + 1).bit_length()) + start << bits) + rank

    def find(self, whole: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Row, start, length, sequence and offset of the first parts of all rows, then of the second ones, …"""
        row, start = np.arange(len(whole)), np.zeros(len(whole), np.int64)
        while len(row):
            wanted = self._key(self.capacity, whole[row], start, rank[row])
            at = np.searchsorted(self.key, wanted, "right") - 1
            length = self.length[at]
            yield row, start, length, self.sequence[at] + wanted - self.key[at], self.offset[at]
            more = start + length < whole[row]
            row, start = row[more], (start + length)[more]


_PIECE = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("number", pa.int64()), ("ids", pa.binary()),
])
_COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, ids: bool = False) -> DataFrame:
    """Whole sequences and remainders of ``docs (doc_id, text)``; ``number`` differs for all rows of a run.

    ``ids`` are little-endian unsigned integers of 16 bits where the vocabulary allows it, else
    of 32; whole sequences have none unless asked for, as nobody cuts them.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        kind = np.dtype(_kind(code, end_id))
        number = TaskContext.get().partitionId() << _NUMBERS
        for part in bounded(batches, "text"):
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                whole = code.encode(text or "") + end
                for at in range(0, len(whole), 4 * capacity):
                    some = whole[at : at + 4 * capacity]
                    kept = np.frombuffer(some, "<u4").astype(kind).tobytes() if ids or len(some) < 4 * capacity else None
                    rows.append((doc_id, at // 4, len(some) // 4, zlib.crc32(some), len(whole) // 4, number, kept))
                    number += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECE)], schema=_PIECE)

    return docs.select("doc_id", "text").mapInArrow(cut, f"{_COLUMNS}, number long, ids binary")


def _kind(code, end_id: int) -> str:
    return "<u2" if max(code.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def placed(remainders: DataFrame, counts: np.ndarray, kind: str, ids: bool = False) -> DataFrame:
    """The parts of written ``remainders`` with ``sequence_id`` (from 0) and ``offset``.

    Remainders of one length are ranked by their numbers, in lots of a hash of the number;
    ``counts`` says how many there are, so a frequent length has many lots.
    """
    capacity = len(counts) - 1
    places = Places.of(closed(shortest_first(counts), capacity), capacity)
    lots = F.element_at(F.lit((1 + counts // RANKED_TOGETHER).tolist()), (F.col("length") + 1).cast("int"))
    dealt = remainders.withColumn("_lot", F.pmod(F.xxhash64("number"), lots))
    sizes = dealt.groupBy("length", "_lot").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_lot").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "_lot", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    within = Window.partitionBy("length", "_lot").orderBy("number")
    ranked = (
        dealt.withColumn("_rank", F.row_number().over(within) - 1)
        .join(bases, ["length", "_lot"])
        .select(*remainders.columns, (F.col("_rank") + F.col("_base")).alias("_rank"))
    )
    schema = pa.schema([*list(_PIECE)[:5], ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "ids"):
            whole = batch.column("length").to_numpy().astype(np.int64)
            codes = batch.column("ids").to_pylist()
            known = batch.column("ids_crc32").to_numpy()
            for row, start, length, sequence, offset in places.find(whole, batch.column("_rank").to_numpy().astype(np.int64)):
                cut = length < whole[row]
                crc, parts = known[row], [None] * len(row)
                for k in np.flatnonzero(cut | ids).tolist():
                    some = np.frombuffer(codes[row[k]], kind)[start[k] : start[k] + length[k]]
                    parts[k] = some.tobytes() if ids else None
                    crc[k] = zlib.crc32(some.astype("<u4").tobytes())
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [
                        taken.column("doc_id"), pa.array(taken.column("start").to_numpy() + start), pa.array(length),
                        pa.array(crc), taken.column("doc_tokens"), pa.array(sequence), pa.array(offset),
                        pa.array(parts, pa.binary()),
                    ],
                    schema=schema,
                )

    found = ranked.mapInArrow(look_up, f"{_COLUMNS}, sequence_id long, offset long, ids binary")
    return found if ids else found.drop("ids")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, ids: bool = False) -> DataFrame:
    """Every token of whole ``docs (doc_id, text)`` in one place of a sequence of at most ``capacity``.

    Columns: ``doc_id, start`` (the document's tokens before it), ``length, ids_crc32,
    doc_tokens, sequence_id, offset``, and with ``ids`` the tokens, little-endian unsigned of
    16 bits where the vocabulary allows it, else of 32.  A document is the ids of its text and
    ``end_id``; null and empty texts are the end id alone.  Sequences have no gaps inside and
    lack less than ``LEAST`` tokens or, where shorter, hold a power of two; whole sequences of
    one document have negative numbers.  Repeated
    rows and ids are packed each by itself, null ids stay, an empty table gives no rows.
    Other columns, whatever their names, are not read.

    Texts are encoded once: pieces are written to the shared folder and read from there.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity has to be a power of two")
    spark = docs.sparkSession
    folder = shared_folder(spark, "lengths")
    cut = pieces(docs, tokenizer, capacity, end_id, ids)
    cut.write.parquet(folder)
    rows = spark.read.schema(cut.schema).parquet(folder)
    remainders = rows.where(F.col("length") < capacity)
    # at most ``capacity`` rows, whatever the input
    counts = np.zeros(capacity + 1, np.int64)
    for row in remainders.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    whole = rows.where(F.col("length") == capacity).withColumns(
        {"sequence_id": -1 - F.col("number"), "offset": F.lit(0).cast("long")}
    )
    parts = placed(remainders, counts, _kind(encoder(tokenizer), end_id), ids)
    return parts.unionByName(whole.select(*parts.columns))
