"""Benchmark decontamination by a broadcast hash set of normalised test n-grams.

A word is a run of digits, letters a-z after lower-casing A-Z, and characters beyond
ASCII.  Every window of ``n`` consecutive words of a benchmark item is looked for in the
word sequence of every whole document; an item of fewer words is one window of its own.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cowrie.session import shared_folder

N = 10
SLICE = 256
#: Bytes of benchmark text whose windows are broadcast at a time (the set takes up to ten
#: times that).  A larger benchmark is cut into parts of this size, one scan for each.
PART_BYTES = 16 << 20

# In UTF-8 every byte of a character beyond ASCII is 128 or more, so bytes cut as characters do.
_FOLD = bytes(
    b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Normalised words; none for null and empty texts."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


@dataclass
class Windows:
    """Hash set of the windows of benchmark items, about 25 bytes a window.

    ``ids`` are the numbered words of all items; ``sets`` has for each window length the
    sorted hashes with where each window begins in ``ids`` and the item it is of.
    """

    number: dict[bytes, int] = field(default_factory=dict)
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    item_ids: list = field(default_factory=list)
    sets: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)

    @classmethod
    def of(cls, rows: list[tuple[int, str | None]], n: int) -> Windows:
        self = cls()
        ids: list[int] = []
        begins: dict[int, list[np.ndarray]] = defaultdict(list)
        owners: dict[int, list[np.ndarray]] = defaultdict(list)
        for item_id, text in rows:
            words = words_of(text)
            if not words:
                continue
            size = min(n, len(words))
            starts = np.arange(len(ids), len(ids) + len(words) - size + 1, dtype=np.int64)
            ids += [self.number.setdefault(w, len(self.number)) for w in words]
            begins[size].append(starts)
            owners[size].append(np.full(len(starts), len(self.item_ids), np.int32))
            self.item_ids.append(item_id)
        self.ids = np.array(ids, np.int32)
        for size in begins:
            begin, owner = np.concatenate(begins[size]), np.concatenate(owners[size])
            hashes = _rolled(self.ids, size)[begin]
            order = np.lexsort((owner, hashes))
            hashes, begin, owner = hashes[order], begin[order], owner[order]
            fresh = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])
            self.sets[size] = hashes[fresh], begin[fresh], owner[fresh]
        return self

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Which words lie in an occurrence of a window, and the items of those windows."""
        ids = np.fromiter(map(self.number.get, words, repeat(-1)), np.int32, len(words))
        hit, found = np.zeros(len(words) + 1, np.int32), set()
        foreign = np.concatenate([[0], np.cumsum(ids < 0)])
        for size, (hashes, begin, owner) in self.sets.items():
            if len(ids) < size:
                continue
            at = np.flatnonzero(foreign[size:] == foreign[:-size])  # windows of benchmark words only
            rolled = _rolled(ids, size, at)
            first, last = np.searchsorted(hashes, rolled), np.searchsorted(hashes, rolled, "right")
            for k in np.flatnonzero(last > first).tolist():
                place = int(at[k])
                window = ids[place : place + size]
                same = [
                    j for j in range(int(first[k]), int(last[k]))
                    if np.array_equal(self.ids[begin[j] : begin[j] + size], window)
                ]
                if same:
                    found.update(self.item_ids[owner[j]] for j in same)
                    hit[place] += 1
                    hit[place + size] -= 1
        return np.cumsum(hit[:-1]) > 0, found


def _rolled(ids: np.ndarray, size: int, at: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of every window of ``size`` numbers, or of those that begin ``at``."""
    at = np.arange(len(ids) - size + 1) if at is None else at
    with np.errstate(over="ignore"):
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        total = np.zeros(len(at), np.uint64)
        for k in range(size):
            total = total * np.uint64(0x100000001B3) + mixed[at + k]
    return total


def _parts(benchmark: DataFrame, n: int) -> Iterator[Windows]:
    """The windows of the benchmark, in parts of at most ``PART_BYTES``; one if it is small.

    Copies of an item count once.  Rows are dealt to buckets by a hash, so finely that a
    bucket above ``PART_BYTES`` is a single item, and measured buckets make up the parts.
    """
    known = benchmark.select("item_id", "text").where("text <> ''").distinct()
    folder = shared_folder(benchmark.sparkSession, "benchmark")
    known.write.parquet(folder)  # each part reads it
    rows = benchmark.sparkSession.read.schema(known.schema).parquet(folder)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 if total <= PART_BYTES else 16 * (1 + total // PART_BYTES)
    while True:
        bucket = F.pmod(F.xxhash64("item_id", "text"), F.lit(buckets))
        length = F.octet_length("text")
        measured = rows.groupBy(bucket.alias("k")).agg(
            F.sum(length).alias("size"), F.max(length).alias("longest"), F.count(F.lit(1)).alias("n")
        )
        # long items first: a short one cut out could break a long one's windows
        sizes = measured.orderBy(F.desc("longest"), "k").collect()
        if all(r["size"] <= PART_BYTES or r["n"] == 1 for r in sizes):
            break
        buckets *= 2
    parts: list[list[int]] = [[]]
    left = PART_BYTES
    for r in sizes:
        if r["size"] > left and parts[-1]:
            parts.append([])
            left = PART_BYTES
        parts[-1].append(r["k"])
        left -= r["size"]
    for part in parts:
        own = rows.where(bucket.isin(part))
        yield Windows.of([(r["item_id"], r["text"]) for r in own.collect()], n)


def _chained(docs: DataFrame, benchmark: DataFrame, n: int, step: Callable, schema: StructType) -> DataFrame:
    """``step(window set)`` mapped over the rows, one part of the benchmark after the other.

    Between parts the rows are written, so that no worker holds two window sets.
    """
    spark, rows, first = docs.sparkSession, docs, True
    for windows in _parts(benchmark, n):
        if not first:
            folder = shared_folder(spark, "decontaminate")
            rows.write.parquet(folder)
            rows = spark.read.schema(schema).parquet(folder)
        rows, first = rows.mapInArrow(step(spark.sparkContext.broadcast(windows)), schema), False
    return rows


def scan(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """``doc_id, n_words, spans, items`` of every row of ``docs (doc_id, text)``.

    ``spans`` are the runs of hit words as ``(begin, end)`` word positions, ``items`` the
    ids of the items with occurring windows, ascending.  Null and empty texts have no
    words.  Items without words have no window; a null ``item_id`` hits, but isn't
    listed.  Rows are scanned one by one, so repeated ids and extra columns don't matter.
    """
    schema = StructType.fromDDL(
        "doc_id long, text string, n_words long, spans array<struct<begin:long,end:long>>, items array<long>"
    )
    begun = docs.select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_words"),
        F.array().cast(schema["spans"].dataType).alias("spans"), F.array().cast("array<long>").alias("items"),
    )

    def step(windows):
        def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    part = batch.slice(at, SLICE)
                    rows = [_scanned(row, windows.value) for row in part.to_pylist()]
                    yield pa.RecordBatch.from_pylist(rows, batch.schema)

        return scanned

    return _chained(begun, benchmark, n, step, schema).drop("text")


def _scanned(row: dict, windows: Windows) -> dict:
    words = words_of(row["text"])
    hit, items = windows.hits(words)
    for span in row["spans"]:
        hit[span["begin"] : span["end"]] = True
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    spans = [{"begin": b, "end": e} for b, e in edge.reshape(-1, 2).tolist()]
    listed = sorted({*row["items"], *(i for i in items if i is not None)})
    return row | {"n_words": len(words), "spans": spans, "items": listed}


def digests(scanned: DataFrame) -> DataFrame:
    """The figures of each scanned document: counts, the digest of its items, the verdict."""
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["begin"])
    return scanned.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, n: int = N, spans: bool = False) -> DataFrame:
    """``docs`` with all their columns, without benchmark windows.

    Contaminated rows go as a whole; with ``spans`` only their hit words go and the rest
    of the text stays, with a line end for each run cut out, and is cut again until no
    window is left.  Other rows stay as they are, null and empty texts too.
    """
    def step(windows):
        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column("text")
                if spans:
                    place = batch.schema.get_field_index("text")
                    cut = pa.array([_cut(t.as_py(), windows.value) for t in texts], batch.schema.field(place).type)
                    yield batch.set_column(place, batch.schema.field(place), cut)
                else:
                    clear = [not windows.value.hits(words_of(t.as_py()))[0].any() for t in texts]
                    yield batch.filter(pa.array(clear, pa.bool_()))

        return clean

    return _chained(docs, benchmark, n, step, docs.schema)


def _cut(text: str | None, windows: Windows) -> str | None:
    """The text without its hit words, one line end for each run of them."""
    while text:
        raw = text.encode("utf-8", "surrogatepass")
        folded = raw.translate(_FOLD)
        words = folded.split()
        hit, _ = windows.hits(words)
        if not hit.any():
            return text
        out, kept_to, place, inside = [], 0, 0, False
        for word, gone in zip(words, hit.tolist()):
            begin = folded.index(word, place)
            place = begin + len(word)
            if gone and not inside:
                out.append(raw[kept_to:begin] + b"\n")
            if gone:
                kept_to = place
            inside = gone
        text = b"".join([*out, raw[kept_to:]]).decode("utf-8", "surrogatepass")
    return text
