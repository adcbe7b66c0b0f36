"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected to a few random directions, shifted, and ordered along a Hilbert
curve; several projections and shifts give several orderings.  Spark sorts all orderings
by range.  A query's candidates are the vectors within a window of ranks around it on
any curve; their exact distances decide.

Equal vectors are one point of the curves with its smallest ids, so a vector that a third
of the rows share fills no window.  The number of curves and the width of the windows, a
share of the points, are the cheapest that find ``TARGET`` of the true neighbours in a
bounded sample; every vector is ordered.  A sample is sparser than all the vectors, so
its neighbours lie farther along the curves and the widths are rather too large.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cowrie.session import shared_folder

DIRECTIONS, BITS = 8, 7
#: Vectors the curves and windows are fitted on, and how many of them serve as queries.
SAMPLE, PROBES = 4_000, 200
TARGET = 0.95
CURVES = (2, 4, 8)
#: Points of a curve that a task compares with queries at a time.
BLOCK = 4_096


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells``, whole numbers below ``2**bits``.

    Rows become Gray-coded axes that are turned level by level, and their bits are
    interleaved (Skilling, 2004).
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for k in range(n):
            turn = x[k] & level != 0
            swap = np.where(turn, 0, (x[0] ^ x[k]) & low)
            x[0] ^= np.where(turn, low, swap)
            if k:
                x[k] ^= swap
        level >>= 1
    for k in range(1, n):
        x[k] ^= x[k - 1]
    turned, level = np.zeros_like(x[0]), 1 << (bits - 1)
    while level > 1:
        turned ^= np.where(x[-1] & level != 0, level - 1, 0)
        level >>= 1
    x ^= turned
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for k in range(n):
            place = place << 1 | x[k] >> bit & 1
    return place


@dataclass
class Curves:
    """``turns[c]`` projects, ``low`` and ``step`` cut the projections into cells, ``shifts[c]`` moves them."""

    turns: list[np.ndarray]
    shifts: list[np.ndarray]
    low: list[np.ndarray]
    step: list[np.ndarray]
    width: float = 1.0

    @classmethod
    def of(cls, sample: np.ndarray) -> Curves:
        random = np.random.default_rng(0)
        self = cls([], [], [], [])
        for _ in range(max(CURVES)):
            turn, _ = np.linalg.qr(random.normal(size=(sample.shape[1], min(DIRECTIONS, sample.shape[1]))))
            seen = sample @ turn
            low, high = seen.min(0), seen.max(0)
            self.turns.append(turn)
            self.shifts.append(random.random(turn.shape[1]))
            self.low.append(low)
            # twice the range: room for a shift by up to the range itself
            self.step.append(np.maximum(2 * (high - low), 1e-300) / (1 << BITS))
        return self

    def places(self, curve: int, vectors: np.ndarray) -> np.ndarray:
        cells = (vectors @ self.turns[curve] - self.low[curve]) / self.step[curve] + self.shifts[curve] * (1 << BITS - 1)
        return hilbert(np.clip(cells, 0, (1 << BITS) - 1), BITS)

    def fitted(self, sample: np.ndarray, k: int) -> Curves:
        """The number of curves and the width that find ``TARGET`` of the sample's true neighbours."""
        n = len(sample)
        probes = np.arange(0, n, max(1, n // PROBES))[:PROBES]
        true = np.stack([np.argsort(((sample - sample[p]) ** 2).sum(1), kind="stable")[1 : k + 1] for p in probes])
        apart = []
        for curve in range(max(CURVES)):
            rank = np.empty(n)
            rank[np.argsort(self.places(curve, sample), kind="stable")] = np.arange(n)
            apart.append(np.abs(rank[true] - rank[probes][:, None]) / n)
        choice = []
        for curves in CURVES:
            nearest = np.sort(np.min(apart[:curves], 0), None)
            width = float(nearest[int(np.ceil(TARGET * len(nearest))) - 1])
            choice.append((curves * min(1.0, 2 * width), curves, width))
        _, curves, width = min(choice)
        return Curves(self.turns[:curves], self.shifts[:curves], self.low[:curves], self.step[:curves], width)


def points(vectors: DataFrame, ids_kept: int) -> DataFrame:
    """``vector`` (doubles), ``ids``: each distinct vector with its smallest ``ids_kept`` ids, ascending.

    Vectors that are null, zero, or hold null or non-finite components, rows without an
    id, and vectors of another than the most frequent number of components take no part.
    """
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    valid = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("vec_id"), _numbers().alias("vector")
    ).where(finite & F.exists("vector", lambda x: x != 0))
    size = valid.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    valid = valid.where(F.size("vector") == (size["n"] if size else 0)).distinct()
    # the smallest ids are cut out before and after the shuffle
    order = Window.partitionBy("vector").orderBy("vec_id")
    few = valid.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= ids_kept)
    return few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _numbers() -> Column:
    return F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))  # -0.0 is 0.0


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _ranked(rows: DataFrame, curves: Curves) -> DataFrame:
    """Written ``curve, rank, vector, ids`` of all points on all curves."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(curves)
    kind = "curve int, place long, vector array<double>, ids array<long>"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column("vector"))
                for curve in range(len(shared.value.turns)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(batch.num_rows, curve), pa.int32()), pa.array(shared.value.places(curve, vectors)),
                         batch.column("vector"), batch.column("ids")], names=["curve", "place", "vector", "ids"],
                    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part), pa.int32()), pa.array(np.arange(at, at + n)), batch.column("curve"),
                 batch.column("vector"), batch.column("ids")], names=["part", "at", "curve", "vector", "ids"],
            )
            at += n

    first = F.element_at("ids", 1)
    sorted_rows = rows.mapInArrow(place, kind).withColumn("first", first)
    sorted_rows = sorted_rows.repartitionByRange("curve", "place", "first").sortWithinPartitions("curve", "place", "first")
    folder = shared_folder(spark, "curves")
    numbered = sorted_rows.select("curve", "vector", "ids").mapInArrow(
        number, "part int, at long, curve int, vector array<double>, ids array<long>"
    )
    numbered.write.parquet(folder)
    written = spark.read.schema(numbered.schema).parquet(folder)
    counts = written.groupBy("part", "curve").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("least"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each part and curve, however many points they hold
    starts = counts.select("part", "curve", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("least")).alias("start"))
    return written.join(starts, ["part", "curve"]).select("curve", (F.col("start") + F.col("at")).alias("rank"), "vector", "ids")


def search(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """``query_id, rank, vec_id, score`` of ``vectors (vec_id, embedding)``, nearest first, ties to the smaller id.

    Queries are the vectors whose id is divisible by ``every``; candidates are all rows
    but those with the query's own id.  ``score`` is the Euclidean distance in double
    precision.  Rows that repeat an id and a vector count once.  Other columns are
    ignored, empty tables give empty results.
    """
    spark = vectors.sparkSession
    folder = shared_folder(spark, "points")
    points(vectors, k + 1).write.parquet(folder)
    rows = spark.read.schema("vector array<double>, ids array<long>").parquet(folder)
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    drawn = rows.where(F.pmod(F.xxhash64("vector"), F.lit(1 << 20)) < SAMPLE / n * (1 << 20))
    sample = np.array([r["vector"] for r in drawn.select("vector").orderBy("vector").collect()], float)
    if len(sample) > 10 * k:
        curves = Curves.of(sample).fitted(sample, k)
    else:  # too few to learn from: windows as wide as the curves
        curves = Curves.of(np.array([r["vector"] for r in rows.limit(SAMPLE).collect()], float))
    window = int(np.ceil(curves.width * n))
    ranked = _ranked(rows, curves)
    asked = vectors.where((F.col("vec_id") % every == 0) & F.col("embedding").isNotNull()).select(
        F.col("vec_id").cast("long").alias("query_id"), _numbers().alias("vector")
    )
    own = ranked.select("curve", "rank", "vector").join(asked.distinct(), "vector")
    last = (n - 1) // BLOCK
    low = F.greatest(F.lit(0), F.floor((F.col("rank") - window) / BLOCK))
    high = F.least(F.lit(last), F.floor((F.col("rank") + window) / BLOCK))
    queries = own.select("curve", F.explode(F.sequence(low, high)).alias("block"), "vector", F.array("query_id").alias("ids"))
    blocks = ranked.select("curve", F.floor(F.col("rank") / BLOCK).alias("block"), "vector", "ids")
    both = queries.withColumn("asks", F.lit(True)).unionByName(blocks.withColumn("asks", F.lit(False)))
    # one block of points, and its queries one after another
    dealt = both.repartition("curve", "block").sortWithinPartitions("curve", "block", "asks")
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, ids, ready = None, [], [], None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("curve", "block", "asks", "ids")]
            matrix = _matrix(batch.column("vector"))
            out: list[tuple[int, int, float]] = []
            for row, (curve, block, asks, own_ids) in enumerate(zip(*columns)):
                if (curve, block) != at:
                    at, held, ids, ready = (curve, block), [], [], None
                if not asks:
                    held.append(matrix[row])
                    ids.append(own_ids)
                    continue
                if ready is None:
                    ready = np.array(held)
                out += nearest(ready, ids, matrix[row], own_ids[0], k)
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], f.type) for c, f in enumerate(schema)], schema=schema)

    found = dealt.mapInArrow(compare, "query_id long, vec_id long, score double").distinct()
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def nearest(matrix: np.ndarray, ids: list[list[int]], query: np.ndarray, query_id: int, k: int) -> list[tuple[int, int, float]]:
    """The ``k`` nearest rows of one block by exact distance, ties to the smaller id."""
    if not len(matrix):
        return []
    square = ((matrix - query) ** 2).sum(1)
    # k + 1 points hold at least k ids besides the query's own; more where distances tie
    cut = np.partition(square, min(k, len(square) - 1))[min(k, len(square) - 1)]
    found = sorted((square[p], i) for p in np.flatnonzero(square <= cut).tolist() for i in ids[p] if i != query_id)
    return [(query_id, i, float(np.sqrt(s))) for s, i in found[:k]]
