"""Connected components of a graph of any size, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cowrie.session import shared_folder


#: Edges that one task joins by itself.
TOGETHER = 500_000


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges (a, b)`` that isn't the least of its component.

    ``root`` is that least node.  First every task replaces its share of the edges, a
    bounded one, by stars, as long as that thins them out; where one share holds all,
    that is the result.  Then large stars tie the larger neighbours of each node to its
    least one and small stars the smaller ones (Kiveris et al., 2014), in rounds until
    nothing changes.  Each round is written to the shared folder, so that lost executors
    cost at most a round.  Loops, repeated edges and edges with a null don't matter.
    """
    now = _written(edges.select("a", "b").where("a <> b").distinct())
    n = now.count()
    while n:
        parts, before = -(-n // TOGETHER), n
        now = _written(_stars(now, parts))
        if parts == 1:
            return _named(now)
        n = now.count()
        if n > 0.7 * before:
            break
    mark = _mark(now)
    while n:
        now = _written(_small_star(_large_star(now)))
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return _named(now)


def _named(stars: DataFrame) -> DataFrame:
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _stars(edges: DataFrame, parts: int) -> DataFrame:
    """The components of each of ``parts`` shares of the edges, as edges from each node to the least one."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def find(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        schema = None
        for batch in batches:
            schema = batch.schema
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                x, y = find(parent.setdefault(a, a)), find(parent.setdefault(b, b))
                if x != y:
                    parent[max(x, y)] = min(x, y)
        if schema:
            ends = [(x, root) for x in parent if (root := find(x)) != x]
            columns = [pa.array([e[k] for e in ends], schema.field(k).type) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    dealt = edges.coalesce(1) if parts == 1 else edges.repartition(parts, F.xxhash64("a", "b"))
    return dealt.mapInArrow(joined, edges.schema)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b"))).distinct()


def _written(rows: DataFrame) -> DataFrame:
    folder = shared_folder(rows.sparkSession, "components")
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _mark(edges: DataFrame) -> tuple:
    """Differs for different edge lists: their number and the sum of their hashes."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
