"""Stream sinks that a replayed micro-batch does not write twice."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cowrie.model import TRIGGER
from cowrie.sources import files


ADAPTIVE = "spark.sql.adaptive.enabled"
BATCH = "batch_id"
#: Bytes of a topic whose windows one piece of state takes, about.
STATE_PIECE = 4 << 20


def run(
    rows: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str,
    trigger: dict | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start a query that hands each non-empty micro-batch to ``write``.

    A micro-batch is computed once, and counting it tells the planner its size:
    a small one is broadcast against the large tables a rule joins it with.  Spark
    turns AQE off for the stream itself, whose state must keep its partitions; what
    ``write`` does with the computed batch is planned with AQE again, so that hot
    partitions are split and small ones merged before files are written.

    Keep the checkpoint on the same lasting storage as the tables: batch numbers,
    and with them the replaceable pieces, continue from it.  It also fixes
    ``state_partitions``, the number of pieces of the keyed state.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        batch = batch.persist()
        try:
            if batch.count():
                conf.set(ADAPTIVE, "true")
                write(batch, batch_id)
        finally:
            conf.set(ADAPTIVE, "false")
            batch.unpersist()

    stream = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    query = stream.trigger(**(trigger or {"processingTime": TRIGGER})).foreachBatch(each)
    conf, width = rows.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(width)
    conf.set(width, str(state_partitions or before))
    try:
        return query.start()  # the query keeps the settings it starts with
    finally:
        conf.set(width, before)


def state_pieces(spark: SparkSession, folder: str, piece: int = STATE_PIECE) -> int:
    """Pieces of state for a stream that begins with all files of ``folder`` as one micro-batch.

    A task sorts its piece's rows of the micro-batch, so the pieces grow in number and not in size.
    """
    return max(spark.sparkContext.defaultParallelism, -(-files.size(spark, folder) // piece))


def late_rows(query: StreamingQuery) -> int:
    """Rows the query's recent micro-batches dropped because they came after the watermark."""
    operators = [op for p in query.recentProgress for op in p["stateOperators"]]
    return sum(op["numRowsDroppedByWatermark"] for op in operators)


@dataclass(frozen=True)
class StreamTable:
    """An append-only table cut by ``partition_by`` and, innermost, by micro-batch.

    A replayed micro-batch overwrites its own folders.  Batches come one after another
    and each is marked when all of it is written; readers take those up to the mark.
    """

    path: str
    partition_by: Sequence[str]

    @property
    def _done(self) -> str:
        return f"{self.path}/_done"

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        if not self.exists(spark):
            empty = spark.createDataFrame([], rows.schema)
            empty.write.mode("overwrite").options(**files.MARK_DONE).parquet(f"{self.path}/_schema")
        pieces = rows.withColumn(BATCH, F.lit(batch_id)).hint("rebalance", *self.partition_by)
        output = pieces.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        output.partitionBy(*self.partition_by, BATCH).parquet(self.path)
        before = files.children(spark, self._done)
        files.make_folder(spark, f"{self._done}/{max(batch_id, self._last(before)):020d}")
        for mark in before:
            if int(mark) < batch_id:
                files.remove(spark, f"{self._done}/{mark}")

    @staticmethod
    def _last(marks: Sequence[str]) -> int:
        return max(map(int, marks), default=-1)

    def exists(self, spark: SparkSession) -> bool:
        return files.is_complete(spark, f"{self.path}/_schema")

    def read(self, spark: SparkSession) -> DataFrame:
        schema = spark.read.parquet(f"{self.path}/_schema").schema
        last = self._last(files.children(spark, self._done))
        rows = spark.read.schema(schema.add(BATCH, "long")).parquet(self.path)
        return rows.filter(F.col(BATCH) <= last).drop(BATCH)
