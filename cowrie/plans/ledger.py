"""One row for each batch job and each micro-batch: what came in, went out, was rejected or late."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from cowrie.sources import files
from cowrie.sources.lake import FactTable, Lake

COLUMNS = (
    "job string, run string, batch long, at timestamp, rows_in long, rows_out long, rejected long, "
    "late long, state_rows long, watermark timestamp, seconds double"
)


ROOT = "runs"


def table(lake: Lake, job: str) -> FactTable:
    """The rows of one job: jobs run side by side, and a table has one writer at a time."""
    runs = FactTable(lake.spark, f"{lake.path('gold', ROOT)}/{job.replace(' ', '-')}", "run", [])
    runs.create(COLUMNS)
    return runs


def _time(text: str | None) -> dt.datetime | None:
    return dt.datetime.fromisoformat(text).replace(tzinfo=None) if text else None


def _progress(job: str, p, observed: str) -> tuple:
    """A micro-batch as a row; ``late`` are the rows that came behind the watermark."""
    states = p["stateOperators"]
    at = _time(p["timestamp"])
    counts = p["observedMetrics"].get(observed)
    rejected = counts["rejected"] if counts else None
    return (
        job, p["runId"], p["batchId"], at, p["numInputRows"], None, rejected,
        sum(s["numRowsDroppedByWatermark"] for s in states), sum(s["numRowsTotal"] for s in states),
        _time(p["eventTime"].get("watermark")), p["batchDuration"] / 1000,
    )


@dataclass
class Ledger:
    """Writes rows to tables below ``gold/runs``, one for each job.

    Spark keeps the figures of a query's last hundred micro-batches; ``stream`` takes those
    it hasn't written, so it has to be called within that many triggers and once at the end.
    A run that dies in between leaves out what it had not written; nothing is written twice.
    """

    lake: Lake
    _written: dict[str, int] = field(default_factory=dict)

    def batch(self, job: str, seconds: float, rows_in: int | None = None, rows_out: int | None = None,
              rejected: int | None = None) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self._append([(job, str(uuid.uuid4()), 0, now, rows_in, rows_out, rejected, None, None, None, seconds)])

    def stream(self, job: str, query: StreamingQuery, observed: str = "messages") -> None:
        run = str(query.runId)
        new = [p for p in query.recentProgress if p["batchId"] > self._written.get(run, -1)]
        # a trigger without new rows reports its last batch again
        by_batch = {p["batchId"]: p for p in new if p["batchDuration"] is not None and _ran(p)}
        if by_batch:
            self._append([_progress(job, p, observed) for p in by_batch.values()])
            self._written[run] = max(by_batch)

    def streams(self, queries: Iterable[tuple[str, StreamingQuery]]) -> None:
        for job, query in queries:
            self.stream(job, query)

    def _append(self, rows: list[tuple]) -> None:
        table(self.lake, rows[0][0]).append(self.lake.spark.createDataFrame(rows, COLUMNS).coalesce(1))

    def read(self) -> DataFrame:
        """The rows of all jobs."""
        root = self.lake.path("gold", ROOT)
        every = [table(self.lake, job).read() for job in files.children(self.lake.spark, root)]
        return reduce(DataFrame.unionByName, every, self.lake.spark.createDataFrame([], COLUMNS))


def _ran(progress) -> bool:
    return "addBatch" in progress["durationMs"]
