"""Sums of a table's days, kept beside gold and brought up to date from the days that changed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cowrie.functions.periods import period_of, period_start
from cowrie.session import shared_folder
from cowrie.sources import files
from cowrie.sources.lake import FactTable, Lake, SmallTable

PIECE = "piece"


@dataclass(frozen=True)
class KeptDays:
    """``compute``'s rows for each day of silver ``source``, with a column ``day``.

    Each row carries its day's mark, a hash of the names, lengths and times of the day's
    files.  A refresh lists the files, computes the days whose mark differs, also where
    rows came late, moved or went, and replaces them; the facts of other days aren't read.
    What is current is said by one small table of days and marks, written last: rows of
    another mark are passed by, so a refresh that dies half done is simply done again.

    Rows lie in folders by ``grain``: months where days are thin, days where they aren't.
    ``source`` has to be cut by ``column``.
    """

    lake: Lake
    name: str
    source: str
    compute: Callable[[DataFrame], DataFrame]
    grain: str = "day"
    column: str = "event_date"

    @property
    def rows(self) -> FactTable:
        return FactTable(self.lake.spark, self.lake.path("gold", self.name), "day", [PIECE])

    @property
    def marks(self) -> SmallTable:
        return SmallTable(self.lake.spark, self.lake.path("gold", f"{self.name}_marks"))

    def refresh(self, first: dt.date | None = None) -> list[dt.date]:
        """Brings all days up to date; returns the days computed.

        With ``first`` only the days from it on are kept, and folders of earlier ones go.
        """
        table = self.lake.silver(self.source)
        if not table.exists():
            return []
        now = table.day_marks(self.column)
        if first is not None:
            now = now.filter(F.col("day") >= F.lit(first))
        if self.marks.exists():
            before = self.marks.read()
            changed = now.join(before, ["day", "mark"], "left_anti")
            gone = not before.join(now, "day", "left_anti").isEmpty()
        else:
            changed, gone = now, False
        # dates: as many as the table has days
        days = sorted(row["day"] for row in changed.select("day").collect())
        if days:
            self._replace(table.read_on(self.column, set(days)), changed)
        if days or gone:
            self.marks.write(now.coalesce(1))
        if first is not None and self.rows.exists():
            for folder, piece in self.rows.folders(PIECE):
                if piece < period_start(first, self.grain):
                    files.remove(self.lake.spark, folder)
        return days

    def _replace(self, facts: DataFrame, changed: DataFrame) -> None:
        """Puts the changed days' rows in the place of all rows of their folders, of which other days stay."""
        piece = period_of("day", self.grain)
        fresh = self.compute(facts).join(F.broadcast(changed), "day").withColumn(PIECE, piece)
        kept = self.rows
        if kept.exists() and self.grain != "day":
            pieces = changed.select(piece.alias(PIECE)).distinct()
            others = kept.read().join(F.broadcast(pieces), PIECE, "left_semi").join(F.broadcast(changed.select("day")), "day", "left_anti")
            fresh = fresh.unionByName(others.select(*fresh.columns))
            staged = shared_folder(self.lake.spark, self.name)  # part of it comes from the folders it replaces
            fresh.write.parquet(staged)
            fresh = self.lake.spark.read.schema(fresh.schema).parquet(staged)
        kept.replace_partitions(fresh)

    def read(self, first: dt.date | None = None) -> DataFrame:
        """The current rows, of all days or those from ``first`` on."""
        rows, marks = self.rows.read(), self.marks.read()
        if first is not None:
            rows = rows.filter((F.col(PIECE) >= F.lit(period_start(first, self.grain))) & (F.col("day") >= F.lit(first)))
        # one row for each day there is
        return rows.join(F.broadcast(marks), ["day", "mark"], "left_semi").drop("mark", PIECE)
