"""Which periods are still to be computed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cowrie.functions.periods import from_day, next_period, period_of


def high_water_mark(df: DataFrame, moment: str, grain: str = "day") -> dt.date | None:
    """The latest period present: one value, whatever the size of the table."""
    return df.agg(period_of(F.max(moment), grain).alias("mark")).collect()[0]["mark"]


def first_pending(mark: dt.date | None, grain: str, refresh_current: bool = False) -> dt.date | None:
    """First day that is still to be read, given the last period present.

    Strict by default: a period once present is not computed again, so rows that
    arrive late for it stay out.  ``refresh_current`` computes the last one anew.
    """
    if mark is None or refresh_current:
        return mark
    return next_period(mark, grain)


def pending_rows(
    source: DataFrame, moment: str, grain: str, mark: dt.date | None, refresh_current: bool = False
) -> DataFrame:
    """Rows of the periods after the mark, as a range the scan can prune by."""
    return from_day(source, moment, first_pending(mark, grain, refresh_current))


def pending_periods(
    source: DataFrame, moment: str, grain: str, mark: dt.date | None, refresh_current: bool = False
) -> DataFrame:
    """The periods after the mark, ascending."""
    rows = pending_rows(source.select(moment), moment, grain, mark, refresh_current)
    return rows.select(period_of(moment, grain).alias("period")).distinct().orderBy("period")
