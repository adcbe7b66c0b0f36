"""Days, ISO weeks and months, all written as the date of their first day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month")


def period_of(moment: Column | str, grain: str) -> Column:
    moment = F.col(moment) if isinstance(moment, str) else moment
    if grain == "day":
        return F.to_date(moment)
    if grain == "week":
        return F.to_date(F.date_trunc("week", moment))
    if grain == "month":
        return F.trunc(moment, "month")
    raise ValueError(f"unknown grain {grain!r}, expected one of {GRAINS}")


def period_start(day: dt.date, grain: str) -> dt.date:
    if grain == "week":
        return day - dt.timedelta(days=day.weekday())
    return day.replace(day=1) if grain == "month" else day


def next_period(period: dt.date, grain: str) -> dt.date:
    if grain == "month":
        return (period.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
    return period + dt.timedelta(days=7 if grain == "week" else 1)


def parse_day(text: str) -> dt.date:
    return dt.datetime.strptime(text, "%Y%m%d").date()


def from_day(df: DataFrame, moment: str, first: dt.date | None) -> DataFrame:
    """Rows at or after ``first``, or every dated row.

    The comparison is on the column itself, so it reaches the Parquet scan and
    prunes partitions where ``moment`` is a partition column.
    """
    if first is None:
        return df.filter(F.col(moment).isNotNull())
    return df.filter(F.col(moment) >= F.lit(first))


def on_day(df: DataFrame, moment: str, day: dt.date) -> DataFrame:
    """Rows of one day as a half-open range on the column itself."""
    after = day + dt.timedelta(days=1)
    return df.filter((F.col(moment) >= F.lit(day)) & (F.col(moment) < F.lit(after)))
