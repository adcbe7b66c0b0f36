"""Premiums of the last year per customer, kept ready for the claims of a stream.

Premiums are summed per customer and day where silver has changed, and days expire after a
year; their totals are written as one row per customer, in folders by a hash of the
customer.  A micro-batch reads the folders of its claimants and no facts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cowrie.functions.money import beyond, cents, euros, total
from cowrie.functions.periods import period_of
from cowrie.model import PREMIUM_DAYS
from cowrie.operators.indicators import is_premium
from cowrie.plans.kept import KeptDays
from cowrie.sources import files
from cowrie.sources.lake import Lake, SmallTable
from cowrie.streaming.alerts import BUCKET, PREMIUM_TOTALS, bucket_of

TOTALS = f"customer_id string, annual_premium_eur double, {BUCKET} int"
#: Days whose totals stay, for micro-batches that began before midnight.
TOTALS_KEPT = 2


def by_customer_and_day(operations: DataFrame, moment: str = "event_date") -> DataFrame:
    return (
        operations.filter(is_premium())
        .groupBy(period_of(moment, "day").alias("day"), "customer_id")
        .agg(F.sum(cents("amount_eur")).alias("p"), F.sum(beyond("amount_eur")).alias("p_beyond"))
    )


def kept_days(lake: Lake) -> KeptDays:
    return KeptDays(lake, "premiums_by_day", "insurance_operations", by_customer_and_day)


def totals_table(lake: Lake, today: dt.date) -> SmallTable:
    return SmallTable(lake.spark, f"{lake.path('gold', PREMIUM_TOTALS)}/{today}", [BUCKET])


def refresh(lake: Lake, today: dt.date) -> list[dt.date]:
    """Brings premiums and totals up to date for ``today``; returns the days read anew."""
    first = today - dt.timedelta(days=PREMIUM_DAYS)
    lake.silver("insurance_operations").recover()
    kept = kept_days(lake)
    days = kept.refresh(first)
    table = totals_table(lake, today)
    if days or not table.exists():
        if kept.marks.exists() and kept.rows.exists():
            sums = kept.read(first).groupBy("customer_id").agg(
                euros(total(F.sum("p"), F.sum("p_beyond"))).alias("annual_premium_eur")
            )
        else:
            sums = lake.spark.createDataFrame([], TOTALS).drop(BUCKET)
        # rebalance: a folder has one file, or several where it is large
        table.write(sums.withColumn(BUCKET, bucket_of("customer_id")).hint("rebalance", BUCKET))
    root = lake.path("gold", PREMIUM_TOTALS)
    for old in sorted(files.children(lake.spark, root))[:-TOTALS_KEPT]:
        files.remove(lake.spark, f"{root}/{old}")
    return days


def current(lake: Lake, today: dt.date) -> DataFrame:
    """``customer_id, annual_premium_eur, bucket`` as of ``today``; made first if a new day has begun."""
    table = totals_table(lake, today)
    if not table.exists():
        refresh(lake, today)
    return table.read(TOTALS)


def loader(lake: Lake, today: Callable[[], dt.date]) -> Callable[[str, str], DataFrame]:
    """``lake.load``, which also knows the totals of premiums."""

    def load(layer: str, name: str) -> DataFrame:
        return current(lake, today()) if name == PREMIUM_TOTALS else lake.load(layer, name)

    return load
