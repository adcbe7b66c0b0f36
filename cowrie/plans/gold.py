"""Silver to gold: a registry of indicators and their incremental refresh."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from cowrie.functions.periods import period_start
from cowrie.operators import indicators
from cowrie.operators.incremental import first_pending
from cowrie.plans.kept import KeptDays
from cowrie.sources.lake import Lake

DAY = "event_date"


@dataclass(frozen=True)
class Indicator:
    """How an indicator is computed and merged.

    ``compute`` takes the lake and the first day to be computed.
    A new indicator is one more entry; its source's days decide what is pending.
    """

    source: str
    grain: str
    keys: tuple[str, ...]
    compute: Callable[[Lake, dt.date], DataFrame]
    also: tuple[str, ...] = ()

    @property
    def sources(self) -> tuple[str, ...]:
        return (self.source, *self.also)


def _since(lake: Lake, source: str, first: dt.date) -> DataFrame:
    return lake.silver(source).read_days(DAY, first)


def _volume(lake: Lake, first: dt.date) -> DataFrame:
    return indicators.daily_transaction_volume(_since(lake, "bank_transactions", first), DAY)


def due_by_day(lake: Lake) -> KeptDays:
    """What each day adds to the stock of defaults."""
    return KeptDays(
        lake, "loan_due_by_day", "loan_repayments", lambda loans: indicators.due_by_day(loans, DAY), "month"
    )


def _npl(lake: Lake, first: dt.date) -> DataFrame:
    # a stock: all days count, but only the facts of those that changed are read
    kept = due_by_day(lake)
    kept.refresh()
    return indicators.default_stock(kept.read(), first)


def _arpu(lake: Lake, first: dt.date) -> DataFrame:
    return indicators.customer_arpu_monthly(
        _since(lake, "bank_transactions", first), _since(lake, "loan_repayments", first), DAY, DAY
    )


def _loss_ratio(lake: Lake, first: dt.date) -> DataFrame:
    return indicators.loss_ratio_by_product(_since(lake, "insurance_operations", first), DAY)


def _processing(lake: Lake, first: dt.date) -> DataFrame:
    return indicators.claims_processing_time(_since(lake, "insurance_operations", first), DAY)


def _flow(lake: Lake, first: dt.date) -> DataFrame:
    return indicators.mobile_money_daily_flow(_since(lake, "mobile_money", first), DAY)


def _corridors(lake: Lake, first: dt.date) -> DataFrame:
    return indicators.cross_border_transfers(_since(lake, "mobile_money", first), DAY)


INDICATORS = {
    "daily_transaction_volume": Indicator(
        "bank_transactions", "day", ("period", "country_code", "entity_type", "transaction_type"), _volume
    ),
    "npl_ratio_by_country": Indicator(
        "loan_repayments", "day", ("period", "country_code", "loan_type"), _npl
    ),
    "customer_arpu_monthly": Indicator(
        "bank_transactions", "month", ("period", "country_code", "segment"), _arpu, ("loan_repayments",)
    ),
    "loss_ratio_by_product": Indicator(
        "insurance_operations", "month", ("period", "country_code", "product_line"), _loss_ratio
    ),
    "claims_processing_time": Indicator(
        "insurance_operations", "month", ("period", "country_code", "product_line"), _processing
    ),
    "mobile_money_daily_flow": Indicator("mobile_money", "day", ("period", "country_code"), _flow),
    "cross_border_transfers": Indicator(
        "mobile_money", "week", ("period", "sender_country", "receiver_country"), _corridors
    ),
}


def new_periods(lake: Lake, name: str, refresh_current: bool = False) -> list[dt.date]:
    """The periods of the source after the last one computed, ascending."""
    indicator = INDICATORS[name]
    first = first_pending(lake.gold(name).latest("period"), indicator.grain, refresh_current)
    days = lake.silver(indicator.source).days(DAY)
    periods = {period_start(d, indicator.grain) for d in days if first is None or d >= first}
    return sorted(periods)


def refresh(
    lake: Lake, name: str, refresh_current: bool = False, null_safe: bool = False
) -> int | None:
    """Compute an indicator's pending periods and upsert them.

    Returns the rows computed, None if no period is pending.

    The pending periods are exactly those after the mark, so they are read as a
    range of days that prunes partitions, not as a list.
    """
    indicator = INDICATORS[name]
    for source in indicator.sources:
        lake.silver(source).recover()  # what a dead job has left half done would be passed by for ever
    lake.gold(name).recover()
    periods = new_periods(lake, name, refresh_current)
    if not periods:
        return None
    computed = indicator.compute(lake, periods[0])
    return lake.gold(name).upsert(computed, list(indicator.keys), null_safe)
