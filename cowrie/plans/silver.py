"""Bronze to silver: dedup, clean, convert, enrich, upsert."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cowrie.functions.money import with_eur
from cowrie.functions.periods import period_of
from cowrie.model import DATASETS, Dataset
from cowrie.operators.enrich import enrich
from cowrie.operators.incremental import first_pending
from cowrie.operators.latest import few_repeat, last_day_wins, latest_per_day, latest_per_key, repeated_apart
from cowrie.operators.quality import usable_amounts
from cowrie.sources.lake import Lake


def refined(
    rows: DataFrame,
    dataset: Dataset,
    references: Mapping[str, DataFrame],
    newest: str = "timestamp",
    moment: str | None = None,
    single_day: bool = False,
    apart: bool | None = None,
) -> DataFrame:
    """Silver rows of any number of days in one plan.

    The end state is that of refining and upserting day by day: the newest row of
    a key within a day is kept, then cleaned; where a key survives on several
    days, the last day's row stays.  Rows without a business date are left out.

    Rows of a key that occurs once need no window: where few keys repeat they aren't
    shuffled for it.  Where many do, all rows move by key once and meet both windows.
    ``apart`` says which; if it is left out the keys are counted, about, by a scan of their
    column.  ``rows`` that are no table are computed once with ``apart=False``.
    """
    moment = moment or dataset.event_column
    dated = rows.filter(rows[moment].isNotNull())
    if apart is None:
        apart = few_repeat(dated, dataset.key)
    # one shuffle by key serves both windows
    once, again = repeated_apart(dated, dataset.key) if apart else (None, dated.repartition(dataset.key))
    if single_day:
        clean = usable_amounts(latest_per_key(again, [dataset.key], newest), dataset.amounts)
    else:
        by_day = again.withColumn("_day", period_of(moment, "day"))
        clean = usable_amounts(latest_per_day(by_day, dataset.key, "_day", newest), dataset.amounts)
        clean = last_day_wins(clean, dataset.key, "_day").drop("_day")
    if once is not None:
        clean = usable_amounts(once, dataset.amounts).unionByName(clean)
    used = {name: references[name] for name in dataset.references}
    return enrich(with_eur(clean, dataset.amounts), used)


def pending_days(lake: Lake, name: str, refresh_current: bool = False) -> list[dt.date]:
    """Bronze days after the last silver day, ascending."""
    first = first_pending(lake.silver(name).latest("event_date"), "day", refresh_current)
    return [d for d in lake.bronze(name).days("event_date") if first is None or d >= first]


def refresh(
    lake: Lake, name: str, day: dt.date | None = None, refresh_current: bool = False
) -> int | None:
    """Refine one day again, or all days after the last one in silver.

    Returns the rows refined, None if no day is pending.
    """
    dataset = DATASETS[name]
    bronze, silver = lake.bronze(name), lake.silver(name)
    for table in (bronze, silver, *map(lake.bronze, dataset.references)):
        table.recover()  # what a dead job has left half done would be passed by for ever
    if day is None:
        days = pending_days(lake, name, refresh_current)
    else:
        days = [d for d in bronze.days("event_date") if d == day]
    if not days:
        return None
    rows = bronze.read_days("event_date", days[0], days[-1])
    references = {r: lake.bronze(r).read() for r in dataset.references}
    counts = Observation(f"refined_{name}")
    fine = refined(rows, dataset, references, moment="event_date", single_day=len(days) == 1)
    silver.merge(fine.observe(counts, F.count(F.lit(1)).alias("rows")))
    return counts.get["rows"]
