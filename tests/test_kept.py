"""Sums of days kept beside gold: what a refresh reads, and that it always ends in the whole result."""

import pytest
from conftest import as_set, day
from pyspark.sql import functions as F

from cowrie.operators import indicators
from cowrie.plans import gold
from cowrie.plans.kept import KeptDays
from cowrie.sources.lake import FactTable, Lake, SmallTable

LOANS = ("repayment_id string, country_code string, loan_type string, repayment_status string, "
         "amount_due_eur double, due_date date, event_date date")


def loan(key, when, amount=10.0, status="ON_TIME", kind="SME", country="CI"):
    return (key, country, kind, status, amount, day(when), day(when))


@pytest.fixture(params=[None, {"loan_repayments": ["event_date"]}], ids=["by country and day", "by day"])
def lake(spark, tmp_path, request):
    return Lake(spark, str(tmp_path / "lake"), request.param)


@pytest.fixture
def read_days(monkeypatch):
    """The days whose facts were opened, and the files of what was read."""
    seen, real = [], FactTable.read_on

    def spy(table, column, days):
        rows = real(table, column, days)
        if column == "event_date":
            seen.append((sorted(days), rows.inputFiles()))
        return rows

    monkeypatch.setattr(FactTable, "read_on", spy)
    return seen


def whole(lake, first=None):
    """The stock computed from all facts there are."""
    return as_set(indicators.npl_ratio_by_country(lake.silver("loan_repayments").read(), "event_date", first))


def test_a_refresh_reads_the_days_that_changed(lake, rows, read_days):
    table = lake.silver("loan_repayments")
    table.merge(rows(LOANS, loan("r1", "2026-05-10"), loan("r2", "2026-05-11", 5.0, "DEFAULT"), loan("r3", "2026-04-30", country="SN")))
    assert gold.refresh(lake, "npl_ratio_by_country") == 5
    assert as_set(lake.gold("npl_ratio_by_country").read()) == whole(lake)
    del read_days[:]

    table.merge(rows(LOANS, loan("r4", "2026-05-12", 7.0, "DEFAULT"), loan("r5", "2026-05-12", 1.0, kind="AUTO")))
    assert gold.refresh(lake, "npl_ratio_by_country") == 3
    (days, opened), = read_days
    assert days == [day("2026-05-12")] and opened and all("event_date=2026-05-12" in f for f in opened)
    assert as_set(lake.gold("npl_ratio_by_country").read().filter("period = DATE '2026-05-12'")) == whole(lake, day("2026-05-12"))
    del read_days[:]
    assert gold.refresh(lake, "npl_ratio_by_country") is None and not read_days


def test_late_changed_moved_and_vanished_rows(lake, rows, read_days):
    table = lake.silver("loan_repayments")
    table.merge(rows(LOANS, loan("r1", "2026-05-10"), loan("r2", "2026-05-11"), loan("r3", "2026-03-01"), loan("r0", "2026-01-01")))
    gold.refresh(lake, "npl_ratio_by_country")
    del read_days[:]
    # r1 is in default now, r3 falls due later, r4 comes late, and a new day begins
    table.merge(rows(LOANS, loan("r1", "2026-05-10", status="DEFAULT"), loan("r3", "2026-05-09"), loan("r4", "2026-03-02", 3.0),
                     loan("r5", "2026-05-13")))
    gold.refresh(lake, "npl_ratio_by_country")
    assert read_days[0][0] == [day(f"2026-{d}") for d in ("03-02", "05-09", "05-10", "05-13")]
    assert as_set(lake.gold("npl_ratio_by_country").read().filter("period = DATE '2026-05-13'")) == whole(lake, day("2026-05-13"))
    assert as_set(gold.due_by_day(lake).read()) == as_set(indicators.due_by_day(table.read(), "event_date"))


@pytest.mark.parametrize("dies_in", ["replace_partitions", "write"])
def test_a_refresh_that_died_is_done_again(lake, rows, monkeypatch, dies_in):
    table, kept = lake.silver("loan_repayments"), gold.due_by_day(lake)
    table.merge(rows(LOANS, loan("r1", "2026-05-10"), loan("r2", "2026-05-11")))
    kept.refresh()
    table.merge(rows(LOANS, loan("r1", "2026-05-10", 1.0), loan("r3", "2026-05-11"), loan("r4", "2026-06-01")))
    owner = FactTable if dies_in == "replace_partitions" else SmallTable

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(owner, dies_in, lost)
        with pytest.raises(RuntimeError):
            kept.refresh()
    assert kept.refresh() == [day("2026-05-10"), day("2026-05-11"), day("2026-06-01")]
    assert as_set(kept.read()) == as_set(indicators.due_by_day(table.read(), "event_date"))


def test_days_before_the_first_one_expire(spark, lake, rows):
    counted = KeptDays(lake, "n", "loan_repayments", lambda df: df.groupBy(F.col("event_date").alias("day")).count())
    table = lake.silver("loan_repayments")
    assert counted.refresh(day("2026-01-01")) == []
    table.merge(rows(LOANS, loan("r1", "2026-05-10"), loan("r2", "2026-05-11"), loan("r3", "2026-05-12")))
    assert counted.refresh(day("2026-05-11")) == [day("2026-05-11"), day("2026-05-12")]
    assert counted.refresh(day("2026-05-12")) == []
    assert as_set(counted.read(day("2026-05-12"))) == {(day("2026-05-12"), 1)}
    assert [d for _, d in counted.rows.folders("piece")] == [day("2026-05-12")]
    assert as_set(counted.read()) == {(day("2026-05-12"), 1)}
