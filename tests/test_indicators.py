"""The seven indicators, the report and the reconciliation on hand-written rows."""

import pytest
from conftest import as_set, day, ts
from pyspark.sql import functions as F

from cowrie.operators import indicators as kpi
from cowrie.operators.reconcile import reconcile
from cowrie.operators.regulatory import breaches, checked_report, report_lines

LOANS = "due_date date, country_code string, loan_type string, repayment_status string, amount_due_eur double"


def naive_stock(facts, days):
    """The definition: for each day, everything due up to it."""
    result = set()
    for d in days:
        groups = {}
        for due, country, kind, status, amount in facts:
            if due is not None and due <= d:
                bad, total = groups.get((country, kind), (0, 0))
                c = round(amount * 100)
                groups[country, kind] = (bad + (c if status == "DEFAULT" else 0), total + c)
        for (country, kind), (bad, total) in groups.items():
            result.add((d, country, kind, round(bad / total, 4), bad / 100, total / 100))
    return result


FACTS = [
    (day("2026-01-01"), "CI", "SME", "DEFAULT", 10.0),
    (day("2026-01-01"), "CI", "SME", "ON_TIME", 30.0),
    (day("2026-01-03"), "CI", "SME", "LATE", 40.25),
    (day("2026-01-03"), "SN", None, "ON_TIME", 5.0),
    (day("2026-01-07"), None, "SME", "DEFAULT", 7.5),
    (day("2026-01-09"), "SN", None, "DEFAULT", 1.1),
    (None, "CI", "SME", "DEFAULT", 99.0),
]
DAYS = [day(f"2026-01-0{n}") for n in (1, 3, 7, 9)]


def test_stock_equals_the_definition(rows):
    assert as_set(kpi.npl_ratio_by_country(rows(LOANS, *FACTS))) == naive_stock(FACTS, DAYS)


def test_stock_from_a_day_on(rows):
    got = kpi.npl_ratio_by_country(rows(LOANS, *FACTS), first=day("2026-01-04"))
    assert as_set(got) == naive_stock(FACTS, DAYS[2:])


def test_stock_of_given_periods_with_and_without_rows(rows):
    wanted = [day("2026-01-05"), day("2026-02-01")]
    got = kpi.npl_ratio_by_country(rows(LOANS, *FACTS), periods=rows("period date", *[(d,) for d in wanted]))
    assert as_set(got) == naive_stock(FACTS, wanted)


def test_stock_without_known_amount_or_status(rows):
    got = kpi.npl_ratio_by_country(
        rows(LOANS, (DAYS[0], "CI", "SME", None, 4.0), (DAYS[0], "SN", "SME", "DEFAULT", None))
    )
    assert as_set(got) == {(DAYS[0], "CI", "SME", 0.0, 0.0, 4.0), (DAYS[0], "SN", "SME", None, None, None)}


def test_daily_volume_counts_every_status(rows):
    df = rows(
        "timestamp timestamp, country_code string, entity_type string, transaction_type string, "
        "amount_eur double, transaction_status string",
        (ts("2026-01-01 00:00:00"), "CI", "BANK", "TRANSFER", 1.1, "FAILED"),
        (ts("2026-01-01 23:59:59"), "CI", "BANK", "TRANSFER", 2.2, "SUCCESS"),
        (ts("2026-01-02 00:00:00"), "CI", "BANK", "TRANSFER", None, "SUCCESS"),
        (None, "CI", "BANK", "TRANSFER", 1.0, "SUCCESS"),
    )
    assert as_set(kpi.daily_transaction_volume(df)) == {
        (day("2026-01-01"), "CI", "BANK", "TRANSFER", 2, 3.3),
        (day("2026-01-02"), "CI", "BANK", "TRANSFER", 1, None),
    }


BANK = "timestamp timestamp, country_code string, segment string, customer_id string, fee_amount_eur double"
PAID = "due_date date, country_code string, segment string, customer_id string, amount_paid_eur double"


def test_arpu(rows):
    bank = rows(
        BANK,
        (ts("2026-01-05 10:00:00"), "CI", "SME", "c1", 1.0),
        (ts("2026-01-06 10:00:00"), "CI", "SME", "c1", None),
        (ts("2026-01-06 10:00:00"), "CI", None, "c2", 2.0),
        (ts("2026-01-06 10:00:00"), "CI", "PREMIUM", None, 5.0),
    )
    loans = rows(
        PAID,
        (day("2026-01-31"), "CI", "SME", "c1", 10.0),
        (day("2026-01-31"), "CI", "SME", "c3", 4.0),
        (day("2026-01-31"), "CI", None, "c2", 4.0),
        (day("2026-02-01"), "CI", "SME", "c1", 10.0),  # a month without bank rows
    )
    january = day("2026-01-01")
    assert as_set(kpi.customer_arpu_monthly(bank, loans)) == {
        (january, "CI", "SME", 7.5, 2), (january, "CI", None, 6.0, 1), (january, "CI", "PREMIUM", None, 0),
    }


OPERATIONS = (
    "timestamp timestamp, country_code string, product_line string, operation_type string, "
    "claim_status string, amount_eur double"
)


def test_loss_ratio(rows):
    when, month = ts("2026-01-05 10:00:00"), day("2026-01-01")
    df = rows(
        OPERATIONS,
        (when, "CI", "AUTO", "CLAIM_PAYMENT", "PAID", 50.0),
        (when, "CI", "AUTO", "CLAIM_PAYMENT", "PENDING", 50.0),
        (when, "CI", "AUTO", "PREMIUM_PAYMENT", None, 100.0),
        (when, "CI", "LIFE", "CLAIM_PAYMENT", "PAID", 50.0),
        (when, "SN", "LIFE", "PREMIUM_PAYMENT", None, 9.0),
        (when, "ML", "LIFE", "POLICY_RENEWAL", None, 9.0),
        (when, "BF", "LIFE", "PREMIUM_PAYMENT", None, 0.0),
        (when, "CI", None, "CLAIM_PAYMENT", "PAID", 3.0),
        (when, "CI", None, "PREMIUM_PAYMENT", None, 4.0),
    )
    assert as_set(kpi.loss_ratio_by_product(df)) == {
        (month, "CI", "AUTO", 50.0, 100.0, 0.5),
        (month, "CI", "LIFE", 50.0, 0.0, None),
        (month, "SN", "LIFE", 0.0, 9.0, 0.0),
        (month, "BF", "LIFE", 0.0, 0.0, None),
        (month, "CI", None, 3.0, 0.0, None),  # unknown products do not meet
        (month, "CI", None, 0.0, 4.0, 0.0),
    }


def test_processing_time(rows):
    when = ts("2026-01-05 10:00:00")
    df = rows(
        "timestamp timestamp, country_code string, product_line string, processing_days int",
        (when, "CI", "AUTO", 1), (when, "CI", "AUTO", 2), (when, "CI", "AUTO", None), (when, "SN", "AUTO", None),
    )
    assert as_set(kpi.claims_processing_time(df)) == {(day("2026-01-01"), "CI", "AUTO", 1.5)}


def test_mobile_flow_and_corridors(rows):
    df = rows(
        "timestamp timestamp, country_code string, sender_country string, receiver_country string, "
        "sender_id string, status string, amount_eur double",
        (ts("2026-05-10 23:59:59"), "CI", "CI", "SN", "s1", "FAILED", 1.0),
        (ts("2026-05-10 00:00:00"), "CI", "CI", "SN", "s1", "SUCCESS", 2.0),
        (ts("2026-05-10 00:00:00"), "CI", "CI", "SN", "s2", None, 3.0),
        (ts("2026-05-11 00:00:00"), "CI", "CI", "SN", "s2", "PENDING", 4.0),
        (ts("2026-05-11 00:00:00"), "CI", "CI", "GH", "s2", "SUCCESS", 4.0),
        (ts("2026-05-11 00:00:00"), "CI", "CI", "CI", "s2", "SUCCESS", 4.0),
    )
    assert as_set(kpi.mobile_money_daily_flow(df)) == {
        (day("2026-05-10"), "CI", 3, 6.0, 0.3333, 2), (day("2026-05-11"), "CI", 3, 12.0, 0.0, 1),
    }
    assert as_set(kpi.cross_border_transfers(df)) == {
        (day("2026-05-04"), "CI", "SN", 3, 2.0, 6.0), (day("2026-05-11"), "CI", "SN", 1, 4.0, 4.0),
    }


NPL = "period date, country_code string, loan_type string, npl_ratio double"
LOSS = "period date, country_code string, product_line string, loss_ratio double"


def test_report_limits_and_guards(rows):
    today, month = day("2026-05-10"), day("2026-05-01")
    npl = rows(NPL, (today, "CI", "SME", 0.05), (today, "SN", "SME", 0.0499), (month, "CI", "SME", 1.0))
    loss = rows(LOSS, (month, "CI", "AUTO", 0.70), (month, "CI", "LIFE", 0.7001), (month, "SN", "LIFE", None))
    report = checked_report(npl, loss, today)
    assert {tuple(r)[1:] for r in report.collect()} == {
        ("CI", "NPL", "SME", 0.05, 0.05, True), ("SN", "NPL", "SME", 0.0499, 0.05, False),
        ("CI", "LOSS_RATIO", "AUTO", 0.70, 0.70, False), ("CI", "LOSS_RATIO", "LIFE", 0.7001, 0.70, True),
        ("SN", "LOSS_RATIO", "LIFE", None, 0.70, None),
    }
    assert as_set(breaches(report)) == {(today, 2)}
    with pytest.raises(LookupError, match="default ratios"):
        checked_report(npl, loss, day("2026-05-11"))
    with pytest.raises(LookupError, match="loss ratios"):
        checked_report(npl.withColumn("period", F.date_add("period", 30)), loss, day("2026-06-09"))
    assert report_lines(npl, loss, day("2027-01-01")).count() == 0


def test_reconcile(rows):
    batch = rows("id string, amount_eur double", ("a", 1.0), ("b", 2.0), ("c", 3.0), ("e", None))
    stream = rows("id string, amount_eur double", ("a", 1.0), ("b", 2.5), ("d", 4.0), ("c", 3.0), ("c", 3.0), ("e", None))
    got = {r["id"]: (r["outcome"], r["difference_eur"]) for r in reconcile(batch, stream, "id").collect()}
    assert got == {
        "a": ("SAME", 0.0), "b": ("DIFFERENT", 0.5), "c": ("DIFFERENT", 3.0),
        "d": ("ONLY_STREAM", None), "e": ("SAME", None),
    }
