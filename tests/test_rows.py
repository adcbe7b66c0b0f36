"""Row rules: money, periods, quality, dedup, enrichment."""

import math

import pytest
from conftest import as_set, day, ts
from pyspark.sql import functions as F

from cowrie.functions.money import cents, mean_eur, ratio, sum_eur, sum_native, with_eur
from cowrie.functions.periods import (
    from_day,
    next_period,
    on_day,
    parse_day,
    period_of,
    period_start,
)
from cowrie.model import DATASETS
from cowrie.operators.enrich import enrich
from cowrie.operators.latest import latest_per_key
from cowrie.operators.quality import in_countries, require_rows, usable_amounts, with_country
from cowrie.plans.silver import refined


def test_eur_rates_and_unknown_currency(rows):
    df = rows("amount double, currency string", (655.957, "XOF"), (13.5, "GHS"), (5.0, "USD"), (None, "XOF"), (1.0, None))
    got = [r["amount_eur"] for r in with_eur(df, ["amount"]).collect()]
    assert got == [1.0, 1.0, None, None, None]


def test_eur_rounds_half_up(rows):
    df = rows("amount double, currency string", (1.005, "ONE"), (2.675, "ONE"))
    got = [r["amount_eur"] for r in with_eur(df, ["amount"], rates={"ONE": 1.0}).collect()]
    assert got == [1.01, 2.68]


def test_money_sums_are_exact(rows):
    df = rows("a double", *[(0.1,)] * 10, (None,))
    got = df.agg(sum_eur("a").alias("s"), sum_native("a").alias("n"), mean_eur("a").alias("m")).collect()[0]
    assert tuple(got) == (1.0, 1.0, 0.1)


def test_mean_of_half_a_cent_rounds_up(rows):
    df = rows("a double", (100.0,), (0.01,))
    assert df.agg(mean_eur("a").alias("m")).collect()[0]["m"] == 50.01


def test_no_amount_is_left_out_of_a_sum(rows):
    def sums(*amounts):
        got = rows("a double", *((a,) for a in amounts)).agg(sum_eur("a").alias("e"), sum_native("a").alias("n")).collect()[0]
        return got["e"], got["n"]

    assert sums(1e15, 1e17, 2e16) == (1.21e17, 1.21e17)
    assert sums(2e16, 2e16, 2e16, 2e16, 2e16, -1.5) == (1e17 - 1.5, 1e17 - 1.5)
    assert sums(1e300, 1.0) == (1e300, 1e300)
    assert sums(math.inf, 5.0) == (math.inf, math.inf)
    assert all(math.isnan(x) for x in sums(math.nan, 5.0))
    assert sums(None, None) == (None, None)
    assert sums(0.00001, 0.00001)[1] == 0.00002
    assert rows("a double", (math.nan,)).select(cents("a").alias("c")).collect()[0]["c"] is None


def test_ratio_by_zero_is_null(rows):
    got = rows("n long, d long", (1, 0), (1, 3)).select(ratio(F.col("n"), F.col("d"), 4).alias("r")).collect()
    assert [r["r"] for r in got] == [None, 0.3333]


def test_weeks_start_on_monday_also_across_the_year(rows):
    df = rows(
        "t timestamp", (ts("2026-05-10 23:59:59"),), (ts("2026-05-11 00:00:00"),), (ts("2025-01-01 08:00:00"),)
    )
    got = [r[0] for r in df.select(period_of("t", "week")).collect()]
    assert got == [day("2026-05-04"), day("2026-05-11"), day("2024-12-30")]
    assert period_start(day("2025-01-01"), "week") == day("2024-12-30")


def test_next_period_and_unknown_grain():
    assert next_period(day("2026-12-01"), "month") == day("2027-01-01")
    assert next_period(day("2026-12-28"), "week") == day("2027-01-04")
    assert next_period(day("2026-12-31"), "day") == day("2027-01-01")
    assert parse_day("20260502") == day("2026-05-02")
    with pytest.raises(ValueError):
        period_of("t", "year")


def test_day_ranges_are_half_open(rows):
    df = rows("t timestamp", (ts("2026-05-10 23:59:59.999999"),), (ts("2026-05-11 00:00:00"),), (None,))
    assert on_day(df, "t", day("2026-05-10")).count() == 1
    assert from_day(df, "t", day("2026-05-11")).count() == 1
    assert from_day(df, "t", None).count() == 2


def test_usable_amounts(rows):
    df = rows(
        "k int, amount double, fee double", (1, -1.0, 1.0), (2, 5.0, -1.0), (3, None, 1.0), (4, 0.0, None), (5, 2.0, 0.0)
    )
    assert as_set(usable_amounts(df, ["amount", "fee"])) == {(2, 5.0, None), (4, 0.0, None), (5, 2.0, 0.0)}


def test_country_rules(rows):
    df = rows("sender_country string", ("CI",), ("GH",))
    named = with_country(df, "sender_country")
    assert as_set(named) == {("CI", "CI"), ("GH", "GH")}
    assert in_countries(named, ["GH"]).count() == 1
    assert in_countries(named, []).count() == 2


def test_require_rows(rows):
    with pytest.raises(LookupError):
        require_rows(rows("a int"), "a")


def test_latest_breaks_ties_the_same_way_whatever_the_order(rows):
    a, b, c = (1, ts("2026-01-01 10:00:00"), "x"), (1, ts("2026-01-01 10:00:00"), "y"), (1, None, "z")
    for order in ((a, b, c), (c, b, a)):
        df = rows("k int, t timestamp, v string", *order)
        assert as_set(latest_per_key(df, ["k"], "t")) == {b}


def test_newest_row_decides_even_if_it_is_unusable(rows):
    mobile = DATASETS["mobile_money"]
    df = rows(
        "payment_id string, timestamp timestamp, sender_id string, amount double, fee_amount double, currency string",
        ("p", ts("2026-01-01 10:00:00"), "s", 10.0, 1.0, "XOF"),
        ("p", ts("2026-01-01 11:00:00"), "s", -10.0, 1.0, "XOF"),
        ("q", ts("2026-01-01 10:00:00"), "s", 10.0, -1.0, "XOF"),
        ("r", ts("2026-01-01 10:00:00"), "s", 10.0, 1.0, "XOF"),
        ("r", ts("2026-01-02 10:00:00"), "s", -10.0, 1.0, "XOF"),
        ("t", None, "s", 10.0, 1.0, "XOF"),
    )
    customers = rows("customer_id string, segment string, kyc_level string", ("s", "SME", "BASIC"))
    got = refined(df, mobile, {"customers": customers}, moment="timestamp")
    # p: newest of the day is negative; r: the second day is, the first day's row stays
    assert {(r["payment_id"], r["fee_amount"], r["segment"]) for r in got.collect()} == {
        ("q", None, "SME"), ("r", 1.0, "SME"),
    }


def test_many_days_at_once_equal_day_by_day(spark):
    """600 random rows over 6 days: one plan leaves what daily upserts leave."""
    mobile = DATASETS["mobile_money"]
    facts = spark.range(600).select(
        F.concat(F.lit("k"), (F.rand(7) * 60).cast("int")).alias("payment_id"),
        F.timestamp_seconds(F.lit(1767225600) + (F.rand(8) * 6 * 86400).cast("int")).alias("timestamp"),
        F.lit("s").alias("sender_id"),
        F.round(F.rand(9) * 100 - 40, 2).alias("amount"),
        F.lit(1.0).alias("fee_amount"),
        F.lit("XOF").alias("currency"),
    )
    facts = spark.createDataFrame(facts.collect(), facts.schema)
    customers = spark.createDataFrame([], "customer_id string, segment string, kyc_level string")
    at_once = refined(facts, mobile, {"customers": customers}, moment="timestamp")
    state = {}
    for number in range(6):
        today = on_day(facts, "timestamp", day(f"2026-01-0{number + 1}"))
        one = refined(today, mobile, {"customers": customers}, moment="timestamp", single_day=True)
        state |= {r["payment_id"]: tuple(r) for r in one.collect()}
    assert as_set(at_once) == set(state.values())


ACCOUNTS = "account_id string, customer_id string, account_type string, status string"
CUSTOMERS = "customer_id string, segment string, kyc_level string"


def references(rows):
    return {
        "accounts": rows(ACCOUNTS, ("a1", "c1", "CURRENT", "ACTIVE"), ("a2", "c9", "LOAN", "FROZEN")),
        "customers": rows(CUSTOMERS, ("c1", "SME", "BASIC"), ("c2", "RETAIL", "STANDARD")),
        "branches": rows("branch_id string, branch_type string, region string", ("b1", "ATM_POINT", "r1")),
    }


def test_enrich_through_the_account(rows):
    facts = rows("id int, account_id string, branch_id string", (1, "a1", "b1"), (2, "a2", "b9"), (3, "a9", None), (4, None, "b1"))
    got = enrich(facts, references(rows))
    assert got.columns == [
        "id", "account_id", "branch_id", "customer_id", "account_type", "account_status",
        "segment", "customer_kyc_level", "branch_type", "branch_region",
    ]
    assert {(r["id"], r["customer_id"], r["segment"], r["branch_type"]) for r in got.collect()} == {
        (1, "c1", "SME", "ATM_POINT"), (2, "c9", None, None), (3, None, None, None), (4, None, None, "ATM_POINT"),
    }


def test_enrich_keeps_the_facts_own_customer(rows):
    facts = rows("id int, loan_account_id string, customer_id string", (1, "a1", "c2"))
    got = enrich(facts, {k: v for k, v in references(rows).items() if k != "branches"})
    assert tuple(got.collect()[0]) == (1, "a1", "c2", "CURRENT", "ACTIVE", "RETAIL", "STANDARD")


def test_enrich_needs_a_customer_column(rows):
    with pytest.raises(ValueError):
        enrich(rows("id int"), {"customers": references(rows)["customers"]})


def test_enrich_multiplies_facts_by_repeated_references(rows):
    accounts = rows(ACCOUNTS, ("a1", "c1", "CURRENT", "ACTIVE"), ("a1", "c2", "LOAN", "ACTIVE"))
    facts = rows("id int, account_id string", (1, "a1"))
    got = enrich(facts, {"accounts": accounts, "customers": references(rows)["customers"]})
    assert {(r["customer_id"], r["segment"]) for r in got.collect()} == {("c1", "SME"), ("c2", "RETAIL")}
