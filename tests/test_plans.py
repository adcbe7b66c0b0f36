"""Raw files to report, through the lake."""

import json
import os

import pytest
from conftest import as_set, day

from cowrie.__main__ import arguments, main
from cowrie.model import DATASETS, FACTS
from cowrie.plans import bronze, gold, report, silver
from cowrie.plans.ledger import Ledger
from cowrie.sources import files, raw_files
from cowrie.sources.lake import FactTable, Lake
from cowrie.sources.topics import Channel
from cowrie.streaming import silver as stream_silver

BANK_HEADER = ("transaction_id,timestamp,account_id,beneficiary_account,branch_id,country_code,transaction_type,"
               "amount,currency,channel,transaction_status,fee_amount,entity_type")
MOBILE_HEADER = ("payment_id,timestamp,sender_id,receiver_id,sender_country,receiver_country,amount,currency,"
                 "payment_type,operator,status,fee_amount,entity_type")
LOAN_HEADER = ("repayment_id,timestamp,loan_account_id,customer_id,country_code,amount_due,amount_paid,currency,"
               "due_date,payment_date,days_overdue,loan_type,repayment_status,entity_type")
INSURANCE_HEADER = ("operation_id,timestamp,customer_id,account_id,country_code,operation_type,product_line,amount,"
                    "currency,claim_status,processing_days,entity_type")


def put(root, path, header, *lines):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text("\n".join([header, *lines]) + "\n")


def bank(key, when, amount="1000.0", fee="10.0", account="a1", kind="TRANSFER", country="CI"):
    return f"{key},{when},{account},a2,b1,{country},{kind},{amount},XOF,ATM,SUCCESS,{fee},BANK"


def loan(key, due, amount="655.957", status="ON_TIME", customer="c1"):
    return f"{key},{due} 08:00:00,a1,{customer},CI,{amount},{amount},XOF,{due} 08:00:00,,,SME,{status},MICROFINANCE"


def insurance(key, when, kind, amount="655.957", status="", days=""):
    return f"{key},{when},c1,a1,CI,{kind},IARD_AUTO,{amount},XOF,{status},{days},INSURANCE"


def payment(key, when, sender="CI", receiver="SN", amount="655.957"):
    return f"{key},{when},c1,c2,{sender},{receiver},{amount},XOF,P2P,WALLET,SUCCESS,0.0,MOBILE_MONEY"


def put_references(raw):
    put(raw, "shared/referentials/customers.csv",
        "customer_id,country_code,entity_type,segment,kyc_level,onboarding_date,region,is_active",
        "c1,CI,BANK,SME,BASIC,2020-01-01,Abidjan,True", "c2,SN,BANK,RETAIL,STANDARD,2020-01-01,Dakar,False")
    put(raw, "shared/referentials/accounts.csv",
        "account_id,customer_id,branch_id,country_code,account_type,currency,balance,credit_limit,opened_date,status",
        "a1,c1,b1,CI,CURRENT,XOF,1.0,,2020-01-01,ACTIVE")
    put(raw, "shared/referentials/branches.csv",
        "branch_id,country_code,entity_type,city,region,branch_type,is_active", "b1,CI,BANK,Abidjan,Abidjan,ATM_POINT,True")
    put(raw, "shared/referentials/products.csv", "product_id,entity_type,product_name,is_active", "p1,BANK,Account,True")


@pytest.fixture
def raw(tmp_path):
    return tmp_path / "raw"


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def test_file_patterns():
    dataset = DATASETS["bank_transactions"]
    assert raw_files.file_pattern("/raw/", dataset, ["CI"], day("2026-05-10")) == \
        "/raw/CI/bank_transactions/20260510/bank_txn_CI_20260510_*.csv"
    assert raw_files.file_pattern("/raw", dataset, ["CI", "GH"]) == "/raw/{CI,GH}/bank_transactions/*/*.csv"
    assert raw_files.file_pattern("/raw", DATASETS["accounts"]) == "/raw/shared/referentials/accounts.csv"
    assert raw_files.file_pattern("/raw", dataset) == "/raw/{CI,SN,ML,BF,GN,TG,BJ,GH}/bank_transactions/*/*.csv"


def test_ingest_counts_rejects_and_reads_each_file_once(spark, lake, raw):
    name = "CI/bank_transactions/20260510/bank_txn_CI_20260510_0800.csv"
    put(
        raw, name, BANK_HEADER,
        bank("t1", "2026-05-10 08:00:00"),
        bank("t2", "not a time"),
        bank("t3", "2026-05-10 08:00:00", amount="much"),
        "t4,2026-05-10 08:00:00,a1",
        bank("t5", "2026-05-10 08:00:00") + ",more",
        bank("", "2026-05-10 08:00:00"),
        bank("t1", "2026-05-10 09:00:00"),
    )
    load = bronze.ingest(spark, lake, str(raw), "bank_transactions", ["CI"], day("2026-05-10"))
    assert (load.files, load.rows_handled, load.rows_rejected) == (1, 2, 4)
    assert [r[0] for r in lake.bronze("bank_transactions").read().select("transaction_id").collect()] == ["t1", "t1"]
    again = bronze.ingest(spark, lake, str(raw), "bank_transactions", ["CI"], day("2026-05-10"))
    assert (again.files, again.rows_handled) == (0, 0)
    put(raw, "CI/bank_transactions/20260510/bank_txn_CI_20260510_0900.csv", BANK_HEADER,
        bank("t1", "2026-05-10 10:00:00"), bank("t6", "2026-05-10 10:00:00"))
    later = bronze.ingest(spark, lake, str(raw), "bank_transactions", ["CI"])
    assert (later.files, later.rows_handled) == (1, 2)
    assert lake.bronze("bank_transactions").read().count() == 3


def test_an_integer_column_refuses_decimals(spark, lake, raw):
    put(raw, "CI/insurance_operations/20260510/insurance_ops_CI_20260510_1.csv", INSURANCE_HEADER,
        insurance("o1", "2026-05-10 08:00:00", "CLAIM_PAYMENT", days="6.0"),
        insurance("o2", "2026-05-10 08:00:00", "CLAIM_PAYMENT", days="6"))
    load = bronze.ingest(spark, lake, str(raw), "insurance_operations", ["CI"])
    assert (load.rows_handled, load.rows_rejected) == (1, 1)


def test_all_countries_in_one_load(spark, lake, raw):
    for country in ("CI", "GH"):
        put(raw, f"{country}/mobile_money/20260510/mobile_money_{country}_20260510_1.csv", MOBILE_HEADER,
            payment(f"m-{country}", "2026-05-10 08:00:00", sender=country))
    assert bronze.ingest(spark, lake, str(raw), "mobile_money", ["GH"], day("2026-05-10")).files == 1
    assert bronze.ingest(spark, lake, str(raw), "mobile_money", day=day("2026-05-10")).files == 1
    stored = lake.bronze("mobile_money").read()
    assert as_set(stored.select("payment_id", "country_code")) == {("m-CI", "CI"), ("m-GH", "GH")}


def test_absent_files_are_no_error(spark, lake, raw):
    assert bronze.ingest(spark, lake, str(raw), "mobile_money", ["GH"], day("2026-05-10")).files == 0
    assert lake.bronze("mobile_money").read().isEmpty()


def test_due_dates_with_a_time_part(spark, lake, raw):
    put(raw, "CI/loan_repayments/20260510/loan_repayments_CI_20260510_1.csv", LOAN_HEADER, loan("r1", "2026-05-10"))
    assert bronze.ingest(spark, lake, str(raw), "loan_repayments", ["CI"]).rows_handled == 1
    assert lake.bronze("loan_repayments").read().collect()[0]["due_date"] == day("2026-05-10")


def test_listing_and_coverage(spark, raw):
    put(raw, "CI/mobile_money/20260510/mobile_money_CI_20260510_1.csv", MOBILE_HEADER)
    put(raw, "GH/mobile_money/20260511/mobile_money_GH_20260511_1.csv", MOBILE_HEADER)
    arrived = raw_files.located(raw_files.list_files(spark, f"{raw}/*/*/*/*.csv"))
    expected = raw_files.expected_arrivals(spark, ["CI", "GH"], ["mobile_money"], day("2026-05-10"), day("2026-05-11"))
    assert as_set(raw_files.missing_arrivals(expected, arrived)) == {
        ("CI", "mobile_money", day("2026-05-11")), ("GH", "mobile_money", day("2026-05-10")),
    }


def test_arrival_states(spark, lake, raw):
    def come(country, stamp, number, *lines):
        put(raw, f"{country}/mobile_money/{stamp}/mobile_money_{country}_{stamp}_{number}.csv", MOBILE_HEADER, *lines)

    for stamp in ("20260510", "20260511", "20260512"):
        come("CI", stamp, 1, payment(f"m{stamp}", "2026-05-10 08:00:00"))
    assert bronze.ingest(spark, lake, str(raw), "mobile_money").files == 3
    come("CI", "20260511", 2, payment("m2", "2026-05-11 08:00:00"))
    come("CI", "20260512", 1, payment("m3", "2026-05-12 08:00:00"), payment("m4", "2026-05-12 08:00:00"))
    come("CI", "20260513", 1)
    come("GH", "20260513", 1)
    come("GH", "no-day", 1)
    report = bronze.arrival_report(
        spark, lake, str(raw), ["mobile_money"], day("2026-05-10"), day("2026-05-12"), ["CI", "GH"]
    )
    by_place = {(r["country_code"], r["day"].day): (r["files"], r["unread"], r["state"]) for r in report.collect()}
    assert by_place == {
        ("CI", 10): (1, 0, "READ"), ("CI", 11): (2, 1, "PARTLY_READ"), ("CI", 12): (1, 1, "REDELIVERED"),
        ("CI", 13): (1, 1, "NEW"), ("GH", 10): (0, 0, "MISSING"), ("GH", 11): (0, 0, "MISSING"),
        ("GH", 12): (0, 0, "MISSING"), ("GH", 13): (1, 1, "NEW"),
    }


def test_a_backlog_is_read_in_lots_of_whole_days(spark, lake, raw, monkeypatch):
    monkeypatch.setattr(bronze, "LOT", 2)
    for stamp, number in (("20260510", 1), ("20260510", 2), ("20260510", 3), ("20260511", 1), ("20260512", 1), ("20260513", 1)):
        put(raw, f"CI/mobile_money/{stamp}/mobile_money_CI_{stamp}_{number}.csv", MOBILE_HEADER,
            payment(f"m{stamp}{number}", "2026-05-10 08:00:00"))
    read, real = [], bronze.read_csv
    monkeypatch.setattr(bronze, "read_csv", lambda spark, paths, columns: read.append(len(paths)) or real(spark, paths, columns))
    load = bronze.ingest(spark, lake, str(raw), "mobile_money")
    assert read == [3, 2, 1] and (load.files, load.rows_handled) == (6, 6)
    assert lake.bronze("mobile_money").read().count() == 6
    assert bronze.ingest(spark, lake, str(raw), "mobile_money").files == 0


def test_a_file_delivered_again_under_its_name_is_read_again(spark, lake, raw):
    name = "CI/mobile_money/20260510/mobile_money_CI_20260510_01.csv"
    put(raw, name, MOBILE_HEADER, payment("m1", "2026-05-10 08:00:00"))
    assert bronze.ingest(spark, lake, str(raw), "mobile_money").files == 1
    put(raw, name, MOBILE_HEADER, payment("m1", "2026-05-10 08:00:00"), payment("m2", "2026-05-10 09:00:00"))
    assert bronze.ingest(spark, lake, str(raw), "mobile_money").files == 1
    assert bronze.ingest(spark, lake, str(raw), "mobile_money").files == 0
    assert {r[0] for r in lake.bronze("mobile_money").read().select("payment_id").collect()} == {"m1", "m2"}


def test_silver_takes_all_of_a_bronze_load_that_died(spark, lake, raw, monkeypatch):
    put_references(raw)
    ingest(spark, lake, raw, "customers")
    put(raw, "CI/mobile_money/20260510/mobile_money_CI_20260510_01.csv", MOBILE_HEADER,
        payment("m8", "2026-05-08 08:00:00"), payment("m9", "2026-05-09 08:00:00"))

    def half(table, source):
        table._write(source.filter("payment_id = 'm9'"), "append")
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(FactTable, "_insert", half)
        with pytest.raises(RuntimeError):
            bronze.ingest(spark, lake, str(raw), "mobile_money")
    assert silver.refresh(lake, "mobile_money") == 2
    assert {r[0] for r in lake.silver("mobile_money").read().select("payment_id").collect()} == {"m8", "m9"}
    assert silver.refresh(lake, "mobile_money") is None


def test_gold_takes_all_of_a_silver_merge_that_died(spark, lake, raw, monkeypatch):
    put_references(raw)
    ingest(spark, lake, raw, "customers")
    first = "CI/mobile_money/20260510/mobile_money_CI_20260510_01.csv"
    put(raw, first, MOBILE_HEADER, payment("m1", "2026-05-10 08:00:00"), payment("m2", "2026-05-11 08:00:00"))
    ingest(spark, lake, raw, "mobile_money")
    silver.refresh(lake, "mobile_money")
    put(raw, first, MOBILE_HEADER, payment("m3", "2026-05-10 09:00:00"))
    ingest(spark, lake, raw, "mobile_money")
    real, moved = files.exchange, []

    def once(spark, folder, target):
        if moved:
            raise RuntimeError("driver lost")
        files.remove(spark, target)  # the old rows are gone, the new ones not yet there
        moved.append(target)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(files, "exchange", once)
        with pytest.raises(RuntimeError):
            silver.refresh(lake, "mobile_money", refresh_current=True)
    assert moved and files.exchange is real
    assert gold.refresh(lake, "mobile_money_daily_flow") == 2
    rows = lake.gold("mobile_money_daily_flow").read().select("period", "txn_count").collect()
    assert sorted(r["txn_count"] for r in rows) in ([1, 1], [1, 2])


def ingest(spark, lake, raw, *names):
    for name in names:
        assert bronze.ingest(spark, lake, str(raw), name).rows_handled >= 1


def put_first_days(raw):
    put_references(raw)
    put(raw, "CI/bank_transactions/20260510/bank_txn_CI_20260510_1.csv", BANK_HEADER,
        bank("t1", "2026-05-10 08:00:00", amount="65595.7", fee="655.957"),
        bank("t1", "2026-05-10 09:00:00", amount="131191.4", fee="655.957"),
        bank("t2", "2026-05-10 09:00:00", amount="-5.0"),
        bank("t3", "2026-05-11 09:00:00", amount="65595.7", fee="-1.0", account="a9"))
    put(raw, "CI/loan_repayments/20260510/loan_repayments_CI_20260510_1.csv", LOAN_HEADER,
        loan("r1", "2026-05-10"), loan("r2", "2026-05-11", amount="1311.914", status="DEFAULT"))
    put(raw, "CI/insurance_operations/20260510/insurance_ops_CI_20260510_1.csv", INSURANCE_HEADER,
        insurance("o1", "2026-05-10 08:00:00", "PREMIUM_PAYMENT"),
        insurance("o2", "2026-05-11 08:00:00", "CLAIM_PAYMENT", "1311.914", "PAID", "3"))
    put(raw, "CI/mobile_money/20260510/mobile_money_CI_20260510_1.csv", MOBILE_HEADER,
        payment("m1", "2026-05-10 08:00:00"), payment("m2", "2026-05-11 08:00:00", receiver="CI"))


def test_raw_to_report(spark, lake, raw):
    assert not silver.refresh(lake, "bank_transactions")
    assert not gold.refresh(lake, "npl_ratio_by_country")
    with pytest.raises(LookupError):
        report.publish(lake, day("2026-05-11"))
    put_first_days(raw)
    ingest(spark, lake, raw, *DATASETS)
    assert silver.pending_days(lake, "bank_transactions") == [day("2026-05-10"), day("2026-05-11")]
    for name in FACTS:
        assert silver.refresh(lake, name)
        assert not silver.refresh(lake, name), "a second run finds nothing to do"

    refined = {r["transaction_id"]: r for r in lake.silver("bank_transactions").read().collect()}
    assert set(refined) == {"t1", "t3"}
    assert (refined["t1"]["amount_eur"], refined["t1"]["fee_amount_eur"], refined["t1"]["segment"]) == (200.0, 1.0, "SME")
    assert (refined["t3"]["fee_amount"], refined["t3"]["customer_id"], refined["t3"]["branch_type"]) == (None, None, "ATM_POINT")

    assert gold.new_periods(lake, "cross_border_transfers") == [day("2026-05-04"), day("2026-05-11")]
    for name in gold.INDICATORS:
        assert gold.refresh(lake, name), name
        if name != "cross_border_transfers":  # its last week has no corridor, so it stays pending
            assert not gold.refresh(lake, name), "a second run finds nothing to do"
    first, second, may = day("2026-05-10"), day("2026-05-11"), day("2026-05-01")
    assert as_set(lake.gold("daily_transaction_volume").read()) == {
        (first, "CI", "BANK", "TRANSFER", 1, 200.0), (second, "CI", "BANK", "TRANSFER", 1, 100.0),
    }
    assert as_set(lake.gold("npl_ratio_by_country").read()) == {
        (first, "CI", "SME", 0.0, 0.0, 1.0), (second, "CI", "SME", 0.6667, 2.0, 3.0),
    }
    assert as_set(lake.gold("customer_arpu_monthly").read()) == {(may, "CI", "SME", 4.0, 1), (may, "CI", None, None, 0)}
    assert as_set(lake.gold("loss_ratio_by_product").read()) == {(may, "CI", "IARD_AUTO", 2.0, 1.0, 2.0)}
    assert as_set(lake.gold("claims_processing_time").read()) == {(may, "CI", "IARD_AUTO", 3.0)}
    assert lake.gold("mobile_money_daily_flow").read().count() == 2
    assert as_set(lake.gold("cross_border_transfers").read()) == {(day("2026-05-04"), "CI", "SN", 1, 1.0, 1.0)}

    for _ in range(2):  # publishing again replaces the day
        assert report.publish(lake, second) == 2
    assert lake.report().read().count() == 2
    with open(f"{lake.root}/reports/regulatory_report_20260511.csv") as lines:
        assert lines.read().splitlines() == [
            "report_date,country_code,indicator_type,dimension,value,threshold,breach",
            "2026-05-11,CI,LOSS_RATIO,IARD_AUTO,2.0,0.7,true",
            "2026-05-11,CI,NPL,SME,0.6667,0.05,true",
        ]


def test_next_days_and_replays(spark, lake, raw):
    put_first_days(raw)
    ingest(spark, lake, raw, "customers", "accounts", "branches", "bank_transactions")
    silver.refresh(lake, "bank_transactions")
    gold.refresh(lake, "daily_transaction_volume")
    put(raw, "CI/bank_transactions/20260512/bank_txn_CI_20260512_1.csv", BANK_HEADER,
        bank("t1", "2026-05-12 08:00:00", amount="655.957"),   # a known key: ignored by bronze
        bank("t4", "2026-05-12 08:00:00", amount="655.957"),
        bank("t5", "2026-05-09 08:00:00", amount="655.957"))   # late: behind the mark
    bronze.ingest(spark, lake, str(raw), "bank_transactions", ["CI"], day("2026-05-12"))
    assert silver.refresh(lake, "bank_transactions")
    keys = {r[0] for r in lake.silver("bank_transactions").read().select("transaction_id").collect()}
    assert keys == {"t1", "t3", "t4"}
    assert silver.refresh(lake, "bank_transactions", day("2026-05-09"))
    assert not silver.refresh(lake, "bank_transactions", day("2026-05-08"))
    assert lake.silver("bank_transactions").read().count() == 4
    assert gold.refresh(lake, "daily_transaction_volume")
    periods = {r[0] for r in lake.gold("daily_transaction_volume").read().select("period").collect()}
    assert periods == {day("2026-05-10"), day("2026-05-11"), day("2026-05-12")}


def test_refresh_current_computes_the_open_month_again(spark, lake, raw):
    put_first_days(raw)
    ingest(spark, lake, raw, "customers", "accounts", "insurance_operations")
    silver.refresh(lake, "insurance_operations")
    gold.refresh(lake, "loss_ratio_by_product")
    put(raw, "CI/insurance_operations/20260512/insurance_ops_CI_20260512_1.csv", INSURANCE_HEADER,
        insurance("o3", "2026-05-12 08:00:00", "PREMIUM_PAYMENT"))
    bronze.ingest(spark, lake, str(raw), "insurance_operations", ["CI"], day("2026-05-12"))
    silver.refresh(lake, "insurance_operations")
    assert not gold.refresh(lake, "loss_ratio_by_product"), "strict: the month is known"
    assert gold.refresh(lake, "loss_ratio_by_product", refresh_current=True)
    assert as_set(lake.gold("loss_ratio_by_product").read()) == {(day("2026-05-01"), "CI", "IARD_AUTO", 2.0, 2.0, 1.0)}


def test_job_arguments():
    args = arguments().parse_args(["--lake", "/l", "ingest", "--data-type", "accounts", "--raw", "/r", "--date", "20260510"])
    assert (args.job, args.date) == ("ingest", day("2026-05-10"))
    args = arguments().parse_args(
        ["--lake", "/l", "stream-alerts", "--rule", "aml_threshold", "--checkpoints", "/c", "--options", '{"root": "/t"}',
         "--format", "parquet"]
    )
    assert args.options == {"root": "/t"}
    assert os.path.isabs(args.checkpoints)


def test_jobs_report_arrivals_drift_and_differences(spark, lake, raw, tmp_path, capsys):
    put_references(raw)
    put(raw, "CI/mobile_money/20260510/mobile_money_CI_20260510_1.csv", MOBILE_HEADER,
        payment("m1", "2026-05-10 08:00:00"), payment("m2", "2026-05-10 09:00:00"))
    topics = ["--format", "parquet", "--options", json.dumps({"root": str(tmp_path / "topics")})]

    def job(*args):
        capsys.readouterr()
        main(["--lake", lake.root, *args])
        return capsys.readouterr().out.splitlines()

    span = ["arrivals", "--raw", str(raw), "--data-type", "mobile_money", "--from", "20260510", "--to", "20260510"]
    assert [line.split()[-1] for line in job(*span)] == ["MISSING"] * 2 + ["NEW"] + ["MISSING"] * 5
    for args in (["ingest", "--raw", str(raw), "--data-type", "customers"], ["ingest", "--raw", str(raw), "--data-type", "mobile_money"],
                 ["silver", "--data-type", "mobile_money"], ["gold", "--kpi", "mobile_money_daily_flow"]):
        job(*args)
    assert "NEW" not in " ".join(job(*span))

    channel, dataset = Channel("parquet", {"root": str(tmp_path / "topics")}), DATASETS["mobile_money"]
    message = json.dumps({"payment_id": "m1", "timestamp": "2026-05-10 08:00:00", "sender_country": "CI", "amount": 655.957,
                          "currency": "XOF", "surprise": True})
    channel.write(spark.createDataFrame([(message,)], "value string"), dataset.raw_topic, "w/batch_id=0")
    drift = job("schema", "--data-type", "mobile_money", *topics)
    assert "surprise None boolean 1 NEW" in drift and "status string None 0 MISSING" in drift
    again = job("schema", "--data-type", "mobile_money", *topics, "--since", drift[-1].split("'")[1])
    assert {line.split()[-1] for line in again[:-1]} == {"MISSING"}

    queries = stream_silver.start(spark, "mobile_money", channel, lake.root, str(tmp_path / "c"), {"availableNow": True}, 2)
    for query in queries:
        query.awaitTermination()
    assert job("reconcile", "--data-type", "mobile_money") == ["ONLY_BATCH 1", "SAME 1"]
    kept = {r["job"]: (r["rows_in"], r["rows_out"], r["rejected"]) for r in Ledger(lake).read().collect()}
    assert kept["ingest mobile_money"] == (2, 2, 0) and kept["silver mobile_money"] == (None, 2, None)
    assert kept["gold mobile_money_daily_flow"] == (None, 1, None)
