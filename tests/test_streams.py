"""Messages, stream silver and alerts: batch rules, then the same rules as streams."""

import json

import pytest
from conftest import as_set, day, ts
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cowrie_checks.stream_queries import first_operations
from cowrie.functions import messages as msg
from cowrie.functions.money import with_eur
from cowrie.model import DATASETS, FRAUD_TOPIC, REJECTED_TOPIC
from cowrie.plans import premiums
from cowrie.plans.ledger import Ledger
from cowrie.sources import files
from cowrie.sources.lake import Lake, SmallTable
from cowrie.sources.raw_files import event_stream
from cowrie.sources.topics import Channel
from cowrie.streaming import alerts
from cowrie.streaming import silver as stream
from cowrie.streaming.sinks import StreamTable, late_rows, run, state_pieces

NOW = {"availableNow": True}
BANK = DATASETS["bank_transactions"]


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def txn(key, when, amount=655.957, currency="XOF", kind="TRANSFER", account="a1", country="CI", **more):
    fields = {"transaction_id": key, "timestamp": when, "account_id": account, "country_code": country,
              "transaction_type": kind, "amount": amount, "currency": currency, **more}
    return json.dumps(fields)


def finish(*queries):
    for query in queries:
        query.awaitTermination()


@pytest.fixture
def channel(tmp_path):
    return Channel("parquet", {"root": str(tmp_path / "topics"), "maxFilesPerTrigger": "1"})


def test_message_validity(spark):
    messages = texts(
        spark, "not json", '{"amount": 5}', '{"transaction_id": 7, "amount": 5}',
        '{"transaction_id": "t", "amount": "much"}', None, "[]",
    )
    parsed = msg.parsed(messages, BANK.message_columns)
    good = {(r["transaction_id"], r["amount"]) for r in msg.accepted(parsed, BANK.key).collect()}
    assert good == {("7", 5.0), ("t", None)}, "a bad field is NULL, the message stays"
    assert {r[0] for r in msg.rejected(parsed, BANK.key).collect()} == {"not json", '{"amount": 5}', None, "[]"}


def test_bytes_are_read_like_text(spark):
    messages = texts(spark, txn("t", "2026-01-01 10:00:00")).select(F.col("value").cast("binary").alias("value"))
    assert msg.accepted(msg.parsed(messages, BANK.message_columns), BANK.key).count() == 1


def test_messages_leave_nulls_out(spark, rows):
    df = rows("a int, b string, t timestamp", (1, None, ts("2026-01-01 10:00:00")))
    assert msg.to_messages(df).collect()[0]["value"] == '{"a":1,"t":"2026-01-01T10:00:00.000Z"}'


def test_sample_schema(spark):
    assert msg.sample_schema(texts(spark, '{"a": 1, "b": "x"}')) == "STRUCT<a: BIGINT, b: STRING>"
    later = texts(spark, '{"a": 1}', "broken", "[1]", None, '{"b": {"c": true}, "a": null}', '{"a": 2}')
    assert msg.sample_schema(later) == "STRUCT<a: BIGINT, b: STRUCT<c: BOOLEAN>>"
    for none in (texts(spark), texts(spark, "broken", "[]", None)):
        with pytest.raises(RuntimeError):
            msg.sample_schema(none)


def test_schema_drift(spark):
    messages = texts(spark, '{"a": 1, "t": "2026-01-01"}', '{"a": 1.5, "b": "x", "new": [1]}', '{"b": 2, "a": null}', "broken")
    got = as_set(msg.schema_drift(messages, "a double, b string, t timestamp, gone string"))
    assert {r for r in got if r[0] != "b"} == {
        ("a", "double", "number", 2, "SAME"), ("t", "timestamp", "string", 1, "SAME"),
        ("gone", "string", None, 0, "MISSING"), ("new", None, "array<bigint>", 1, "NEW"),
    }
    (mixed,) = (r for r in got if r[0] == "b")
    assert mixed[3:] == (2, "RETYPED")


def test_ranges_of_a_topic(spark, tmp_path):
    channel = Channel("parquet", {"root": str(tmp_path)})
    keyed = spark.createDataFrame([("k1", "v1")], "key string, value string")
    assert channel.read(spark, "t").count() == 0 and channel.end(spark, "t") == "{}"
    channel.write(keyed, "t", "w/batch_id=3")
    channel.write(texts(spark, "v2"), "t", "all")
    end = channel.end(spark, "t")
    assert json.loads(end) == {"w": 3, "all": 0}
    for _ in range(2):  # a replayed piece replaces itself
        channel.write(texts(spark, "v3"), "t", "w/batch_id=10")
    keyed.write.parquet(str(tmp_path / "t" / "w" / "batch_id=11" / "half"))  # not complete
    assert as_set(channel.read(spark, "t", until=end)) == {("k1", "v1"), (None, "v2")}
    assert as_set(channel.read(spark, "t", since=end)) == {(None, "v3")}
    assert as_set(channel.read(spark, "t")) == {("k1", "v1"), (None, "v2"), (None, "v3")}
    assert channel.read(spark, "t", end, end).count() == 0
    plain = Channel("text", {"root": str(tmp_path / "plain")})
    plain.write(keyed, "t", "w/batch_id=0")
    assert as_set(plain.read(spark, "t")) == {("v1",)}


def test_topic_as_table(spark):
    table = msg.as_table(texts(spark, txn("t", "2026-01-01 10:00:00", amount_eur=1.0)), msg.SILVER_BANK_TABLE)
    row = table.collect()[0]
    assert (row["event_time"], row["streaming_amount_eur"], row["customer_id"]) == ("2026-01-01 10:00:00", 1.0, None)


def test_bad_event_time_is_null(spark):
    silver = stream.stream_silver(texts(spark, txn("t", "yesterday")), BANK)
    assert silver.collect()[0]["timestamp"] is None


def test_mobile_country_and_eur(spark):
    message = json.dumps({"payment_id": "p", "timestamp": "2026-01-01 10:00:00", "sender_country": "GH",
                          "amount": 13.5, "currency": "GHS", "fee_amount": 1.0})
    row = stream.stream_silver(texts(spark, message), DATASETS["mobile_money"]).collect()[0]
    assert (row["country_code"], row["amount_eur"], row["fee_amount_eur"]) == ("GH", 1.0, 0.07)


def test_stream_dedup_watermark_and_dead_letters(spark, tmp_path, channel):
    """Three pieces, each its own micro-batch: repeats, another time, and rows too late."""
    pieces = [
        [txn("t1", "2026-01-01 10:00:00"), txn("t1", "2026-01-01 10:00:00"), "broken"],
        [txn("t1", "2026-01-01 10:00:00"), txn("t1", "2026-01-01 10:05:00"), txn("t2", "2026-01-01 12:00:00")],
        [txn("t3", "2026-01-01 11:49:59"), txn("t4", "2026-01-01 11:50:01")],
    ]
    checkpoints = str(tmp_path / "checkpoints")
    late = 0
    for number, piece in enumerate(pieces):
        channel.write(texts(spark, *piece).coalesce(1), BANK.raw_topic, f"piece{number}")
        queries = stream.start(spark, BANK.name, channel, str(tmp_path / "lake"), checkpoints, NOW, 2)
        finish(*queries)
        late += late_rows(queries[0])
    table = stream.stream_table(str(tmp_path / "lake"), BANK.name).read(spark)
    got = as_set(table.select("transaction_id", F.date_format("timestamp", "HH:mm:ss")))
    assert got == {("t1", "10:00:00"), ("t1", "10:05:00"), ("t2", "12:00:00"), ("t4", "11:50:01")}
    assert late == 1
    assert channel.read(spark, BANK.silver_topic).count() == 4
    assert [r["value"] for r in channel.read(spark, REJECTED_TOPIC).collect()] == ["broken"]


def test_rows_without_a_time_go_to_the_dead_letters(spark, tmp_path, channel):
    messages = [txn("t1", "yesterday"), txn("t1", "yesterday"), txn("t2", "2026-01-01 10:00:00"), txn("t3", None)]
    channel.write(texts(spark, *messages).coalesce(1), BANK.raw_topic, "p")
    queries = stream.start(spark, BANK.name, channel, str(tmp_path / "lake"), str(tmp_path / "c"), NOW, 2)
    finish(*queries)
    assert {r[0] for r in stream.stream_table(str(tmp_path / "lake"), BANK.name).read(spark).select("transaction_id").collect()} == {"t2"}
    assert sorted(r["value"] for r in channel.read(spark, REJECTED_TOPIC).collect()) == sorted(messages[:2] + messages[3:])
    runs = Ledger(Lake(spark, str(tmp_path / "lake")))
    for _ in range(2):  # nothing is written twice
        runs.stream("silver", queries[0])
    runs.batch("gold", 1.5, rows_in=3, rows_out=2)
    rows = runs.read().filter("rows_in > 0").select("job", "rows_in", "rows_out", "rejected", "late")
    assert as_set(rows) == {("silver", 4, None, 3, 0), ("gold", 3, 2, None, None)}


@pytest.mark.parametrize("alone", [False, True])
@pytest.mark.parametrize("salts", [0, 16])
def test_an_event_that_floods_the_topic(spark, tmp_path, channel, alone, salts):
    """Half of the rows are one event: it is kept once, and no partition of the state gets twice the mean."""
    for piece in range(2):
        hot, many = [txn("hot", "2026-01-01 10:00:00")] * 2000, [txn(f"t{n}", "2026-01-01 10:00:00") for n in range(2000)]
        channel.write(texts(spark, *hot, *many).coalesce(1), BANK.raw_topic, f"p{piece}")
    messages = channel.read_stream(spark, BANK.raw_topic)
    rows = stream.stream_silver(messages, BANK, by_key_alone=alone, salts=salts)
    out = StreamTable(str(tmp_path / "out"), ["country_code"])
    finish(run(rows, out.write_batch, str(tmp_path / "c"), "append", NOW, 4))
    assert out.read(spark).groupBy("transaction_id").count().filter("count > 1").isEmpty()
    assert out.read(spark).count() == 2001
    if salts:
        events = stream.stream_silver(channel.read(spark, BANK.raw_topic), BANK, by_key_alone=alone)
        assert events.count() == 2001
        copies = msg.accepted(msg.parsed(channel.read(spark, BANK.raw_topic), BANK.message_columns), BANK.key)
        dealt = stream.salted(copies).withColumn("t", F.to_timestamp("timestamp"))
        key = ["_salt", "transaction_id"] + ([] if alone else ["t"])
        loads = [r["count"] for r in dealt.groupBy(F.pmod(F.hash(*key), F.lit(4)).alias("p")).count().collect()]
        assert max(loads) <= 2 * sum(loads) / 4
        second = dealt.dropDuplicates(key).groupBy("transaction_id").count()
        assert second.agg(F.max("count")).collect()[0][0] <= 16


def test_dedup_by_key_alone(spark, tmp_path, channel):
    channel.write(texts(spark, txn("t1", "2026-01-01 10:00:00"), txn("t1", "2026-01-01 10:05:00")), BANK.raw_topic, "p")
    rows = stream.stream_silver(channel.read_stream(spark, BANK.raw_topic), BANK, by_key_alone=True)
    out = StreamTable(str(tmp_path / "out"), ["country_code"])
    finish(run(rows, out.write_batch, str(tmp_path / "c"), "append", NOW, 2))
    assert out.read(spark).count() == 1


def test_a_replayed_micro_batch_replaces_itself(spark, tmp_path, rows, channel):
    out = StreamTable(str(tmp_path / "out"), ["country_code"])
    batch = rows("k int, country_code string", (1, "CI"), (2, "GH"))
    for _ in range(2):
        out.write_batch(batch, 0)
        channel.write(msg.to_messages(batch), "topic", "writer/batch_id=0")
    out.write_batch(batch, 1)
    assert out.read(spark).count() == 4
    assert channel.read(spark, "topic").count() == 2


def test_publishing_csv_rows(spark, tmp_path, channel):
    folder = tmp_path / "raw" / "CI" / "mobile_money" / "20260510"
    folder.mkdir(parents=True)
    header = ",".join(DATASETS["mobile_money"].fields)
    (folder / "mobile_money_CI_20260510_1.csv").write_text(
        f"{header}\nm1,2026-05-10 08:00:00,c1,c2,CI,SN,5.0,XOF,P2P,WALLET,SUCCESS,,MOBILE_MONEY\n"
    )
    dataset = DATASETS["mobile_money"]
    for _ in range(2):  # a file is published once
        events = event_stream(spark, f"{tmp_path}/raw/*/mobile_money/*/", dataset.columns)
        finish(stream.start_publisher(events, dataset, channel, str(tmp_path / "c"), NOW))
    message = json.loads(channel.read(spark, dataset.raw_topic).collect()[0]["value"])
    assert channel.read(spark, dataset.raw_topic).count() == 1
    assert (message["payment_id"], message["timestamp"], message["source_file"], "fee_amount" in message) == (
        "m1", "2026-05-10 08:00:00", "mobile_money_CI_20260510_1.csv", False,
    )
    assert message["ingestion_timestamp"]


def test_kafka_is_asked_for_by_name(spark):
    """Without its connector Spark says what is missing; the folders stand in for it here."""
    kafka = Channel("kafka", {"kafka.bootstrap.servers": "broker:9092"})
    for read in (kafka.read, kafka.read_stream):
        with pytest.raises(AnalysisException, match="kafka"):
            read(spark, "topic")


# -- alert rules ------------------------------------------------------------------


def bank_events(spark, *messages):
    return stream.stream_silver(texts(spark, *messages), BANK)


def test_multiple_transactions(spark):
    events = bank_events(
        spark,
        txn("1", "2026-01-01 10:00:30", 300_000.0), txn("2", "2026-01-01 10:04:30", 200_000.0, kind="DEPOSIT"),
        txn("3", "2026-01-01 10:05:30", 0.5),
        txn("4", "2026-01-01 10:00:00", 600_000.0, account="big"),
        txn("5", "2026-01-01 10:00:00", 900_000.0, currency="GHS", account="ghs"),
    )
    got = alerts.multiple_transactions(events)
    by_account = {}
    for row in got.collect():
        by_account.setdefault(row["account_id"], []).append((row["window_start"].minute, row["total_amount_xof"], row["txn_count"]))
    assert "ghs" not in by_account
    assert len(by_account["big"]) == 5, "a single payment over the limit alerts in each window"
    assert "a1" not in by_account, "500 000 exactly is not over the limit, and 500 000.5 spans 5 minutes"


def test_aml_limits(spark):
    events = bank_events(
        spark,
        txn("x1", "2026-01-01 10:00:00", 1_000_000.0), txn("x2", "2026-01-01 10:00:00", 1_000_000.5),
        txn("g1", "2026-01-01 10:00:00", 5_000.5, currency="GHS"), txn("u1", "2026-01-01 10:00:00", 9e9, currency="USD"),
        txn("p1", "2026-01-01 10:00:00", 9e9, kind="PAYMENT"),
    )
    got = alerts.aml_threshold(events)
    assert {r["transaction_id"] for r in got.collect()} == {"x2", "g1"}
    assert got.columns == ["alert_type", "transaction_id", "account_id", "beneficiary_account", "country_code",
                           "amount", "currency", "timestamp"]


def test_liquidity_floors(spark):
    events = bank_events(
        spark,
        txn("1", "2026-01-01 10:00:00", 60_000_000.0), txn("2", "2026-01-01 11:00:00", 9_000_000.0, kind="DEPOSIT"),
        txn("3", "2026-01-02 00:00:00", 50_000_000.0),
        txn("4", "2026-01-01 10:00:00", 1_000_001.0, currency="GHS", country="GH"),
    )
    got = {(r["country_code"], r["window_start"].day, r["net_balance"], r["min_threshold"])
           for r in alerts.liquidity_breach(events).collect()}
    assert got == {("CI", 1, -51_000_000.0, -50_000_000.0), ("GH", 1, -1_000_001.0, -1_000_000.0)}


def test_unusual_country(rows):
    payments = rows(
        "payment_id string, sender_id string, sender_country string, amount double, currency string",
        ("1", "c1", "CI", 1.0, "XOF"), ("2", "c1", "SN", 1.0, "XOF"), ("3", "c9", "SN", 1.0, "XOF"), ("4", "c2", "SN", 1.0, "XOF"),
    )
    customers = rows("customer_id string, country_code string", ("c1", "CI"), ("c2", None))
    assert {r["payment_id"] for r in alerts.unusual_country(payments, customers).collect()} == {"2"}


def test_claims_over_premiums(rows):
    ddl = ("operation_id string, customer_id string, country_code string, operation_type string, claim_status string, "
           "amount_eur double, timestamp timestamp")
    today = day("2026-07-01")
    history = rows(
        ddl,
        ("h1", "c1", "CI", "PREMIUM_PAYMENT", None, 10.0, ts("2025-07-01 00:00:00")),
        ("h2", "c1", "CI", "PREMIUM_PAYMENT", None, 90.0, ts("2025-06-30 23:59:59")),
        ("h3", "c2", "CI", "PREMIUM_PAYMENT", None, 10.0, ts("2026-06-30 00:00:00")),
    )
    claims = rows(
        ddl,
        ("1", "c1", "CI", "CLAIM_PAYMENT", "PAID", 30.0, ts("2026-07-01 00:00:00")),
        ("2", "c1", "CI", "CLAIM_PAYMENT", "PAID", 30.01, ts("2026-07-01 00:00:00")),
        ("3", "c2", "CI", "CLAIM_PAYMENT", "PENDING", 99.0, ts("2026-07-01 00:00:00")),
        ("4", "c3", "CI", "CLAIM_PAYMENT", "PAID", 99.0, ts("2026-07-01 00:00:00")),
    )
    got = alerts.claim_over_premiums(claims, history, today)
    assert {(r["operation_id"], r["annual_premium_eur"]) for r in got.collect()} == {("2", 10.0)}


def test_claims_meet_kept_premiums(spark, rows, tmp_path):
    """Totals follow late, changed and expired premiums; a micro-batch opens no facts."""
    ddl = ("operation_id string, customer_id string, country_code string, operation_type string, claim_status string, "
           "amount_eur double, event_date date")

    def premium(key, customer, amount, when):
        return (key, customer, "CI", "PREMIUM_PAYMENT", None, amount, day(when))

    def claim(key, customer, amount):
        return (key, customer, "CI", "CLAIM_PAYMENT", "PAID", amount, day("2026-07-01"))

    lake, today = Lake(spark, str(tmp_path / "lake")), day("2026-07-01")
    operations = lake.silver("insurance_operations")
    batch = rows(ddl, claim("1", "c1", 30.0), claim("2", "c1", 30.01), claim("3", "c2", 31.0), claim("4", None, 5.0))

    def alerted(now=today):
        totals = premiums.loader(lake, lambda: now)("gold", "premium_totals")
        got = alerts.claims_over_totals(batch, totals)
        assert not any("silver" in f for f in got.inputFiles())
        return {(r["operation_id"], r["annual_premium_eur"]) for r in got.collect()}

    assert alerted() == set()
    operations.merge(rows(
        ddl, premium("h1", "c1", 10.0, "2025-07-01"), premium("h2", "c1", 90.0, "2025-06-30"),
        premium("h3", "c2", 10.0, "2026-06-30"), premium("h4", None, 1.0, "2026-06-30"), claim("h5", "c2", 9.0),
    ))
    assert premiums.refresh(lake, today) == [day("2025-07-01"), day("2026-06-30"), today]
    assert alerted() == {("2", 10.0), ("3", 10.0)}
    assert premiums.refresh(lake, today) == []
    operations.merge(rows(ddl, premium("h6", "c2", 2.5, "2026-06-30"), premium("h3", "c2", 0.5, "2026-06-01")))
    assert premiums.refresh(lake, today) == [day("2026-06-01"), day("2026-06-30")]
    assert alerted() == {("2", 10.0), ("3", 3.0)}
    tomorrow = day("2026-07-02")  # the first premium has expired, nobody has refreshed
    assert alerted(tomorrow) == {("3", 3.0)}
    assert alerted(day("2026-07-03")) == {("3", 3.0)}
    assert sorted(p.name for p in (tmp_path / "lake/gold/premium_totals").iterdir()) == ["2026-07-02", "2026-07-03"]


def test_claims_read_the_folders_of_their_customers(spark, rows, tmp_path):
    totals = SmallTable(spark, str(tmp_path / "t"), [alerts.BUCKET])
    sums = spark.range(5000).select(F.concat(F.lit("c"), "id").alias("customer_id"), F.lit(1.0).alias("annual_premium_eur"))
    totals.write(sums.withColumn(alerts.BUCKET, alerts.bucket_of("customer_id")))
    batch = rows(
        "operation_id string, customer_id string, country_code string, operation_type string, claim_status string, amount_eur double",
        ("1", "c7", "CI", "CLAIM_PAYMENT", "PAID", 4.0),
    ).persist()
    batch.count()
    got = alerts.claims_over_totals(batch, totals.read())
    assert [r["operation_id"] for r in got.collect()] == ["1"]
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()


def test_update_mode_repeats_a_window_when_its_sum_changes(spark, tmp_path, channel):
    silver_topic = BANK.silver_topic
    sent = []
    for number, amount in enumerate((600_000.0, 100_000.0)):
        messages = texts(spark, txn(f"t{number}", "2026-01-01 10:00:00", amount))
        channel.write(messages.coalesce(1), silver_topic, f"piece{number}")
        finish(alerts.start(spark, "fraud_multiple_txn", channel, None, str(tmp_path / "c"), NOW, state_partitions=2))
        sent.append(channel.read(spark, FRAUD_TOPIC).count())
    assert sent == [5, 10]
    alert = json.loads(channel.read(spark, FRAUD_TOPIC).collect()[0]["value"])
    assert alert["alert_type"] == "MULTIPLE_TRANSACTIONS_THRESHOLD" and alert["detected_at"]


def test_stream_rules_read_their_tables_anew_each_batch(spark, tmp_path, channel, rows):
    lake = Lake(spark, str(tmp_path / "lake"))
    mobile = DATASETS["mobile_money"]
    customers = "customer_id string, country_code string"

    def send(number):
        fields = {"payment_id": f"p{number}", "timestamp": "2026-01-01 10:00:00", "sender_id": f"c{number}",
                  "sender_country": "GH", "amount": 1.0, "currency": "GHS"}
        channel.write(texts(spark, json.dumps(fields)), mobile.silver_topic, f"piece{number}")
        lake.bronze("customers").append(rows(customers, (f"c{number}", "CI")))
        finish(alerts.start(spark, "fraud_unusual_country", channel, lake.load, str(tmp_path / "c"), NOW))

    send(1)
    send(2)
    sent = [json.loads(r["value"])["payment_id"] for r in channel.read(spark, FRAUD_TOPIC).collect()]
    assert sorted(sent) == ["p1", "p2"]


def test_stream_equals_batch(spark, tmp_path, channel):
    """The same events in many pieces give the batch result, folded to the last value per window."""
    events = spark.range(300).select(
        F.concat(F.lit("t"), "id").alias("transaction_id"),
        F.date_format(F.timestamp_seconds(1767225600 + F.col("id") * 7), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.concat(F.lit("a"), F.col("id") % 5).alias("account_id"), F.lit("CI").alias("country_code"),
        F.lit("PAYMENT").alias("transaction_type"), (F.col("id") * 500.25).alias("amount"), F.lit("XOF").alias("currency"),
    )
    events = events.orderBy("timestamp")
    for number in range(3):
        part = events.filter(F.col("transaction_id").substr(2, 9).cast("int").between(number * 100, number * 100 + 99))
        channel.write(msg.to_messages(part).coalesce(1), BANK.silver_topic, f"piece{number}")
    batch = alerts.multiple_transactions(with_eur(events.withColumn("timestamp", msg.event_time("timestamp")), ["amount"]))
    finish(alerts.start(spark, "fraud_multiple_txn", channel, None, str(tmp_path / "c"), NOW, state_partitions=2))
    columns = "window_start timestamp, account_id string, total_amount_xof double, txn_count long"
    sent = msg.parsed(channel.read(spark, FRAUD_TOPIC), columns).select("data.*")
    last = sent.groupBy("window_start", "account_id").agg(F.max("total_amount_xof"), F.max("txn_count"))
    assert as_set(last) == as_set(batch.select("window_start", "account_id", "total_amount_xof", "txn_count"))
    assert batch.count() > 0


def test_an_unfinished_batch_is_not_read_until_it_is_replayed(spark, rows, tmp_path):
    out = StreamTable(str(tmp_path / "t"), ["country_code"])
    out.write_batch(rows("k int, country_code string", (1, "CI"), (2, "SN")), 0)
    late = rows("k int, country_code string", (3, "CI"))
    late.write.parquet(str(tmp_path / "t" / "country_code=CI" / "batch_id=1"))  # the writer died before its mark
    assert sorted(r["k"] for r in out.read(spark).collect()) == [1, 2]
    for _ in range(2):
        out.write_batch(rows("k int, country_code string", (3, "CI"), (4, None)), 1)
        assert sorted(r["k"] for r in out.read(spark).collect()) == [1, 2, 3, 4]
    assert out.read(spark).columns == ["k", "country_code"]


def test_pieces_of_state_grow_with_the_topic(spark, channel):
    cores = spark.sparkContext.defaultParallelism
    folder = channel.folder("grown")
    assert state_pieces(spark, folder) == cores
    channel.write(texts(spark, *(txn(str(k), "2026-05-10T08:00:00Z") for k in range(200))), "grown", "all")
    size = files.size(spark, folder)
    assert size > 0 and state_pieces(spark, folder) == cores
    assert state_pieces(spark, folder, size // (4 * cores)) >= 4 * cores


def test_first_operations_are_found_by_time_and_move_without_its_text(rows):
    df = rows(
        "operation_id long, event_ts timestamp, amount double, product_line string",
        (1, ts("2026-05-01 10:00:00"), 5.0, "a"), (1, ts("2026-05-01 10:00:00"), 3.0, "b"),
        (1, ts("2026-05-01 10:00:00.000001"), 9.0, "c"), (2, None, 4.0, "d"), (2, None, 1.0, "e"),
    )
    first = first_operations(df)
    assert as_set(first.select("operation_id", "timestamp", "amount", "product_line")) == {
        (1, "2026-05-01 10:00:00.000000", 3.0, "b"), (1, "2026-05-01 10:00:00.000001", 9.0, "c"), (2, None, 1.0, "e"),
    }
    plan = first._jdf.queryExecution().optimizedPlan().toString()
    assert "date_format" in plan.partition("Window")[0] and "date_format" not in plan.partition("Window")[2]


def test_idle_pieces_of_state_leave_room_in_their_common_bound(spark):
    """Half of 500 MB by default: the last buffers of some 60 pieces fit in, of which all but a few are idle."""
    text = "spark.sql.streaming.stateStore.rocksdb."
    assert spark.conf.get(text + "boundedMemoryUsage") == "true"
    assert 60 * int(spark.conf.get(text + "writeBufferSizeMB")) <= 250
