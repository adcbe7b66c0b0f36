"""Alert rules over silver events; each is one function for batch and stream."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cowrie.functions.messages import accepted, event_time, parsed, to_messages
from cowrie.functions.money import sum_eur, sum_native
from cowrie.functions.periods import from_day
from cowrie.model import (
    AML_LIMITS,
    AML_TOPIC,
    BURST_LIMIT_XOF,
    BURST_SLIDE,
    BURST_WATERMARK,
    BURST_WINDOW,
    CLAIM_TO_PREMIUM_LIMIT,
    DATASETS,
    FRAUD_TOPIC,
    LIQUIDITY_DEFAULT_FLOOR,
    LIQUIDITY_FLOORS,
    LIQUIDITY_TOPIC,
    LIQUIDITY_WATERMARK,
    PREMIUM_DAYS,
)
from cowrie.operators.indicators import is_premium, is_settled_claim
from cowrie.sources.topics import Channel
from cowrie.streaming.sinks import run

#: The kept sums of premiums and the folders they are cut into.
PREMIUM_TOTALS, BUCKET, PREMIUM_BUCKETS = "premium_totals", "bucket", 64


def _alert(kind: str, rows: DataFrame, *columns: Column | str) -> DataFrame:
    return rows.select(F.lit(kind).alias("alert_type"), *columns)


def _window_bounds() -> tuple[Column, Column]:
    return F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")


def _watermarked(events: DataFrame, moment: str, delay: str) -> DataFrame:
    return events.withWatermark(moment, delay) if events.isStreaming else events


def multiple_transactions(
    bank: DataFrame, moment: str = "timestamp", limit: float = BURST_LIMIT_XOF
) -> DataFrame:
    """Accounts that move more than the limit within a sliding window.

    A single large transaction counts, and each window that holds the sum alerts.
    """
    xof = _watermarked(bank.filter(F.col("currency") == "XOF"), moment, BURST_WATERMARK)
    sums = xof.groupBy(F.window(moment, BURST_WINDOW, BURST_SLIDE), "account_id", "country_code").agg(
        sum_native("amount").alias("total_amount_xof"), F.count("*").alias("txn_count")
    )
    return _alert(
        "MULTIPLE_TRANSACTIONS_THRESHOLD",
        sums.filter(F.col("total_amount_xof") > limit),
        *_window_bounds(),
        "account_id",
        "country_code",
        "total_amount_xof",
        "txn_count",
    )


def unusual_country(payments: DataFrame, customers: DataFrame) -> DataFrame:
    """Payments sent from a country other than the sender's registered one."""
    registered = customers.select(
        F.col("customer_id").alias("_customer"), F.col("country_code").alias("registered_country")
    )
    known = payments.join(registered, payments["sender_id"] == registered["_customer"], "inner")
    return _alert(
        "UNUSUAL_COUNTRY_MOBILE_MONEY",
        known.filter(F.col("sender_country") != F.col("registered_country")),
        "payment_id",
        "sender_id",
        "sender_country",
        "registered_country",
        "amount",
        "currency",
    )


def recent_premiums(operations: DataFrame, today: dt.date, moment: str = "timestamp") -> DataFrame:
    """Premiums per customer over the year before ``today``."""
    recent = from_day(operations, moment, today - dt.timedelta(days=PREMIUM_DAYS))
    return (
        recent.filter(is_premium())
        .groupBy("customer_id")
        .agg(sum_eur("amount_eur").alias("annual_premium_eur"))
    )


def claim_over_premiums(
    operations: DataFrame, history: DataFrame, today: dt.date, moment: str = "timestamp"
) -> DataFrame:
    """Settled claims above three times the customer's premiums of the last year."""
    claims = operations.filter(is_settled_claim())
    premiums = recent_premiums(history, today, moment).withColumnRenamed("customer_id", "_customer")
    known = claims.join(premiums, claims["customer_id"] == premiums["_customer"], "inner")
    return _claim_alerts(known)


def _claim_alerts(known: DataFrame) -> DataFrame:
    over = F.col("amount_eur") > CLAIM_TO_PREMIUM_LIMIT * F.col("annual_premium_eur")
    return _alert(
        "CLAIM_EXCEEDS_PREMIUM_RATIO",
        known.filter(over),
        "operation_id",
        "customer_id",
        "country_code",
        F.col("amount_eur").alias("claim_amount_eur"),
        "annual_premium_eur",
    )


def bucket_of(customer: str) -> Column:
    return F.pmod(F.xxhash64(F.col(customer).cast("string")), F.lit(PREMIUM_BUCKETS)).cast("int")


def claims_over_totals(operations: DataFrame, totals: DataFrame) -> DataFrame:
    """The rule for one micro-batch, against totals of the year cut by ``bucket_of`` the customer.

    Buckets are compared too, so that Spark reads the folders of the claimants alone.
    """
    claims = operations.filter(is_settled_claim()).withColumn("_bucket", bucket_of("customer_id"))
    sums = totals.select(F.col("customer_id").alias("_customer"), "annual_premium_eur", BUCKET)
    known = claims.join(
        sums, (claims["_bucket"] == sums[BUCKET]) & (claims["customer_id"] == sums["_customer"]), "inner"
    )
    return _claim_alerts(known)


def aml_threshold(
    bank: DataFrame, moment: str = "timestamp", limits: Mapping[str, float] = AML_LIMITS
) -> DataFrame:
    """Transfers above the declaration limit of their currency."""
    above = F.lit(False)
    for currency, limit in limits.items():
        above = above | ((F.col("currency") == currency) & (F.col("amount") > limit))
    counterpart = ["beneficiary_account"] if "beneficiary_account" in bank.columns else []
    return _alert(
        "AML_DECLARATIVE_THRESHOLD",
        bank.filter((F.col("transaction_type") == "TRANSFER") & above),
        "transaction_id",
        "account_id",
        *counterpart,
        "country_code",
        "amount",
        "currency",
        F.col(moment).alias("timestamp"),
    )


def liquidity_breach(
    bank: DataFrame,
    moment: str = "timestamp",
    floors: Mapping[str, float] = LIQUIDITY_FLOORS,
    default_floor: float = LIQUIDITY_DEFAULT_FLOOR,
) -> DataFrame:
    """Days on which a country's deposits less everything else end below the floor."""
    amount, incoming = F.col("amount"), F.col("transaction_type") == "DEPOSIT"
    signed = bank.withColumn("signed", F.when(incoming, amount).otherwise(-amount))
    balances = (
        _watermarked(signed, moment, LIQUIDITY_WATERMARK)
        .groupBy(F.window(moment, "1 day"), "country_code", "currency")
        .agg(sum_native("signed").alias("net_balance"))
    )
    of_currency = [F.when(F.col("currency") == c, F.lit(v)) for c, v in floors.items()]
    floor = F.coalesce(*of_currency, F.lit(default_floor))
    with_floor = balances.withColumn("min_threshold", floor)
    return _alert(
        "LIQUIDITY_COVERAGE_BREACH",
        with_floor.filter(F.col("net_balance") < F.col("min_threshold")),
        *_window_bounds(),
        "country_code",
        "currency",
        "net_balance",
        "min_threshold",
    )


def detected(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("detected_at", F.current_timestamp())


@dataclass(frozen=True)
class Rule:
    """A rule's source and topic; ``per_batch`` rules join tables read anew each batch.

    ``check`` takes the events, a function that loads a lake table by layer and
    name, and the present day.
    """

    dataset: str
    topic: str
    check: Callable[[DataFrame, Callable[[str, str], DataFrame], dt.date], DataFrame]
    per_batch: bool = False


RULES = {
    "fraud_multiple_txn": Rule(
        "bank_transactions", FRAUD_TOPIC, lambda events, load, today: multiple_transactions(events)
    ),
    "fraud_unusual_country": Rule(
        "mobile_money",
        FRAUD_TOPIC,
        lambda events, load, today: unusual_country(events, load("bronze", "customers")),
        per_batch=True,
    ),
    "fraud_claim_ratio": Rule(
        "insurance_operations",
        FRAUD_TOPIC,
        lambda events, load, today: claims_over_totals(events, load("gold", PREMIUM_TOTALS)),
        per_batch=True,
    ),
    "aml_threshold": Rule("bank_transactions", AML_TOPIC, lambda events, load, today: aml_threshold(events)),
    "liquidity_alerts": Rule(
        "bank_transactions", LIQUIDITY_TOPIC, lambda events, load, today: liquidity_breach(events)
    ),
}


def utc_today() -> dt.date:
    return dt.datetime.now(dt.timezone.utc).date()


def silver_events(messages: DataFrame, name: str) -> DataFrame:
    """Silver messages as typed events; the columns are stated, not sampled."""
    dataset = DATASETS[name]
    amounts = "".join(f", {a}_eur double" for a in dataset.amounts)
    country = ", country_code string" if dataset.country_from else ""
    columns = f"{dataset.message_columns}{amounts}{country}"
    events = accepted(parsed(messages, columns), dataset.key)
    return events.withColumn("timestamp", event_time("timestamp"))


def start(
    spark: SparkSession,
    name: str,
    channel: Channel,
    load: Callable[[str, str], DataFrame],
    checkpoints: str,
    trigger: dict | None = None,
    today: Callable[[], dt.date] = utc_today,
    rules: Mapping[str, Rule] | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Run one rule; a window's alert is sent again whenever its sum changes."""
    rule = (rules or RULES)[name]
    topic = DATASETS[rule.dataset].silver_topic
    events = silver_events(channel.read_stream(spark, topic), rule.dataset)
    rows = events if rule.per_batch else rule.check(events, load, today())

    def publish(batch: DataFrame, batch_id: int) -> None:
        alerts = rule.check(batch, load, today()) if rule.per_batch else batch
        channel.write(to_messages(detected(alerts)), rule.topic, f"{name}/batch_id={batch_id}")

    mode = "append" if rule.per_batch else "update"
    return run(rows, publish, f"{checkpoints}/{name}", mode, trigger, state_partitions)
