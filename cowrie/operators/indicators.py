"""The seven business indicators, each computed in one pass over its facts.

Every function takes refined facts and returns one row per period and dimension.
Sums are of whole cents (see ``functions.money``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cowrie.functions.money import beyond, cents, euros, mean_eur, ratio, sum_cents, sum_eur, total
from cowrie.functions.periods import period_of
from cowrie.model import (
    CLAIM,
    CLAIM_SETTLED,
    DEFAULTED,
    MONETARY_ZONE,
    PAYMENT_FAILED,
    PREMIUM,
)
from cowrie.session import shared_folder


def is_settled_claim() -> Column:
    return (F.col("operation_type") == CLAIM) & (F.col("claim_status") == CLAIM_SETTLED)


def is_premium() -> Column:
    return F.col("operation_type") == PREMIUM


def is_cross_border() -> Column:
    sender, receiver = F.col("sender_country"), F.col("receiver_country")
    return (sender != receiver) & sender.isin(*MONETARY_ZONE) & receiver.isin(*MONETARY_ZONE)


def daily_transaction_volume(bank: DataFrame, moment: str = "timestamp") -> DataFrame:
    """Transactions and their value per day, country, entity and type; failed ones count."""
    day = period_of(moment, "day").alias("period")
    dated = bank.filter(F.col(moment).isNotNull())
    return dated.groupBy(day, "country_code", "entity_type", "transaction_type").agg(
        F.count("*").alias("txn_count"), sum_eur("amount_eur").alias("total_amount_eur")
    )


_GROUP = ["country_code", "loan_type"]
_DUE_SUMS = ["d", "d_beyond", "t", "t_beyond"]


def due_by_day(loans: DataFrame, moment: str = "due_date") -> DataFrame:
    """What was due, and what of it is in default, per day and group: all a stock needs of its facts."""
    due = F.col("amount_due_eur")
    bad = F.when(F.col("repayment_status") == DEFAULTED, due).otherwise(F.lit(0.0))
    return (
        loans.filter(F.col(moment).isNotNull())
        .groupBy(period_of(moment, "day").alias("day"), *_GROUP)
        .agg(
            F.sum(cents(bad)).alias("d"), F.sum(beyond(bad)).alias("d_beyond"),
            F.sum(cents(due)).alias("t"), F.sum(beyond(due)).alias("t_beyond"),
        )
    )


def default_stock(daily: DataFrame, first: dt.date | None = None, periods: DataFrame | None = None) -> DataFrame:
    """Share in default of all that was due up to each period, from written ``due_by_day`` rows.

    Days before ``first`` count as one opening stock of their group.  The running sum of
    a group is read at a mark for each reported day: the days present from ``first`` on, or
    the given ``periods`` (one column ``period``).  Days without rows cost nothing, however
    far apart.
    """
    if periods is None:
        reported = daily.select(F.col("day").alias("period")).distinct()
        if first is not None:
            reported = reported.filter(F.col("period") >= F.lit(first))
    else:
        reported = periods.select("period").distinct()
    # one date for each day there is: a list, ascending, of some thousands at most
    listed = reported.agg(F.sort_array(F.collect_list("period"))).scalar()
    if first is not None:
        # sums stay exact decimals and doubles, so folding the days before changes no digit
        day = F.when(F.col("day") < F.lit(first), F.date_sub(F.lit(first), 1)).otherwise(F.col("day"))
        daily = daily.groupBy(day.alias("day"), *_GROUP).agg(*(F.sum(c).cast(daily.schema[c].dataType).alias(c) for c in _DUE_SUMS))

    marks = daily.select(*_GROUP).distinct().select(
        F.explode(listed).alias("day"), *_GROUP,
        *(F.lit(None).cast(daily.schema[c].dataType).alias(c) for c in _DUE_SUMS),
        F.lit(True).alias("mark"),
    )
    # a day's own rows come before its mark
    so_far = (
        Window.partitionBy(*_GROUP).orderBy("day", "mark").rowsBetween(Window.unboundedPreceding, 0)
    )
    stocks = (
        daily.withColumn("mark", F.lit(False))
        .unionByName(marks)
        .select(
            F.col("day").alias("period"),
            *_GROUP,
            "mark",
            F.min("mark").over(so_far).alias("before_all"),
            total(F.sum("d").over(so_far), F.sum("d_beyond").over(so_far)).alias("d"),
            total(F.sum("t").over(so_far), F.sum("t_beyond").over(so_far)).alias("t"),
        )
        .filter("mark AND NOT before_all")
    )
    return stocks.select(
        "period",
        *_GROUP,
        ratio(F.col("d"), F.col("t"), 4).alias("npl_ratio"),
        euros(F.col("d")).alias("encours_defaut_eur"),
        euros(F.col("t")).alias("encours_total_eur"),
    )


def npl_ratio_by_country(
    loans: DataFrame,
    moment: str = "due_date",
    first: dt.date | None = None,
    periods: DataFrame | None = None,
) -> DataFrame:
    """Share in default of all that was due up to each period (a stock).

    The facts shrink to one row per day and group, once, when the function is called.
    """
    # written: days, groups and sums are read from it, and the facts but once
    folder = shared_folder(loans.sparkSession, "daily-due")
    daily = due_by_day(loans, moment)
    daily.write.parquet(folder)
    return default_stock(loans.sparkSession.read.schema(daily.schema).parquet(folder), first, periods)


def customer_arpu_monthly(
    bank: DataFrame,
    loans: DataFrame,
    bank_moment: str = "timestamp",
    loan_moment: str = "due_date",
) -> DataFrame:
    """Fees plus repayments per distinct customer, by month, country and segment.

    Both sides are stacked and aggregated together: revenue adds up and customers
    are counted once whichever side they come from, so no join is needed.  Months
    are those with bank rows; they are marked on the small aggregate.
    """

    def side(facts: DataFrame, moment: str, amount: str, from_bank: int) -> DataFrame:
        return facts.filter(F.col(moment).isNotNull()).select(
            period_of(moment, "month").alias("period"),
            "country_code",
            "segment",
            "customer_id",
            F.coalesce(F.col(amount), F.lit(0.0)).alias("revenue"),
            F.lit(from_bank).alias("from_bank"),
        )

    both = side(bank, bank_moment, "fee_amount_eur", 1).unionByName(
        side(loans, loan_moment, "amount_paid_eur", 0)
    )
    grouped = both.groupBy("period", "country_code", "segment").agg(
        sum_cents("revenue").alias("revenue"),
        F.count_distinct("customer_id").alias("nb_customers"),
        F.max("from_bank").alias("from_bank"),
    )
    in_month = Window.partitionBy("period")
    return (
        grouped.withColumn("banked", F.max("from_bank").over(in_month))
        .filter("banked = 1")
        .select(
            "period",
            "country_code",
            "segment",
            ratio(F.col("revenue"), F.col("nb_customers") * 100, 2).alias("arpu_eur"),
            "nb_customers",
        )
    )


def loss_ratio_by_product(operations: DataFrame, moment: str = "timestamp") -> DataFrame:
    """Settled claims over premiums by month, country and product line.

    One pass with conditional sums over the claim and premium rows.  A group whose
    country or product is unknown keeps claims and premiums apart, as an equality
    join of the two would.
    """
    unknown = F.col("country_code").isNull() | F.col("product_line").isNull()
    grouped = (
        operations.filter(F.col(moment).isNotNull() & (is_settled_claim() | is_premium()))
        .groupBy(
            period_of(moment, "month").alias("period"),
            "country_code",
            "product_line",
            F.when(unknown, is_premium()).alias("apart"),
        )
        .agg(
            F.coalesce(sum_cents(F.when(is_settled_claim(), F.col("amount_eur"))), F.lit(0.0)).alias("claims"),
            F.coalesce(sum_cents(F.when(is_premium(), F.col("amount_eur"))), F.lit(0.0)).alias("premiums"),
        )
    )
    return grouped.select(
        "period",
        "country_code",
        "product_line",
        euros(F.col("claims")).alias("claims_paid_eur"),
        euros(F.col("premiums")).alias("premiums_eur"),
        ratio(F.col("claims"), F.col("premiums"), 4).alias("loss_ratio"),
    )


def claims_processing_time(operations: DataFrame, moment: str = "timestamp") -> DataFrame:
    """Mean handling time in days, where one is known."""
    known = operations.filter(F.col(moment).isNotNull() & F.col("processing_days").isNotNull())
    return known.groupBy(
        period_of(moment, "month").alias("period"), "country_code", "product_line"
    ).agg(F.round(F.avg("processing_days"), 1).alias("avg_processing_days"))


def mobile_money_daily_flow(payments: DataFrame, moment: str = "timestamp") -> DataFrame:
    """Payments, value, failure rate and distinct senders per day and country."""
    failed = F.count_if(F.col("status") == PAYMENT_FAILED)
    dated = payments.filter(F.col(moment).isNotNull())
    return dated.groupBy(period_of(moment, "day").alias("period"), "country_code").agg(
        F.count("*").alias("txn_count"),
        sum_eur("amount_eur").alias("total_amount_eur"),
        ratio(failed, F.count("*"), 4).alias("failure_rate"),
        F.count_distinct("sender_id").alias("active_users"),
    )


def cross_border_transfers(payments: DataFrame, moment: str = "timestamp") -> DataFrame:
    """Payments between two countries of the monetary zone, per corridor and week."""
    return (
        payments.filter(F.col(moment).isNotNull() & is_cross_border())
        .groupBy(period_of(moment, "week").alias("period"), "sender_country", "receiver_country")
        .agg(
            F.count("*").alias("txn_count"),
            mean_eur("amount_eur").alias("avg_amount_eur"),
            sum_eur("amount_eur").alias("total_amount_eur"),
        )
    )
