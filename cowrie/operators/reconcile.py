"""Batch against stream: the same business keys in both silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cowrie.functions.money import euros, sum_cents


def reconcile(batch: DataFrame, stream: DataFrame, key: str, amount: str = "amount_eur") -> DataFrame:
    """One row per key with both sides' row count and amount, and how they compare.

    The sides are stacked and grouped, so a key repeated on either side is summed
    before the shuffle instead of multiplying in a join.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(key), F.col(amount).cast("double").alias("amount"), F.lit(name).alias("side"))

    def of(name: str, value) -> object:
        return F.when(F.col("side") == name, value)

    grouped = (
        side(batch, "batch")
        .unionByName(side(stream, "stream"))
        .groupBy(key)
        .agg(
            F.count(of("batch", F.lit(1))).alias("batch_rows"),
            F.count(of("stream", F.lit(1))).alias("stream_rows"),
            sum_cents(of("batch", F.col("amount"))).alias("b"),
            sum_cents(of("stream", F.col("amount"))).alias("s"),
        )
    )
    outcome = (
        F.when(F.col("stream_rows") == 0, "ONLY_BATCH")
        .when(F.col("batch_rows") == 0, "ONLY_STREAM")
        .when((F.col("batch_rows") == F.col("stream_rows")) & F.col("b").eqNullSafe(F.col("s")), "SAME")
        .otherwise("DIFFERENT")
    )
    return grouped.select(
        key,
        "batch_rows",
        "stream_rows",
        euros(F.col("b")).alias("batch_amount_eur"),
        euros(F.col("s")).alias("streaming_amount_eur"),
        euros(F.col("s") - F.col("b")).alias("difference_eur"),
        outcome.alias("outcome"),
    )
