"""Folds and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WHOLE = 1 << 30


def remainder(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id, which is in no fold."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(folds))


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    return F.coalesce(remainder(doc_id, folds) == fold, F.lit(False))


def sampled(rows: DataFrame, key: str, label: str, each: int) -> DataFrame:
    """About ``each`` rows of every value of ``label`` (all, where there are fewer), by a hash of ``key``.

    Adds ``weight``: how many rows of its label a sampled row stands for.  Rows with a
    null key or label aren't drawn.  The size is that of the labels' number times
    ``each``, whatever the size of the input.
    """
    known = rows.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    counts = known.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    rates = counts.select("_label", F.least(F.lit(1.0), F.lit(float(each)) / F.col("_n")).alias("_rate"))
    drawn = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(_WHOLE)) < F.col("_rate") * _WHOLE
    # one row for each label: broadcasting it is as small as the list of labels
    return (
        known.join(F.broadcast(rates), F.col(label) == F.col("_label"))
        .where(drawn)
        .withColumn("weight", 1 / F.col("_rate"))
        .drop("_label", "_rate")
    )
