"""Keep one row per key: the newest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Share of rows, about, up to which repeated ones are taken apart from the others.
FEW = 0.1


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: str, break_ties: bool = True
) -> DataFrame:
    """The row with the greatest ``newest`` for each key.

    Ties are broken by all other columns, so a rerun keeps the same row.  The
    ``= 1`` filter lets Spark cut each map partition down to one row per key
    before the shuffle, so a key that holds a third of the rows does not land in
    one task.
    """
    ties = [c for c in df.columns if c not in {*keys, newest}] if break_ties else []
    order = [F.col(c).desc_nulls_last() for c in (newest, *ties)]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def few_repeat(df: DataFrame, key: str) -> bool:
    """Whether hardly a row shares its key with another, about: one scan of the key column, no shuffle."""
    counted = df.agg(F.count(key).alias("n"), F.approx_count_distinct(key, FEW / 2).alias("keys")).collect()[0]
    return counted["keys"] >= (1 - FEW) * counted["n"]


def repeated_apart(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose key occurs once, and the others (and those without a key).

    Keys are counted on that column alone.  Where few repeat, Spark broadcasts those and no
    row moves.  Where many do, both sides move by key once, and windows over the key, or the
    key and more, find their rows together.  ``df`` is read for each part: it should be a table.
    """
    again = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(F.col(key).alias("_again"))
    marked = df.join(again, df[key] == again["_again"], "left")
    repeats = F.col("_again").isNotNull() | F.col(key).isNull()
    return marked.filter(~repeats).drop("_again"), marked.filter(repeats).drop("_again")


def latest_per_day(df: DataFrame, key: str, day: str, newest: str) -> DataFrame:
    """Newest row of each key within each day."""
    return latest_per_key(df, [key, day], newest)


def last_day_wins(df: DataFrame, key: str, day: str) -> DataFrame:
    """Of one row per key and day, the last day's: what day-by-day upserts leave."""
    return latest_per_key(df, [key], day, break_ties=False)
