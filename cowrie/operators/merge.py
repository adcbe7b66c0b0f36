"""Merges as DataFrame expressions; ``sources.lake`` writes their results.

Keys match by equality, so a NULL key never matches and its row is inserted each
time; ``null_safe`` makes NULL equal to NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _aside(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*(F.col(k).alias(f"_{k}") for k in keys))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    condition = F.lit(True)
    for key in keys:
        a, b = left[key], right[f"_{key}"]
        condition = condition & (a.eqNullSafe(b) if null_safe else a == b)
    return condition


def matched(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    other = _aside(right, keys)
    return left.join(other, _same(left, other, keys, null_safe), "left_semi")


def unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    other = _aside(right, keys)
    return left.join(other, _same(left, other, keys, null_safe), "left_anti")


#: Rows whose keys a join may broadcast, at most.
BROADCAST_KEYS = 250_000


def sized(rows: DataFrame, many: bool) -> DataFrame:
    """``rows``, which a join doesn't broadcast where they are ``many``.

    Spark takes the size of a table from its files, and keys are some ten times larger as
    rows than in compressed columns: all of them would be sent to the driver.
    """
    return rows.hint("merge") if many else rows


def may_match(target: DataFrame, source: DataFrame, keys: Sequence[str], many: bool = False) -> DataFrame:
    """Target rows whose key hash occurs in the source: all matches, and hardly another.

    A merge has to look for its keys in the whole target.  Only 64-bit hashes are
    compared for that.  Where the source's are below the session's broadcast
    threshold, by its files or as measured at run time, Spark broadcasts them and
    the target is scanned but not shuffled, unless the source is said to have ``many``
    rows.  The keys must have the same types on both sides.
    """
    hashes = sized(source.select(F.xxhash64(*keys).alias("_source_hash")), many)
    hashed = target.withColumn("_hash", F.xxhash64(*keys))
    found = hashed.join(hashes, hashed["_hash"] == hashes["_source_hash"], "left_semi")
    return found.drop("_hash")


def rows_to_insert(target: DataFrame, source: DataFrame, keys: Sequence[str], many: bool = False) -> DataFrame:
    """Source rows whose key the target lacks; duplicates inside the source stay."""
    return unmatched(source, sized(may_match(target.select(*keys), source, keys, many), many), keys)


def rows_to_update(target: DataFrame, source: DataFrame, keys: Sequence[str], many: bool = False) -> DataFrame:
    """Target rows whose key the source brings."""
    return matched(may_match(target, source, keys, many), sized(source, many), keys)


def upserted(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """The target after the source's rows replaced or joined its own."""
    return unmatched(target, source, keys, null_safe).unionByName(source)


def repeated_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys the source holds more than once; they must not meet a target row."""
    return source.groupBy(*keys).count().filter("count > 1").select(*keys)


def replaced(target: DataFrame, source: DataFrame, column: str, value) -> DataFrame:
    """The target with the rows of one period exchanged for the source's."""
    others = F.col(column).isNull() | (F.col(column) != F.lit(value))
    return target.filter(others).unionByName(source)
