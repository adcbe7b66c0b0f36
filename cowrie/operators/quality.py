"""Row rules: what is rejected, blanked or dropped, and required inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"


def is_corrupt() -> Column:
    return F.col(CORRUPT).isNotNull()


def sound_rows(parsed: DataFrame, key: str) -> DataFrame:
    """Rows that parsed and carry their business key."""
    return parsed.filter(~is_corrupt() & F.col(key).isNotNull()).drop(CORRUPT)


def load_counts(key: str) -> list[Column]:
    """Handled and rejected rows as aggregates, for ``observe`` or ``agg``."""
    return [
        F.count_if(~is_corrupt() & F.col(key).isNotNull()).alias("rows_handled"),
        F.count_if(is_corrupt()).alias("rows_rejected"),
    ]


def with_country(df: DataFrame, country_from: str | None) -> DataFrame:
    if country_from is None or "country_code" in df.columns:
        return df
    return df.withColumn("country_code", F.col(country_from))


def usable_amounts(df: DataFrame, amounts: Sequence[str]) -> DataFrame:
    """Blank negative amounts; drop rows left without the main (first) amount."""
    main, *others = [a for a in amounts if a in df.columns]
    kept = df.filter(F.col(main) >= 0)
    return kept.withColumns({a: F.when(F.col(a) >= 0, F.col(a)) for a in others})


def in_countries(df: DataFrame, countries: Sequence[str] | None) -> DataFrame:
    """Rows of the chosen countries; none chosen means all."""
    return df.filter(F.col("country_code").isin(list(countries))) if countries else df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise LookupError(f"no data: {what}")
    return df
