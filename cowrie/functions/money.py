"""Currency conversion and exact money sums.

Sums of doubles depend on the order in which partitions arrive, so a rerun after
a lost executor could give another last digit.  Amounts in EUR have two decimals
by construction; they are summed as whole cents and divided once at the end.  The
few amounts that no decimal holds (infinity, NaN, beyond 10^25) are summed as doubles
beside, so none is left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cowrie.model import EUR_PER_UNIT


def eur_rate(currency: Column, rates: Mapping[str, float] = EUR_PER_UNIT) -> Column:
    """EUR for one unit of ``currency``; NULL for a currency without a rate."""
    return F.coalesce(*(F.when(currency == code, F.lit(rate)) for code, rate in rates.items()))


def with_eur(
    df: DataFrame,
    amounts: Iterable[str],
    currency: str = "currency",
    rates: Mapping[str, float] = EUR_PER_UNIT,
) -> DataFrame:
    """Add ``<amount>_eur``, rounded to the cent, beside each amount column."""
    rate = eur_rate(F.col(currency), rates)
    return df.withColumns({f"{a}_eur": F.round(F.col(a) * rate, 2) for a in amounts})


CENTS, NATIVE = "decimal(27,0)", "decimal(28,8)"


def _column(amount: Column | str) -> Column:
    return F.col(amount) if isinstance(amount, str) else amount


def cents(amount: Column | str) -> Column:
    """A two-decimal amount as a whole number of cents (NULL where no decimal holds it)."""
    return F.rint(_column(amount) * 100).try_cast(CENTS)


def beyond(amount: Column | str) -> Column:
    """Cents, as a double, of an amount that ``cents`` can't hold; NULL for all others."""
    whole = F.rint(_column(amount) * 100)
    return F.when(whole.try_cast(CENTS).isNull(), whole)


def total(exact: Column, wild: Column) -> Column:
    """The double of an exact sum and a sum of doubles; NULL if both are."""
    return F.when(wild.isNull(), exact.cast("double")).otherwise(
        F.coalesce(exact.cast("double"), F.lit(0.0)) + wild
    )


def sum_cents(amount: Column | str) -> Column:
    """All amounts in cents; both sums combine before a shuffle."""
    return total(F.sum(cents(amount)), F.sum(beyond(amount)))


def euros(whole_cents: Column) -> Column:
    return whole_cents / F.lit(100)


def sum_eur(amount: Column | str) -> Column:
    return euros(sum_cents(amount))


def mean_eur(amount: str) -> Column:
    """Mean to the cent; one division, so an exact half cent rounds up."""
    return F.round(F.try_divide(sum_cents(amount), F.count(amount) * 100), 2)


def sum_native(amount: Column | str) -> Column:
    """Sum of an amount in its own currency, exact to eight decimals."""
    amount = _column(amount)
    held = amount.try_cast(NATIVE)
    return total(F.sum(held), F.sum(F.when(held.isNull(), amount)))


def ratio(numerator: Column, denominator: Column, decimals: int) -> Column:
    """Rounded quotient, NULL when the denominator is 0."""
    return F.round(F.try_divide(numerator, denominator), decimals)
