"""Money and ratios.

Sums of money run over whole cents in BIGINT: exact, independent of row order
and inside the hash aggregate, where wide decimals are not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    # exact for every amount of up to 12 digits, whether it comes as decimal or double
    return F.floor(amount.cast("double") * 100 + F.lit(0.5))


def from_cents(amount: Column) -> Column:
    return amount.cast("double") / F.lit(100.0)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, NULL when ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(ratio(part, whole) * 100, digits)


def sample_std(count: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from mergeable integer sums; NULL below two values."""
    n = count.cast("double")
    # products of two BIGINTs: 38 digits hold the largest of them
    wide_count, wide_total, wide_squares = (c.cast("decimal(19,0)") for c in (count, total, squares))
    spread = (wide_squares * wide_count - wide_total * wide_total).cast("double")
    return F.when(count > 1, F.sqrt(spread / (n * (n - 1))))
