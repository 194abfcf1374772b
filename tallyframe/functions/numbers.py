"""Number helpers: lenient casts, money and latency as whole numbers, exact means.

Sums of doubles depend on the order in which tasks finish, sums of whole numbers do not. Money is
therefore summed in cents and latency in nanoseconds; both stay primitive values in generated code,
where a cast of a double to a decimal goes through text. A sum of cents beyond 64 bits raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def to_long(text: Column) -> Column:
    return F.trim(text).try_cast("bigint")


def to_double(text: Column) -> Column:
    return F.trim(text).try_cast("double")


def truncated_int(text: Column) -> Column:
    """Text to int, fractions cut off (``4.5`` -> 4), NULL for text that is no number."""
    return text.try_cast("double").try_cast("int")


def money(amount: Column) -> Column:
    return amount.cast(MONEY)


def cents(amount: Column) -> Column:
    """An amount with two decimals as a whole number of cents."""
    return F.rint(amount.cast("double") * 100).cast("bigint")


def from_cents(total: Column) -> Column:
    return total.cast("double") / 100


def nanoseconds(seconds: Column) -> Column:
    """Seconds as a whole number of nanoseconds, wide enough to be summed over any number of rows."""
    return F.rint(seconds * 1e9).cast("bigint").cast("decimal(18,0)")


def exact_mean(values: Column, scale: int) -> Column:
    """Mean of whole numbers or decimals, rounded half up on the exact quotient. NULL without values."""
    return F.round(F.sum(values) / F.nullif(F.count(values), F.lit(0)).cast("decimal(18,0)"), scale)


def mean_of_cents(values: Column) -> Column:
    """Mean of amounts in cents, as an amount with two decimals."""
    return from_cents(exact_mean(values, 0))


def to_millis(seconds: Column, scale: int = 6) -> Column:
    """Seconds as milliseconds; the rounding takes off what the product adds behind the digits."""
    return F.round(seconds * 1000, scale)


def percent_of(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double") * 100, whole.cast("double"))
