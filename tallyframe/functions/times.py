"""Time helpers. Zone-dependent ones read the session zone, which the library expects to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the time columns.
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
CLOCK_FORMAT = "HH:mm:ss"
SECONDS_PER_DAY = 86400


def parse_minute(text: Column) -> Column:
    """Text to timestamp; text of another form gives NULL, also under ANSI. A column that already
    holds timestamps stays as it is."""
    return F.try_to_timestamp(text, F.lit(MINUTE_FORMAT))


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds, fractions kept to the microsecond."""
    return F.timestamp_micros(F.rint(seconds * 1_000_000).cast("bigint"))


def epoch_year(seconds: Column) -> Column:
    return F.year(F.timestamp_seconds(seconds))


def epoch_text(seconds: Column, pattern: str = SECOND_FORMAT) -> Column:
    """Epoch seconds as text, ``N/A`` where there is none."""
    return F.coalesce(F.date_format(epoch_to_timestamp(seconds), pattern), F.lit("N/A"))


def timestamp_epoch(moment: Column) -> Column:
    """Timestamp to epoch seconds as a double, to the microsecond."""
    return F.unix_micros(moment.cast("timestamp")) / F.lit(1_000_000.0)


def days_between(later: Column, earlier: Column) -> Column:
    """Difference in days, two decimals. Ties are exact: the double next to a tie prints as the tie,
    and any other quotient is too far from one."""
    seconds = F.unix_seconds(later.cast("timestamp")) - F.unix_seconds(earlier.cast("timestamp"))
    return F.round(seconds / SECONDS_PER_DAY, 2)


def whole_days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def in_year(moment: Column, year: int) -> Column:
    """``year(moment) = year`` as a range, which unlike the function reaches the file scan."""
    start, end = (F.lit(f"{value:04d}-01-01 00:00:00") for value in (year, year + 1))
    return (moment >= start) & (moment < end)
