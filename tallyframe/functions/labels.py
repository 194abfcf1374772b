"""Labels chosen by conditions: age groups, delivery flag, customer segment, defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels, limits and codes of the reports.
AGE_BANDS = {"0-18": 18, "18-35": 35, "35-50": 50}
LAST_AGE_BAND = "50+"
AGE_CODES = {
    1: "Under 18",
    18: "18-24",
    25: "25-34",
    35: "35-44",
    45: "45-49",
    50: "50-55",
    56: "56+",
}
UNKNOWN_AGE = "Unknown"
UNKNOWN_MOVIE = "Unknown Movie"
MISSING_TEXT = "NA"
LATE, ON_TIME = "Late", "On time or early"
SEGMENTS = ("High-value loyal", "Loyal", "Repeat", "One-time")


def age_band(age: Column) -> Column:
    """Band with an inclusive upper end: 18 is in the first, 35 in the second."""
    label = F.when(age.isNull(), F.lit(None))
    for name, upper in AGE_BANDS.items():
        label = label.when(age <= upper, name)
    return label.otherwise(LAST_AGE_BAND)


def age_code_label(age: Column) -> Column:
    """Label of an exact age code; every other age is unknown."""
    label = F.when(F.lit(False), F.lit(None))
    for code, name in AGE_CODES.items():
        label = label.when(age == code, name)
    return label.otherwise(UNKNOWN_AGE)


def delivery_flag(rounded_delay: Column) -> Column:
    """The delay is rounded to two decimals first, so a few minutes late still count as on time."""
    return F.when(rounded_delay > 0, LATE).otherwise(ON_TIME)


def customer_segment(orders: Column, average_value: Column, high_value: Column) -> Column:
    top, loyal, repeat, once = SEGMENTS
    return (
        F.when((orders >= 4) & (average_value >= high_value), top)
        .when(orders >= 4, loyal)
        .when(orders.between(2, 3), repeat)
        .otherwise(once)
    )


def purchase_gap_days(first: Column, last: Column, orders: Column) -> Column:
    """Mean days between two purchases; NULL for a single one."""
    return F.when(orders > 1, F.round(F.try_divide(F.datediff(last, first), orders - 1), 2))


def zero_if_missing(number: Column) -> Column:
    return F.coalesce(number, F.lit(0.0))


def text_or_missing(text: Column) -> Column:
    return F.coalesce(text, F.lit(MISSING_TEXT))


def title_or_unknown(title: Column) -> Column:
    return F.coalesce(title, F.lit(UNKNOWN_MOVIE))
