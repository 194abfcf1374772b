"""Equi-joins. None is forced to broadcast: Spark does so for sides below its own size limit,
by estimate before and by measured size during the run, and splits skewed partitions otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row_per_key(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """Keep one row per key: the greatest value per column, so that a join does not fan out."""
    return df.groupBy(key).agg(*[F.max(column).alias(column) for column in columns])


def look_up(facts: DataFrame, lookup: DataFrame, key: str, columns: Sequence[str], keep_unmatched: bool = False) -> DataFrame:
    """Add ``columns`` of a key -> value table; facts without an entry go, or stay with NULLs."""
    return facts.join(lookup.select(key, *columns), key, "left" if keep_unmatched else "inner")


def without_listed(df: DataFrame, column: str, listed: DataFrame, entry: str) -> DataFrame:
    """Rows whose value is not on a list; rows with a NULL value stay."""
    return df.join(listed.select(F.col(entry).alias(column)), column, "left_anti")
