"""Unions, distinct rows, ranked and limited rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, duplicates kept."""
    return reduce(DataFrame.unionByName, frames)


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct rows over the named columns (all of them where none is named)."""
    return (df.select(*columns) if columns else df).distinct()


def top_per_group(df: DataFrame, group: Sequence[str], k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows per group. Spark keeps k rows per group and task before it shuffles."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")


def top_rows(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of all, by a bounded heap per task."""
    return df.orderBy(*order).limit(k)


def latest_ascending(df: DataFrame, k: int, newest_first: Sequence[Column], oldest_first: Sequence[Column]) -> DataFrame:
    """The newest ``k`` rows, given back oldest first."""
    return top_rows(df, k, *newest_first).orderBy(*oldest_first)


def title_first(df: DataFrame, title: str, name: str) -> DataFrame:
    """Put a constant title in front of the columns."""
    return df.select(F.lit(title).alias(name), "*")
