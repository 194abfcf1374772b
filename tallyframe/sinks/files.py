"""Batch sinks. They write one file per task; ``one_file`` is for small reports only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.rows import title_first

# Name of the title column of the saved reports.
TITLE_COLUMN = "Ten_Bai"


def as_lines(df: DataFrame, line: Column) -> DataFrame:
    """One text column ``value`` out of a line template."""
    return df.select(line.alias("value"))


def write_lines(df: DataFrame, path: str, line: Column | None = None) -> None:
    (df if line is None else as_lines(df, line)).write.mode("errorifexists").text(path)


def write_delimited(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Plain fields without header and without quoting."""
    writer = df.write.mode("errorifexists").option("sep", sep).option("quote", "").option("emptyValue", "")
    # The CSV writer strips blanks around fields unless told otherwise.
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def _overwrite_csv(df: DataFrame, path: str, one_file: bool) -> None:
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).csv(path)


def save_result(df: DataFrame, path: str, title: str, one_file: bool = False) -> None:
    """CSV with header and the report title as first column; replaces an earlier result."""
    _overwrite_csv(title_first(df, title, TITLE_COLUMN), path, one_file)


def overwrite_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV with header; replaces an earlier result."""
    _overwrite_csv(df, path, one_file)


def as_json(df: DataFrame, value: str = "value") -> DataFrame:
    """Each row as one JSON text, nested fields included."""
    return df.select(F.to_json(F.struct("*")).alias(value))


def write_json(df: DataFrame, path: str) -> None:
    as_json(df).write.mode("errorifexists").text(path)
