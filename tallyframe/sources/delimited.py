"""Rating files: one record per line, fields parted by ``::`` or by a comma, line by line."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.text import trim_all


@dataclass(frozen=True)
class Layout:
    """Where the columns of one kind of file are.

    ``columns`` holds (name, position, type); position -1 is the last field. ``header`` is how a
    header line starts, ``required`` the columns without which a line is malformed and ``fields``
    the least number of fields of a good line.
    """

    columns: tuple[tuple[str, int, str], ...]
    header: str
    required: tuple[str, ...]
    fields: int


# Field positions of the rating files.
MOVIES = Layout((("movie_id", 0, "bigint"), ("title", 1, "string"), ("genres", -1, "string")), "MovieID", ("movie_id",), 2)
RATINGS = Layout(
    (("user_id", 0, "bigint"), ("movie_id", 1, "bigint"), ("rating", 2, "double"), ("ts", 3, "bigint")),
    "UserID",
    ("movie_id", "rating"),
    3,
)
USERS = Layout(
    (("user_id", 0, "bigint"), ("gender", 1, "string"), ("age", 2, "int"), ("occupation", 3, "int"), ("zip_code", 4, "string")),
    "UserID",
    ("user_id",),
    2,
)
OCCUPATIONS = Layout((("occupation", 0, "int"), ("occupation_name", 1, "string")), "ID", ("occupation",), 2)


def split_fields(line: Column, body: Column | None = None) -> Column:
    """Fields of a line (or of ``body``): ``::`` is the separator if the line holds it, else the comma."""
    separator = F.when(_double_colon(line), "::").otherwise(",")
    return F.split(line if body is None else body, separator)


def _double_colon(line: Column) -> Column:
    return F.contains(line, F.lit("::"))


def _rows(lines: DataFrame, fields: Column, row: Callable[[Column], Column]) -> DataFrame:
    """One typed row per line. The lambda binds the fields, so that a line is split once, where
    filters and columns over a split column would each repeat the split."""
    return lines.select(F.inline(F.transform(F.array(fields), row)))


def parse_lines(lines: DataFrame, layout: Layout, mode: str = "drop", line: str = "value") -> DataFrame:
    """Lines to typed rows.

    ``drop`` skips headers, blank lines and malformed lines, trims every field and ignores empty
    fields at the end of a line. ``fail`` trims the line only, takes the genres from the third
    field, and stops the job at the first line with a missing field or a bad number. ``late`` does
    the same but leaves such a field NULL and keeps the line in ``_bad``: ``demand`` then stops the
    job where a report reads that field.
    """
    if mode == "drop":
        return _lenient(lines, layout, F.col(line))
    if mode == "fail":
        return demand(_strict(lines, layout, F.col(line)), *[name for name, _, _ in layout.columns])
    if mode == "late":
        return _strict(lines, layout, F.col(line))
    raise ValueError(f"mode must be 'drop', 'fail' or 'late', not {mode!r}")


def _lenient(lines: DataFrame, layout: Layout, line: Column) -> DataFrame:
    whole = lines.where(~line.startswith(layout.header) & (trim_all(line) != ""))
    shortened = F.when(_double_colon(line), F.regexp_replace(line, "(::)+$", "")).otherwise(F.rtrim(line, F.lit(",")))

    def field(fields: Column, place: int, kind: str) -> Column:
        if place >= 0:
            found = F.get(fields, F.lit(place))
        else:
            found = F.when(F.size(fields) > layout.fields, F.element_at(fields, place))
        return trim_all(found) if kind == "string" else trim_all(found).try_cast(kind)

    def row(fields: Column) -> Column:
        typed = [field(fields, place, kind).alias(name) for name, place, kind in layout.columns]
        return F.struct(*typed, F.size(fields).alias("_fields"))

    parsed = _rows(whole, split_fields(line, shortened), row).where(F.col("_fields") >= layout.fields)
    return parsed.dropna(subset=list(layout.required)).drop("_fields")


def _strict(lines: DataFrame, layout: Layout, line: Column) -> DataFrame:
    def field(fields: Column, place: int, kind: str) -> Column:
        found = F.get(fields, F.lit(place if place >= 0 else 2))
        return found if kind == "string" else F.trim(found).try_cast(kind)

    def row(fields: Column) -> Column:
        typed = [(field(fields, place, kind), name) for name, place, kind in layout.columns]
        missing = reduce(or_, [value.isNull() for value, _ in typed])
        bad = F.when(missing, F.array_join(fields, "|")).alias("_bad")
        return F.struct(*[value.alias(name) for value, name in typed], bad)

    return _rows(lines, split_fields(line, trim_all(line)), row)


def demand(rows: DataFrame, *names: str) -> DataFrame:
    """Only the named columns of rows parsed ``late``; the job stops at a row where one of them is missing.

    Each column asks for all of them, so that a join or a filter on one cannot pass a bad row by.
    """
    whole = reduce(and_, [F.col(name).isNotNull() for name in names])
    stop = F.raise_error(F.concat(F.lit("malformed line: "), F.col("_bad")))
    return rows.select(*[F.when(whole, F.col(name)).otherwise(stop.cast(rows.schema[name].dataType)).alias(name) for name in names])


def read_delimited_auto(spark: SparkSession, paths: str | Sequence[str], layout: Layout, mode: str = "drop") -> DataFrame:
    """Read one file, a folder or several of them."""
    return parse_lines(spark.read.text(paths if isinstance(paths, str) else list(paths)), layout, mode)
