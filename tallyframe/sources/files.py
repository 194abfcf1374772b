"""Readers of semicolon files, word lists, JSON lines and the table of stored detections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.text import strip_carriage_return
from tallyframe.sources.quoted import quoted_records

REVIEW_SCHEMA = "id BIGINT, review STRING, category STRING, aspect STRING, sentiment STRING"
BOX_SCHEMA = "ARRAY<STRUCT<box: ARRAY<INT>, confidence: DOUBLE>>"
DETECTION_SCHEMA = (
    f"frame_id BIGINT, timestamp DOUBLE, person_count INT, detections {BOX_SCHEMA}, "
    "process_latency_seconds DOUBLE, total_latency_seconds DOUBLE"
)
LOG_FIELDS = ("frame_id", "timestamp", "person_count", "process_latency_seconds", "total_latency_seconds")


def read_semicolon_typed(spark: SparkSession, path: str, schema: str | T.StructType = REVIEW_SCHEMA) -> DataFrame:
    """``;`` without quoting; a bad number or a missing field at the end of a line gives NULL."""
    reader = spark.read.schema(schema).option("sep", ";").option("quote", "").option("escape", "")
    return reader.option("mode", "PERMISSIVE").csv(path)


def word_list(lines: DataFrame, line: str = "value") -> DataFrame:
    """Distinct non-empty entries of a list with one entry per line."""
    entries = lines.select(strip_carriage_return(F.col(line)).alias("stopword"))
    return entries.where("stopword is not null and stopword != ''").distinct()


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    return word_list(spark.read.text(path))


def read_quoted_csv(
    spark: SparkSession, path: str, schema: str | T.StructType | dict[str, str] | None = None, multi_line: bool = True
) -> DataFrame:
    """``;`` with header and ``"`` quoting, doubled inside a field.

    ``schema`` names the columns in their order, or is a dict of types by name: then the header gives the
    columns, those not in the dict being text. Line breaks inside fields are allowed unless ``multi_line`` is
    off; a file is split over tasks either way, as long as quotes stand for quoting only. Without a
    schema the types are inferred by one more pass, which reads a file with such fields in one task.
    """
    options = {"sep": ";", "quote": '"', "escape": '"'}
    reader = spark.read.options(header=True, **options)
    if isinstance(schema, dict):
        schema = T.StructType([T.StructField(name, _type(schema.get(name, "STRING"))) for name in reader.csv(path).columns])
    if schema is None:
        return reader.option("multiLine", multi_line).option("inferSchema", True).csv(path)
    if not multi_line:
        return reader.schema(schema).csv(path)
    layout = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return quoted_records(spark, path).select(F.from_csv("text", layout.toDDL(), options).alias("row")).select("row.*")


def _type(name: str) -> T.DataType:
    return T.StructType.fromDDL(f"field {name}")["field"].dataType


def read_json_lines(spark: SparkSession, path: str, schema: str | T.StructType | None = DETECTION_SCHEMA) -> DataFrame:
    """One JSON object per line; the schema is inferred only when ``schema`` is None."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def read_detections(spark: SparkSession, path: str, columns: Sequence[str] = LOG_FIELDS) -> DataFrame:
    """The named columns of the stored detections; the others are never read."""
    return spark.read.parquet(path).select(*columns)
