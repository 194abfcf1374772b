"""Figures of a running stream, and its newest records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyframe.plans.frames import live_metrics, recent_trend
from tallyframe.sinks.folders import Folders

VERSION, POINTER = "version-", "CURRENT"


def running_counters(records: DataFrame, name: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the one-row live figures up to date as an in-memory table called ``name``.

    The state is one row of partial aggregates, whatever the length of the stream.
    """
    writer = live_metrics(records).writeStream.outputMode("complete").format("memory").queryName(name)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 second"})).start()


def trend_stream(
    records: DataFrame, table: str, trend: str, checkpoint: str, trigger: dict | None = None, k: int = 50
) -> StreamingQuery:
    """Append each batch to ``table`` and replace ``trend`` by the newest ``k`` of all records.

    Only the batch and the trend before it are read, as older records can never come back. Every batch
    writes a version of the trend of its own, and the pointer to it is replaced in one step, so
    ``read_trend`` sees at most ``k`` rows at any time. A batch that is run again after a failure replaces its own
    folder and version from the same version before it. That one is kept for such a run and for readers
    under way; older ones go.
    """

    def refresh(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")
        stored = spark.read.parquet(f"{table}/batch={number}")
        columns = ["frame_id", "timestamp", "person_count", "process_latency_seconds"]
        newest = stored.select(*columns)
        if number > 0:
            newest = newest.unionByName(spark.read.parquet(_version(trend, number - 1)).select(*columns))
        recent_trend(newest, k).coalesce(1).write.mode("overwrite").parquet(_version(trend, number))
        _point(spark, trend, number)
        folders = Folders(spark, trend)
        for old in folders.names():
            if old.startswith(VERSION) and int(old.removeprefix(VERSION)) < number - 1:
                folders.remove(old)

    writer = records.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()


def _version(trend: str, number: int) -> str:
    return f"{trend}/{VERSION}{number}"


def _point(spark: SparkSession, trend: str, number: int) -> None:
    """Make the pointer name version ``number``: written beside it, then renamed over it."""
    Folders(spark, trend).put(POINTER, str(number))


def read_trend(spark: SparkSession, trend: str) -> DataFrame:
    """The version of the trend that is current when this is called."""
    number = spark.read.text(f"{trend}/{POINTER}").first()[0]
    return spark.read.parquet(_version(trend, int(number)))
