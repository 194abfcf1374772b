"""Session set-up and the shared folder that cuts of long plans are written to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app_name: str = "tallyframe", master: str | None = None, **options: str) -> SparkSession:
    """A session with the settings the plans count on: UTC, AQE with skew splitting, ANSI on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **{key.replace("__", "."): value for key, value in options.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Where nothing is named, only a local master gets a folder of its own; a cluster without a
    shared folder is an error, since a machine-local one is lost with its executor.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tallyframe-")
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is created there yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it from there, so that
    several reports share one parse of a text file and read only their columns."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder, so that several readers do not recompute it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
