"""Detection messages in, stored detections out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyframe.functions.times import epoch_to_timestamp, timestamp_epoch
from tallyframe.sources.files import BOX_SCHEMA

# Type of each field of a record, as asked of the parsed message.
FIELDS = {
    "frame_id": "BIGINT",
    "timestamp": "DOUBLE",
    "person_count": "INT",
    "detections": BOX_SCHEMA,
    "process_latency_seconds": "DOUBLE",
    "total_latency_seconds": "DOUBLE",
}
NO_TEXT, NO_JSON, NO_OBJECT = "no text", "no JSON", "no JSON object"  # reasons of a reject


def message_files(spark: SparkSession, path: str) -> DataFrame:
    """JSON messages, one per line, as they arrive as text files in a folder."""
    return spark.readStream.text(path)


def message_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """JSON messages of a Kafka topic, from the latest offset on the first start."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    loaded = reader.option("startingOffsets", "latest").options(**options).load()
    return loaded.select(F.col("value").cast("string").alias("value"))


def checked_messages(messages: DataFrame) -> DataFrame:
    """(value, message, reason): the JSON text parsed once, or the reason why it is no record.

    Only text that is not a JSON object is rejected; a field of another type than asked for is not.
    """
    message = F.try_parse_json("value")
    kind = F.schema_of_variant("message")
    reason = F.when(F.col("value").isNull() | (F.trim("value") == ""), NO_TEXT).when(F.col("message").isNull(), NO_JSON)
    return messages.select("value", message.alias("message")).withColumn("reason", reason.when(~kind.startswith("OBJECT"), NO_OBJECT))


def _records(checked: DataFrame) -> DataFrame:
    field = {name: F.try_variant_get("message", f"$.{name}", kind) for name, kind in FIELDS.items()}
    return checked.where("reason IS NULL").select(
        F.coalesce(field["frame_id"], F.lit(-1)).alias("frame_id"),
        F.coalesce(field["timestamp"], timestamp_epoch(F.current_timestamp())).alias("timestamp"),
        F.coalesce(field["person_count"], F.lit(0)).alias("person_count"),
        field["detections"].alias("detections"),
        F.coalesce(field["process_latency_seconds"], F.lit(0.0)).alias("process_latency_seconds"),
        field["total_latency_seconds"].alias("total_latency_seconds"),
    )


def parse_messages(messages: DataFrame) -> DataFrame:
    """JSON text to records, field by field: one that is missing or of another type gets its default, the others
    stay. Text that does not start with a JSON object goes; ``rejected_messages`` has it."""
    return _records(checked_messages(messages))


def rejected_messages(messages: DataFrame) -> DataFrame:
    """(value, reason) of the messages that are no records."""
    return checked_messages(messages).where("reason IS NOT NULL").select("value", "reason")


def with_ingest_columns(records: DataFrame) -> DataFrame:
    """Add the time of ingest and the capture time as a timestamp."""
    return records.withColumns(
        {"inserted_at": F.current_timestamp(), "datetime": epoch_to_timestamp(F.col("timestamp"))}
    )


def append_stream(
    records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, form: str = "parquet"
) -> StreamingQuery:
    """Append a stream to a folder of files, each record exactly once across restarts."""
    writer = records.writeStream.format(form).outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start(path)


def store_detections(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, rejects: str | None = None
) -> StreamingQuery:
    """The whole storage job: messages -> records -> ingest columns -> table.

    With ``rejects`` each batch is parsed once and written to two tables, records to ``path`` and messages
    that are none, with their reason and time, to ``rejects``. Both are partitioned by the number
    of the batch, and a batch that runs again after a failure replaces what it wrote, so every message
    is in one table once.
    """
    if rejects is None:
        return append_stream(with_ingest_columns(parse_messages(messages)), path, checkpoint, trigger)

    def put(batch: DataFrame, number: int) -> None:
        checked = batch.persist()
        try:
            with_ingest_columns(_records(checked)).write.mode("overwrite").parquet(f"{path}/batch={number}")
            refused = checked.where("reason IS NOT NULL").select("value", "reason", F.current_timestamp().alias("inserted_at"))
            refused.write.mode("overwrite").parquet(f"{rejects}/batch={number}")
        finally:
            checked.unpersist()

    writer = checked_messages(messages).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()
