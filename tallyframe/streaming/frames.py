"""Frame messages in, detection records out."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyframe.functions.times import epoch_to_timestamp, timestamp_epoch
from tallyframe.sinks.files import as_json
from tallyframe.sources.files import BOX_SCHEMA

FRAME_SCHEMA = "value BINARY, headers ARRAY<STRUCT<key: STRING, value: BINARY>>"

Box = tuple[Sequence[int], float]
Detector = Callable[[list[bytes]], Iterable[Sequence[Box] | None]]
LoadDetector = Callable[[], Detector]
ARROW_BOXES = pa.list_(pa.struct([("box", pa.list_(pa.int32())), ("confidence", pa.float64())]))


def frame_files(spark: SparkSession, path: str) -> DataFrame:
    """Frame messages as they arrive as Parquet files in a folder."""
    return spark.readStream.schema(FRAME_SCHEMA).parquet(path)


def frame_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Frame messages of a Kafka topic, from the latest offset on the first start and from the
    checkpoint after that. Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("includeHeaders", True).option("startingOffsets", "latest")
    return reader.options(**options).load().select("value", "headers")


def _header(key: str) -> Column:
    """Text of the last header of that name, NULL without one."""
    place = F.array_position(F.reverse(F.col("headers.key")), key) - 1
    return F.decode(F.get(F.reverse(F.col("headers.value")), place), "UTF-8")


def decode_headers(messages: DataFrame) -> DataFrame:
    """Frame number, capture time and source out of the headers. A missing time is now, a missing
    source is unknown, and a missing number is NULL, as the column holds whole numbers."""
    return messages.select(
        _header("frame_id").try_cast("bigint").alias("frame_id"),
        F.coalesce(_header("timestamp").try_cast("double"), timestamp_epoch(F.current_timestamp())).alias("timestamp"),
        F.coalesce(_header("source"), F.lit("unknown")).alias("source"),
        "value",
    )


def without_repeats(frames: DataFrame, within: str = "10 minutes") -> DataFrame:
    """Each frame once that a producer sends again: the same source and number, or without a number the same
    source, time and payload.

    On a stream a frame is remembered for ``within`` of capture time, so the state is bounded, and one
    captured longer ago than that before the newest is late: it is left out and counted (``late_rows``).
    """
    unnamed = F.concat_ws(":", F.lit("?"), F.col("timestamp").cast("string"), F.sha1("value"))
    keyed = frames.withColumn("_key", F.coalesce(F.col("frame_id").cast("string"), unnamed))
    if not frames.isStreaming:
        return keyed.dropDuplicates(["source", "_key"]).drop("_key")
    timed = keyed.withColumn("_moment", epoch_to_timestamp(F.col("timestamp"))).withWatermark("_moment", within)
    return timed.dropDuplicatesWithinWatermark(["source", "_key"]).drop("_key", "_moment")


def late_rows(query: StreamingQuery) -> int:
    """Rows that came too late for their watermark, in the batches that the query remembers."""
    return sum(state["numRowsDroppedByWatermark"] for batch in query.recentProgress for state in batch["stateOperators"])


def detect(frames: DataFrame, load_detector: LoadDetector, partitions: int | None = None) -> DataFrame:
    """Run a detector over the frames and skip those it cannot decode.

    The detector is loaded once per task and given all payloads of an Arrow batch; it gives
    back the boxes per payload, or None for a payload that is no image. Its answers are taken one by one and
    both clocks are read when a frame's answer is there, so a detector that works frame by frame is timed
    frame by frame (one that answers for the whole batch at once has its time on the first frame).
    Where a model takes longer than moving a frame, ``partitions`` deals the frames out evenly to that many tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = load_detector()
        for batch in batches:
            found, worked, done = [], [], []
            started = time.perf_counter()
            for boxes in find(batch.column("value").to_pylist()):
                ended = time.perf_counter()
                found.append(boxes)
                worked.append(ended - started)
                done.append(time.time())
                started = ended
            seen = pa.array([boxes is not None for boxes in found], pa.bool_())
            kept = batch.filter(seen)
            boxes = [[{"box": box, "confidence": score} for box, score in row] for row in found if row is not None]
            columns = {
                "frame_id": kept.column("frame_id"),
                "timestamp": kept.column("timestamp"),
                "detections": pa.array(boxes, ARROW_BOXES),
                "process_latency_seconds": pa.array(worked, pa.float64()).filter(seen),
                "done": pa.array(done, pa.float64()).filter(seen),
            }
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"frame_id BIGINT, timestamp DOUBLE, detections {BOX_SCHEMA}, process_latency_seconds DOUBLE, done DOUBLE"
    slim = frames.select("frame_id", "timestamp", "value")
    return (slim.repartition(partitions) if partitions else slim).mapInArrow(run, schema)


def detection_records(found: DataFrame) -> DataFrame:
    """Add the number of boxes and the time from capture until the frame was done."""
    return found.select(
        "frame_id",
        "timestamp",
        F.size("detections").alias("person_count"),
        "detections",
        "process_latency_seconds",
        (F.col("done") - F.col("timestamp")).alias("total_latency_seconds"),
    )


def detection_messages(messages: DataFrame, load_detector: LoadDetector, repeats_within: str | None = None) -> DataFrame:
    """The whole job: messages -> headers -> detections -> JSON text, batch or stream; with ``repeats_within``
    frames that are sent again within that time are detected once."""
    frames = decode_headers(messages)
    if repeats_within:
        frames = without_repeats(frames, repeats_within)
    return as_json(detection_records(detect(frames, load_detector)))
