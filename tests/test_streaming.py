from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from tallyframe.plans.frames import live_metrics
from tallyframe.registry.flows import counting_detector
from tallyframe.streaming import detections, frames, live

ONCE = {"availableNow": True}


def put(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(record if isinstance(record, str) else json.dumps(record) for record in records) + "\n")


def record(number, count=1):
    return {"frame_id": number, "timestamp": 1000.5 + number, "person_count": count, "process_latency_seconds": 0.05, "total_latency_seconds": 0.1}


def store(spark, folder, tmp_path):
    messages = detections.message_files(spark, str(folder))
    detections.store_detections(messages, str(tmp_path / "table"), str(tmp_path / "progress"), ONCE).awaitTermination()
    return spark.read.parquet(str(tmp_path / "table"))


def test_storage_skips_bad_messages_and_fills_missing_fields(spark, rows, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.json", record(1, 3), "{broken", "", {"timestamp": 7.25}, {"frame_id": "unknown", "timestamp": 8.5, "person_count": 2}, {"frame_id": 4})
    table = store(spark, folder, tmp_path)
    found = rows(table.where("frame_id <> 4"), "frame_id", "timestamp", "person_count", "process_latency_seconds")
    assert found == [(-1, 7.25, 0, 0.0), (-1, 8.5, 2, 0.0), (1, 1001.5, 3, 0.05)]
    assert table.where("inserted_at is null or datetime is null").count() == 0
    assert table.where("frame_id = 1").select(F.col("datetime").cast("string")).first()[0] == "1970-01-01 00:16:41.5"
    now = table.where("frame_id = 4").selectExpr("abs(timestamp - unix_micros(inserted_at) / 1e6) < 5").first()[0]
    assert now


def test_messages_that_are_no_records_are_kept_with_their_reason(spark, rows):
    texts = ['{"frame_id": 1}', "{broken", "[1]", "7", "null", "", "  ", None, '{"detections": [{"box": [1, 2], "confidence": "x"}], "person_count": {}}']
    messages = spark.createDataFrame([(text,) for text in texts], "value string")
    refused = [("", "no text"), ("  ", "no text"), ("7", "no JSON object"), ("[1]", "no JSON object"), ("null", "no JSON object"), ("{broken", "no JSON")]
    assert rows(detections.rejected_messages(messages)) == sorted([*refused, (None, "no text")], key=repr)
    found = detections.parse_messages(messages)
    assert rows(found, "frame_id", "person_count") == [(-1, 0), (1, 0)]
    assert [list(box.box) for box in found.where("frame_id = -1").first().detections] == [[1, 2]]


def test_records_and_rejects_of_a_batch_are_written_once(spark, rows, tmp_path):
    folder, table, rejects, progress = (str(tmp_path / name) for name in ("in", "table", "rejects", "progress"))

    def run():
        messages = detections.message_files(spark, folder)
        detections.store_detections(messages, table, progress, ONCE, rejects).awaitTermination()
        return rows(spark.read.parquet(table), "frame_id"), rows(spark.read.parquet(rejects), "value")

    put(tmp_path / "in", "a.json", record(1), "{one", record(2))
    assert run() == ([(1,), (2,)], [("{one",)])
    put(tmp_path / "in", "b.json", record(3), "{two")
    assert run() == ([(1,), (2,), (3,)], [("{one",), ("{two",)])
    (tmp_path / "progress" / "commits" / "1").unlink()  # as after a failure between writing and committing
    for crc in (tmp_path / "progress" / "commits").glob(".1.crc"):
        crc.unlink()
    assert run() == ([(1,), (2,), (3,)], [("{one",), ("{two",)])
    assert {path.name for path in (tmp_path / "table").iterdir()} == {"batch=0", "batch=1"}
    assert spark.read.parquet(rejects).where("inserted_at is null").count() == 0


def test_a_restart_goes_on_where_it_stopped(spark, rows, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.json", record(1), record(2))
    assert store(spark, folder, tmp_path).count() == 2
    assert store(spark, folder, tmp_path).count() == 2
    put(folder, "b.json", record(3), record(1))
    assert rows(store(spark, folder, tmp_path), "frame_id") == [(1,), (1,), (2,), (3,)]


def messages(spark):
    rows = [
        (b"2", [("frame_id", b"1"), ("timestamp", b"5.5"), ("source", b"cam")]),
        (b"\xff\xfe", [("frame_id", b"2"), ("timestamp", b"6.5")]),
        (b"0", [("timestamp", b"7.5"), ("frame_id", b"3"), ("frame_id", b"4")]),
        (b"1", [("frame_id", b"many")]),
        (b"1", None),
    ]
    return spark.createDataFrame(rows, frames.FRAME_SCHEMA)


def test_headers_have_defaults_and_the_last_one_counts(spark, rows):
    found = rows(frames.decode_headers(messages(spark)), "frame_id", F.col("timestamp") < 100, "source")
    assert found == sorted([(1, True, "cam"), (2, True, "unknown"), (4, True, "unknown"), (None, False, "unknown"), (None, False, "unknown")], key=repr)


def test_detector_skips_undecodable_frames(spark, rows):
    found = frames.detection_records(frames.detect(frames.decode_headers(messages(spark)), counting_detector()))
    assert rows(found, "frame_id", "person_count") == sorted([(1, 2), (4, 0), (None, 1), (None, 1)], key=repr)
    boxes = found.where("frame_id = 1").select("detections").first()[0]
    assert [(list(box.box), box.confidence) for box in boxes] == [([0, 0, 8, 16], 0.5), ([10, 0, 18, 16], 0.5625)]
    assert found.where("process_latency_seconds < 0 or total_latency_seconds < 0").count() == 0


def uneven(delays):
    """A detector that takes the given seconds per frame."""

    def load():
        def find(payloads):
            for payload, delay in zip(payloads, delays):
                time.sleep(delay)
                yield None if payload == b"bad" else [((0, 0, 1, 1), 0.5)]

        return find

    return load


def test_each_frame_has_clocks_of_its_own(spark):
    delays = [0.3, 0.0, 0.1, 0.0]
    taken = time.time()
    given = [(number, taken, b"bad" if number == 1 else b"ok") for number in range(4)]
    messages = spark.createDataFrame(given, "frame_id long, timestamp double, value binary").coalesce(1)
    found = {row["frame_id"]: row for row in frames.detection_records(frames.detect(messages, uneven(delays))).collect()}
    assert sorted(found) == [0, 2, 3]
    for number, row in found.items():
        assert delays[number] <= row["process_latency_seconds"] < delays[number] + 0.09
        assert row["total_latency_seconds"] >= sum(delays[: number + 1])


@pytest.mark.parametrize("batch", ["1", "100"])
def test_detector_is_called_with_whole_batches(spark, rows, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = frames.detect(frames.decode_headers(messages(spark).coalesce(1)), counting_detector())
        assert found.count() == 4
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def frame(number, second, payload=b"1", source=b"cam"):
    named = [("frame_id", str(number).encode())] if number is not None else []
    return (payload, [*named, ("timestamp", str(second).encode()), ("source", source)])


def test_frames_sent_again_are_detected_once_and_late_ones_counted(spark, rows, tmp_path):
    folder, out, progress = (str(tmp_path / name) for name in ("frames", "out", "progress"))

    def run(*messages):
        spark.createDataFrame(list(messages), frames.FRAME_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stream = frames.detection_messages(frames.frame_files(spark, folder), counting_detector(), "100 seconds")
        query = detections.append_stream(stream, out, progress, ONCE, "text")
        query.awaitTermination()
        numbers = sorted(row["frame_id"] for row in detections.parse_messages(spark.read.text(out)).collect())
        return numbers, frames.late_rows(query)

    first = [frame(1, 1000), frame(1, 1000), frame(1, 1000, source=b"other"), frame(None, 1001), frame(None, 1001), frame(None, 1001, b"2")]
    assert run(*first) == ([-1, -1, 1, 1], 0)
    assert run(frame(1, 1000), frame(2, 1090)) == ([-1, -1, 1, 1, 2], 0)
    assert run(frame(3, 5000)) == ([-1, -1, 1, 1, 2, 3], 0)
    assert run(frame(4, 1000), frame(5, 4950)) == ([-1, -1, 1, 1, 2, 3, 5], 1)
    batch = frames.decode_headers(spark.createDataFrame(first, frames.FRAME_SCHEMA))
    assert rows(frames.without_repeats(batch), "frame_id") == sorted([(1,), (1,), (None,), (None,)], key=repr)


def test_detector_stream_equals_the_batch(spark, rows, tmp_path):
    messages(spark).write.parquet(str(tmp_path / "frames"))
    stream = frames.detection_messages(frames.frame_files(spark, str(tmp_path / "frames")), counting_detector())
    detections.append_stream(stream, str(tmp_path / "out"), str(tmp_path / "progress"), ONCE, "text").awaitTermination()
    published = detections.parse_messages(spark.read.text(str(tmp_path / "out")))
    batch = detections.parse_messages(frames.detection_messages(messages(spark), counting_detector()))
    assert rows(published, "frame_id", "person_count", "detections") == rows(batch, "frame_id", "person_count", "detections")


def test_running_counters_equal_the_batch_after_each_run(spark, rows, tmp_path):
    folder = tmp_path / "in"
    for run in range(3):
        put(folder, f"{run}.json", *[record(10 * run + i, i % 4) for i in range(5)])
        stream = detections.parse_messages(detections.message_files(spark, str(folder)))
        live.running_counters(stream, f"live_{run}", str(tmp_path / "progress"), ONCE).awaitTermination()
        batch = detections.parse_messages(spark.read.text(str(folder)))
        assert rows(spark.table(f"live_{run}")) == rows(live_metrics(batch))


def test_trend_keeps_the_newest_over_all_batches(spark, rows, tmp_path):
    folder, trend = tmp_path / "in", str(tmp_path / "trend")
    for batch, (numbers, newest) in enumerate((([5, 9, 1], [1, 5, 9]), ([2, 8], [5, 8, 9]), ([3], [5, 8, 9]), ([11], [8, 9, 11]))):
        put(folder, f"{batch}.json", *[record(number) for number in numbers])
        stream = detections.parse_messages(detections.message_files(spark, str(folder)))
        before = live.read_trend(spark, trend) if batch else None
        live.trend_stream(stream, str(tmp_path / "table"), trend, str(tmp_path / "progress"), ONCE, k=3).awaitTermination()
        assert sorted(row["frame_id"] for row in live.read_trend(spark, trend).collect()) == newest
        assert before is None or before.count() == 3  # a reader under way can finish
        versions = {f"version-{number}" for number in (batch - 1, batch) if number >= 0}
        assert {path.name for path in (tmp_path / "trend").iterdir() if not path.name.startswith(".")} == versions | {"CURRENT"}
    assert spark.read.parquet(str(tmp_path / "table")).count() == 7


def test_a_batch_that_runs_again_changes_nothing(spark, rows, tmp_path):
    folder, trend = tmp_path / "in", str(tmp_path / "trend")

    def run():
        stream = detections.parse_messages(detections.message_files(spark, str(folder)))
        live.trend_stream(stream, str(tmp_path / "table"), trend, str(tmp_path / "progress"), ONCE, k=3).awaitTermination()
        return rows(live.read_trend(spark, trend), "frame_id")

    put(folder, "a.json", record(4), record(6))
    run()
    put(folder, "b.json", record(5), record(7))
    assert run() == [(5,), (6,), (7,)]
    for done in [*(tmp_path / "progress" / "commits").glob("1"), *(tmp_path / "progress" / "commits").glob(".1.crc")]:
        done.unlink()
    assert run() == [(5,), (6,), (7,)]
    assert spark.read.parquet(str(tmp_path / "table")).count() == 4


def test_topics_need_the_connector(spark):
    for source in (frames.frame_topic, detections.message_topic):
        try:
            assert source(spark, "localhost:9092", "t").isStreaming
        except Exception as error:
            assert "kafka" in str(error).lower()
