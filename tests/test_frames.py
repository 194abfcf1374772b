from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyframe.plans import frames

SCHEMA = "frame_id INT, timestamp DOUBLE, person_count INT, process_latency_seconds DOUBLE, total_latency_seconds DOUBLE"


@pytest.fixture(scope="module")
def given(spark):
    rows = [
        (1, 1000.1234, 0, 0.05, 0.1), (2, 1001.0, 4, 0.07, 0.2), (3, 1002.0, 4, None, None), (4, 1003.0, None, 0.03, 0.1),
        (5, 1004.0, 2, 0.05, 0.5), (7, 1006.0, 1, 0.05, 0.5), (1, 1007.0, 1, 0.05, 0.5),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_summary(rows, given):
    assert rows(frames.summary(given)) == [(7, 12, 2.0, 4, 50.0)]


def test_peaks_in_order(rows, given):
    assert rows(frames.peak_frames(given), "frame_id", ordered=True) == [(2,), (3,)]
    assert rows(frames.peak_frames(given, 1), "frame_id", ordered=True) == [(2,), (3,), (5,), (1,), (7,)]


def test_moving_average_over_repeated_and_missing_numbers(rows, given):
    found = rows(frames.rolling_average(given, partitions=3), "frame_id", "Rolling_Avg_Count")
    assert found == [(1, 1.67), (1, 2.25), (2, 2.25), (3, 2.75), (4, 2.75), (5, 2.33), (7, 1.5)]


def test_log_fills_missing_numbers(rows, given):
    found = rows(frames.detection_log(given), ordered=True)
    assert found[0] == (1, 1000.123, "1970-01-01 00:16:40", 0, 50.0, 100.0)
    assert found[3][3:] == (4, 0.0, 0.0) and found[4][3] == 0


def test_report_figures(given):
    figures = frames.report_figures(given).first().asDict()
    assert (figures["Total_Frames"], figures["Total_Detections"], figures["Max_Count"], figures["Min_Count"]) == (7, 12, 4, 0)
    assert (figures["Peak_Frame"], figures["Peak_Time"]) == (2, "1970-01-01 00:16:41")
    assert figures["Detection_Rate_Pct"] == pytest.approx(500 / 7)
    assert figures["Average_Latency_ms"] == pytest.approx(300 / 7) and figures["FPS"] == pytest.approx(1000 * 7 / 300)
    assert figures["Max_Latency_ms"] == 70.0


def test_distribution(rows, given):
    found = rows(frames.distribution(given), "person_count", "frames", "bar", ordered=True)
    assert found == [(0, 2, "#" * 14), (1, 2, "#" * 14), (2, 1, "#" * 7), (4, 2, "#" * 14)]


def test_report_lines(rows, given):
    lines = [value for (value,) in rows(frames.report_lines(given), "value", ordered=True)]
    assert lines[:3] == ["--- THỐNG KÊ TỔNG QUAN ---", "  Tổng số frame xử lý   : 7", "  Tổng lượt phát hiện   : 12"]
    assert "  Frame đông nhất       : #2 lúc 1970-01-01 00:16:41" in lines
    assert "  FPS tương đương       : ~23.3 FPS" in lines
    assert lines[-1] == "  4 người :     2 frames ( 28.6%) " + "#" * 14 and len(lines) == 4 + 10 + 4


def test_report_text(rows, given):
    made = F.lit("2024-02-29 08:30:00").cast("timestamp")
    lines = [value for (value,) in rows(frames.report_text(given, made, ("--- FILES ---", "  a")), "value", ordered=True)]
    body = [value for (value,) in rows(frames.report_lines(given), "value", ordered=True)]
    rule = "=" * 60
    assert lines[:6] == [rule, frames.REPORT_TITLE, rule, "  Thời gian tạo báo cáo : 2024-02-29 08:30:00", "", body[0]]
    assert lines[-6:] == [body[-1], "", "--- FILES ---", "  a", "", rule]
    assert [line for line in lines[5:-5] if line] == body
    assert [lines[at - 1] for at, line in enumerate(lines) if line.startswith("---")] == [""] * 5


def test_report_of_no_frames(rows, spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(frames.report_lines(empty)) == [] and rows(frames.report_text(empty)) == []
    assert rows(frames.summary(empty)) == [(0, None, None, None, None)]


def test_live_metrics_and_trend(rows, given):
    assert rows(frames.live_metrics(given)) == [(1, 50.0, "00:16:47", 7)]
    assert rows(frames.recent_trend(given, 3), "frame_id", "time", ordered=True) == [(5, "00:16:44"), (7, "00:16:46"), (1, "00:16:47")]


def test_result_does_not_depend_on_the_number_of_partitions(rows, given):
    many = given.repartition(7, F.rand(1))
    for plan in (frames.summary, frames.report_figures, frames.rolling_average, frames.distribution):
        assert rows(plan(given)) == rows(plan(many))
