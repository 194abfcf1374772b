"""Camera frames: summary, peaks, moving average, detection log, report and live figures.

Table: detections(frame_id, timestamp, person_count, process_latency_seconds,
total_latency_seconds), with the timestamp in epoch seconds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.numbers import exact_mean, nanoseconds, to_millis
from tallyframe.functions.text import fixed1_half_even, fixed2_half_even, percent_bar, thousands
from tallyframe.functions.times import CLOCK_FORMAT, epoch_text
from tallyframe.operators.aggregates import count_with_share, share_of_rows
from tallyframe.operators.ordered import centred_average
from tallyframe.operators.rows import latest_ascending, union_all

# Section names of the report.
OVERALL = "THỐNG KÊ TỔNG QUAN"
PEOPLE = "SỐ LƯỢNG NGƯỜI (PER FRAME)"
SPEED = "HIỆU NĂNG XỬ LÝ"
SPREAD = "PHÂN PHỐI SỐ NGƯỜI"

# What frames the report.
RULE = "=" * 60
REPORT_TITLE = "  BÁO CÁO KẾT QUẢ - HỆ THỐNG ĐẾM NGƯỜI TỪ CAMERA"
REPORT_MADE = "  Thời gian tạo báo cáo : "
REPORT_FILES = (
    "--- FILE KẾT QUẢ ---",
    "  results/detection_log.csv       - Log chi tiết từng frame",
    "  spark_outputs/summary_stats/    - Thống kê tổng hợp (Spark)",
    "  spark_outputs/rolling_averages/ - Rolling average (Spark)",
    "  spark_outputs/peak_frames/      - Các frame đông người (Spark)",
)


def summary(frames: DataFrame) -> DataFrame:
    return frames.agg(
        F.count("frame_id").alias("Total_Frames"),
        F.sum("person_count").alias("Total_People_Detected"),
        exact_mean(F.col("person_count"), 2).cast("double").alias("Average_Person_Count"),
        F.max("person_count").alias("Peak_Person_Count"),
        (exact_mean(nanoseconds(F.col("process_latency_seconds")), -4).cast("double") / 1e6).alias("Avg_Latency_ms"),
    )


def peak_frames(frames: DataFrame, least: int = 4) -> DataFrame:
    """Frames with many persons, most first. The time only parts frames with the same number, so
    that a number that repeats very often is no single sort task."""
    peaks = frames.where(F.col("person_count") >= least)
    ordered = peaks.orderBy(F.desc("person_count"), F.asc("frame_id"), F.asc("timestamp"))
    return ordered.select("frame_id", "person_count", "process_latency_seconds")


def rolling_average(frames: DataFrame, groups: tuple[str, ...] = (), partitions: int | None = None) -> DataFrame:
    """Mean count over two frames before to two after, by frame and time, per group if named."""
    columns = ["frame_id", "person_count", "process_latency_seconds"]
    slim = frames.select(*groups, "timestamp", *columns)
    order = [F.asc("frame_id"), F.asc("timestamp")]
    averaged = centred_average(slim, order, "person_count", "Rolling_Avg_Count", groups=groups, partitions=partitions)
    rounded = F.round("Rolling_Avg_Count", 2).alias("Rolling_Avg_Count")
    return averaged.select(*groups, "frame_id", "person_count", rounded, "process_latency_seconds")


def detection_log(frames: DataFrame) -> DataFrame:
    """The log in frame order, latencies in milliseconds; missing numbers count as zero.

    The rows are sorted before they are formatted, as finding the borders of the sort reads its
    input once more. The time parts frames with the same number, which may be very many.
    """
    ordered = frames.orderBy("frame_id", "timestamp")
    seconds = F.coalesce("timestamp", F.lit(0.0))

    def millis(column: str) -> Column:
        return to_millis(F.coalesce(column, F.lit(0.0)), 2)

    return ordered.select(
        "frame_id",
        F.round(seconds, 3).alias("timestamp"),
        epoch_text(seconds).alias("datetime"),
        F.coalesce("person_count", F.lit(0)).alias("person_count"),
        millis("process_latency_seconds").alias("process_latency_ms"),
        millis("total_latency_seconds").alias("total_latency_ms"),
    )


def report_figures(frames: DataFrame) -> DataFrame:
    """All figures of the report in one pass; the first frame wins among equal peaks."""
    count = F.coalesce("person_count", F.lit(0))
    latency = F.coalesce("process_latency_seconds", F.lit(0.0))
    peak = F.max_by(F.struct("frame_id", "timestamp"), F.struct(count, -F.col("frame_id"), -F.col("timestamp")))
    figures = frames.agg(
        F.count(F.lit(1)).alias("Total_Frames"),
        F.sum(count).alias("Total_Detections"),
        share_of_rows(count > 0).alias("Detection_Rate_Pct"),
        F.avg(count).alias("Average_Count"),
        F.max(count).alias("Max_Count"),
        F.min(count).alias("Min_Count"),
        peak.alias("_peak"),
        F.try_divide(F.sum(nanoseconds(latency)).cast("double") / 1e6, F.count(F.lit(1))).alias("Average_Latency_ms"),
        to_millis(F.max(latency)).alias("Max_Latency_ms"),
    )
    return figures.select(
        *[name for name in figures.columns if name != "_peak"],
        F.col("_peak.frame_id").alias("Peak_Frame"),
        epoch_text(F.coalesce("_peak.timestamp", F.lit(0.0))).alias("Peak_Time"),
        F.try_divide(F.lit(1000.0), F.col("Average_Latency_ms")).alias("FPS"),
    )


def distribution(frames: DataFrame) -> DataFrame:
    """Frames per person count, their share and a bar of it."""
    counts = frames.select(F.coalesce("person_count", F.lit(0)).alias("person_count"))
    shares = count_with_share(counts, "person_count", "frames", "pct")
    return shares.withColumn("bar", percent_bar(F.col("pct"))).orderBy("person_count")


def report_rows(frames: DataFrame) -> DataFrame:
    """The report as (section, place, metric, value) rows."""
    one = report_figures(frames)
    # Metric names and units of the report.
    entries = [
        (OVERALL, "Tổng số frame xử lý", thousands(F.col("Total_Frames"))),
        (OVERALL, "Tổng lượt phát hiện", thousands(F.col("Total_Detections"))),
        (OVERALL, "Tỉ lệ frame có người", F.concat(fixed1_half_even(F.col("Detection_Rate_Pct")), F.lit("%"))),
        (PEOPLE, "Trung bình", F.concat(fixed2_half_even(F.col("Average_Count")), F.lit(" người/frame"))),
        (PEOPLE, "Cao nhất (peak)", F.concat(F.col("Max_Count"), F.lit(" người"))),
        (PEOPLE, "Thấp nhất", F.concat(F.col("Min_Count"), F.lit(" người"))),
        (PEOPLE, "Frame đông nhất", F.concat(F.lit("#"), F.col("Peak_Frame"), F.lit(" lúc "), F.col("Peak_Time"))),
        (SPEED, "Latency trung bình", F.concat(fixed1_half_even(F.col("Average_Latency_ms")), F.lit(" ms"))),
        (SPEED, "Latency cao nhất", F.concat(fixed1_half_even(F.col("Max_Latency_ms")), F.lit(" ms"))),
        (SPEED, "FPS tương đương", F.concat(F.lit("~"), fixed1_half_even(F.col("FPS")), F.lit(" FPS"))),
    ]
    rows = [
        F.struct(F.lit(section).alias("section"), F.lit(place).alias("place"), F.lit(metric).alias("metric"), value.alias("value"))
        for place, (section, metric, value) in enumerate(entries, start=1)
    ]
    head = one.where("Total_Frames > 0").select(F.inline(F.array(*rows)))
    bars = F.format_string(
        "%5d frames (%5s%%) %s", F.col("frames"), fixed1_half_even(F.col("pct")), F.col("bar")
    )
    tail = distribution(frames).select(
        F.lit(SPREAD).alias("section"),
        (F.col("person_count") + len(entries) + 1).alias("place"),
        F.concat(F.col("person_count"), F.lit(" người")).alias("metric"),
        bars.alias("value"),
    )
    return union_all(head, tail)


def report_lines(frames: DataFrame) -> DataFrame:
    """The report as ordered text lines: a heading where a section starts, then its metrics."""
    rows = report_rows(frames)
    headings = rows.groupBy("section").agg(F.min("place").alias("place")).select(
        "place", F.lit(0).alias("part"), F.concat(F.lit("--- "), F.col("section"), F.lit(" ---")).alias("value")
    )
    body = F.when(F.col("section") == SPREAD, F.concat(F.lit("  "), F.col("metric"), F.lit(" : "), F.col("value"))).otherwise(
        F.concat(F.lit("  "), F.rpad("metric", 22, " "), F.lit(": "), F.col("value"))
    )
    metrics = rows.select("place", F.lit(1).alias("part"), body.alias("value"))
    return union_all(headings, metrics).orderBy("place", "part")


def report_text(frames: DataFrame, created: Column | None = None, files: Sequence[str] = REPORT_FILES) -> DataFrame:
    """The whole report as ordered lines: banner, time of creation (now, if not given), a blank line before
    each section, and the lines on the files. No frames give no lines.

    The frame around the sections hangs on their first heading, so nothing is computed twice for it.
    """
    made = F.concat(F.lit(REPORT_MADE), F.date_format(F.current_timestamp() if created is None else created, "yyyy-MM-dd HH:mm:ss"))
    above = [F.lit(RULE), F.lit(REPORT_TITLE), F.lit(RULE), made, F.lit("")]
    below = [F.lit(text) for text in ("", *files, "", RULE)]

    def line(place: Column, part: Column, value: Column) -> Column:
        return F.struct(place.cast("long").alias("place"), part.cast("long").alias("part"), value.alias("value"))

    place, part = F.col("place"), F.col("part")
    own, last = line(place, part, F.col("value")), F.lit((1 << 63) - 1)
    around = [line(F.lit(0), F.lit(at), text) for at, text in enumerate(above)]
    around += [own, *[line(last, F.lit(at), text) for at, text in enumerate(below)]]
    heading = F.array(line(place, F.lit(-1), F.lit("")), own)
    every = F.when((place == 1) & (part == 0), F.array(*around)).when(part == 0, heading).otherwise(F.array(own))
    return report_lines(frames).select(F.inline(every)).orderBy("place", "part")


def live_metrics(frames: DataFrame) -> DataFrame:
    """Count, latency and time of the newest frame, and the number of frames."""
    newest = F.max_by(
        F.struct("frame_id", "timestamp", "person_count", "process_latency_seconds"), F.struct("timestamp", "frame_id")
    )
    return frames.agg(newest.alias("last"), F.count(F.lit(1)).alias("total_records")).select(
        F.coalesce("last.person_count", F.lit(0)).alias("current_count"),
        to_millis(F.coalesce("last.process_latency_seconds", F.lit(0.0))).alias("latency_ms"),
        epoch_text(F.col("last.timestamp"), CLOCK_FORMAT).alias("latest_time"),
        "total_records",
    )


def recent_trend(frames: DataFrame, k: int = 50) -> DataFrame:
    """The newest ``k`` frames, oldest first, with the clock time."""
    slim = frames.select("frame_id", "timestamp", "person_count", "process_latency_seconds")
    newest = [F.desc("timestamp"), F.desc("frame_id")]
    recent = latest_ascending(slim, k, newest, [F.asc("timestamp"), F.asc("frame_id")])
    return recent.select(
        epoch_text(F.col("timestamp"), CLOCK_FORMAT).alias("time"),
        epoch_text(F.col("timestamp")).alias("datetime"),
        "frame_id",
        "timestamp",
        "person_count",
        "process_latency_seconds",
    )
