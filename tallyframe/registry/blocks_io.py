"""Sources and sinks. Files are written by Spark from the given tables and read back whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.rows import union_all
from tallyframe.plans import frames, ratings, reviews, sales
from tallyframe.registry.core import query
from tallyframe.registry.flows import DISTRIBUTION_SQL, INGEST_SQL, LOG_SQL, REPORT_SQL, stored_detections
from tallyframe.registry.tables import Tables
from tallyframe.sinks import files as sinks
from tallyframe.sources import delimited
from tallyframe.sources import files as sources
from tallyframe.streaming import detections
from tallyframe.streaming.frames import decode_headers


def _written_lines(t: Tables, lines: DataFrame, label: str) -> str:
    path = t.scratch(label)
    sinks.write_lines(lines, path)
    return path


# Sources ---------------------------------------------------------------------------------------

query(
    "src_1",
    lambda t: delimited.read_delimited_auto(t.spark, _written_lines(t, t.rating_lines(), "ratings"), delimited.RATINGS),
    "SELECT l_suppkey AS user_id, movie_id, rating, ts FROM rating_rows",
    "rating_rows",
)
_HEADERS = """WHEN l_linenumber = 3 AND l_returnflag = 'R' THEN 'UserID,MovieID,Rating,Timestamp'
              WHEN l_linenumber = 4 AND l_returnflag = 'N' THEN '  ' """
query(
    "src_2",
    lambda t: delimited.parse_lines(t.rating_lines(instead=_HEADERS), delimited.RATINGS),
    """SELECT l_suppkey AS user_id, movie_id, rating, ts FROM rating_rows
       WHERE NOT (l_linenumber = 3 AND l_returnflag = 'R') AND NOT (l_linenumber = 4 AND l_returnflag = 'N')""",
    "rating_rows",
)
_MALFORMED = """WHEN l_linenumber = 1 AND l_returnflag = 'R' THEN concat(l_suppkey, ',', movie_id, ',,,')
                WHEN l_linenumber = 2 AND l_returnflag = 'N' THEN concat_ws('::', l_suppkey, movie_id, 'good', ts) """
_BAD_TIME = "WHEN l_linenumber = 1 THEN concat_ws('::', l_suppkey, movie_id, rating, 'soon') "


def _both_modes(t: Tables) -> DataFrame:
    """Lines with errors where those are dropped, faultless lines where an error would stop the job, and
    lines with bad times for a report that reads no times."""
    dropped = delimited.parse_lines(t.rating_lines(instead=_MALFORMED), delimited.RATINGS, "drop")
    strict = delimited.parse_lines(t.rating_lines(), delimited.RATINGS, "fail")
    late = delimited.parse_lines(t.rating_lines(instead=_BAD_TIME), delimited.RATINGS, "late")
    read = delimited.demand(late, "movie_id", "rating")
    parts = {"drop": dropped, "fail": strict, "late": read}
    both = union_all(*[part.select("movie_id", "rating", F.lit(mode).alias("mode")) for mode, part in parts.items()])
    return both.groupBy("mode", "movie_id").agg(F.avg("rating").alias("avg"), F.count("rating").alias("n"))


query(
    "src_3",
    _both_modes,
    """SELECT 'drop' AS mode, movie_id, avg(rating) AS avg, count(*) AS n FROM rating_rows
       WHERE NOT (l_linenumber = 1 AND l_returnflag = 'R') AND NOT (l_linenumber = 2 AND l_returnflag = 'N') GROUP BY 2
       UNION ALL SELECT unnest(['fail', 'late']), movie_id, avg(rating), count(*) FROM rating_rows GROUP BY 2""",
    "rating_rows",
)


def _two_files(t: Tables) -> DataFrame:
    halves = ["l_linenumber <= 3", "l_linenumber > 3"]
    paths = [_written_lines(t, t.rating_lines(t.rating_rows.where(half)), "ratings") for half in halves]
    return delimited.read_delimited_auto(t.spark, paths, delimited.RATINGS)


query("src_4", _two_files, "SELECT l_suppkey AS user_id, movie_id, rating, ts FROM rating_rows", "rating_rows")


def _semicolon(t: Tables) -> DataFrame:
    number = "CASE WHEN id % 10 = 3 THEN concat('x', id) ELSE CAST(id + CAST(id % 2 AS BIGINT) * 3000000000 AS STRING) END"
    text = r"regexp_replace(review, '[;\r\n]', ' ')"
    lines = t.reviews.selectExpr(f"concat_ws(';', {number}, {text}, category, aspect, sentiment) AS value")
    read = sources.read_semicolon_typed(t.spark, _written_lines(t, lines, "reviews"))
    return read.select("id", F.md5("review").alias("review_md5"), "category", "aspect", "sentiment")


query(
    "src_5",
    _semicolon,
    r"""SELECT CASE WHEN id % 10 <> 3 THEN CAST(id + CAST(id % 2 AS BIGINT) * 3000000000 AS BIGINT) END AS id,
               md5(nullif(regexp_replace(review, '[;\r\n]', ' ', 'g'), '')) AS review_md5, category, aspect, sentiment FROM reviews""",
    "reviews",
)
query(
    "src_6",
    lambda t: sources.read_word_list(
        t.spark,
        _written_lines(
            t, t.given("part").selectExpr("CASE WHEN p_size % 5 = 0 THEN '' ELSE concat(p_name, '\\r') END AS value"), "words"
        ),
    ),
    "SELECT DISTINCT p_name AS stopword FROM part WHERE p_size % 5 <> 0",
)


def _quoted(t: Tables) -> DataFrame:
    path = t.scratch("quoted")
    rows = t.given("documents").select("doc_id", "text", "source")
    rows.write.option("header", True).option("sep", ";").option("quoteAll", True).option("escape", '"').csv(path)
    read = sources.read_quoted_csv(t.spark, path, "doc_id BIGINT, text STRING, source STRING")
    return read.select("doc_id", F.md5("text").alias("text_md5"), "source")


query("src_7", _quoted, "SELECT doc_id, md5(text) AS text_md5, source FROM documents")


def _json_lines(t: Tables) -> DataFrame:
    path = t.scratch("json")
    sinks.write_json(t.frames, path)
    return sources.read_json_lines(t.spark, path).select(*sources.LOG_FIELDS)


_LOG_FIELDS_SQL = 'SELECT frame_id, "timestamp", person_count, process_latency_seconds, total_latency_seconds FROM frames'
query("src_8", _json_lines, _LOG_FIELDS_SQL, "frames")


def _projected(t: Tables) -> DataFrame:
    path = t.scratch("stored")
    t.frames.write.parquet(path)
    return sources.read_detections(t.spark, path, sources.LOG_FIELDS[:4])


query("src_9", _projected, 'SELECT frame_id, "timestamp", person_count, process_latency_seconds FROM frames', "frames")
query(
    "src_10",
    lambda t: decode_headers(t.frame_messages).select("frame_id", "timestamp", "source", F.length("value").alias("bytes")),
    """SELECT CASE WHEN k % 7 = 0 OR k % 11 <> 0 THEN CAST(event_id AS BIGINT) END AS frame_id, epoch_us(ts) / 1e6 AS "timestamp",
              CASE WHEN k % 7 = 0 THEN 'unknown' ELSE event_type END AS source,
              CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS bytes FROM keyed_events""",
    "keyed_events",
)


def _messages(t: Tables) -> DataFrame:
    """Both tables of the storage job: records, some with fields left out or of another type, and rejects."""
    whole = F.to_json(F.struct("frame_id", "timestamp", "person_count", "process_latency_seconds"))
    only_time = F.to_json(F.struct("timestamp"))
    unknown = F.to_json(F.struct(F.lit("unknown").alias("frame_id"), "timestamp", "person_count", F.array("frame_id").alias("process_latency_seconds")))
    number = F.col("frame_id") % 9
    value = F.when(number == 0, "{not json").when(number == 1, only_time).when(number == 2, unknown).when(number == 3, "[1]").otherwise(whole)
    folder, table, rejects = t.scratch("messages"), t.scratch("records"), t.scratch("rejects")
    t.frames.select(value.alias("value")).write.text(folder)
    started = detections.store_detections(detections.message_files(t.spark, folder), table, t.scratch("progress"), {"availableNow": True}, rejects)
    started.awaitTermination()
    names = ["frame_id", "timestamp", "person_count", "process_latency_seconds"]
    stored, refused = t.spark.read.parquet(table).select(*names), t.spark.read.parquet(rejects).select("value", "reason")
    return stored.unionByName(refused, allowMissingColumns=True)


query(
    "src_11",
    _messages,
    """SELECT CASE WHEN frame_id % 9 > 2 THEN frame_id ELSE -1 END AS frame_id, "timestamp",
              CASE WHEN frame_id % 9 = 1 THEN 0 ELSE person_count END AS person_count,
              CASE WHEN frame_id % 9 < 3 THEN 0 ELSE coalesce(process_latency_seconds, 0) END AS process_latency_seconds,
              CAST(NULL AS VARCHAR) AS value, CAST(NULL AS VARCHAR) AS reason
       FROM frames WHERE frame_id % 9 NOT IN (0, 3)
       UNION ALL
       SELECT NULL, NULL, NULL, NULL, CASE WHEN frame_id % 9 = 0 THEN '{not json' ELSE '[1]' END,
              CASE WHEN frame_id % 9 = 0 THEN 'no JSON' ELSE 'no JSON object' END
       FROM frames WHERE frame_id % 9 IN (0, 3)""",
    "frames",
)
query(
    "src_12",
    lambda t: delimited.read_delimited_auto(
        t.spark,
        _written_lines(t, t.users.selectExpr("concat_ws(', ', user_id, gender, age, occupation, '00000') AS value"), "users"),
        delimited.USERS,
    ),
    "SELECT user_id, gender, age, occupation, '00000' AS zip_code FROM users",
    "users",
)

# Sinks -----------------------------------------------------------------------------------------

# Two-decimal text of a mean of half points, ties away from zero.
_CENTS = "((CAST(sum(rating) * 200 AS BIGINT) + count(*)) // (2 * count(*)))"
HALF_UP_TEXT = f"printf('%d.%02d', {_CENTS} // 100, {_CENTS} % 100)"


def _lines_back(t: Tables, df: DataFrame, line=None) -> DataFrame:
    path = t.scratch("lines")
    sinks.write_lines(df, path, line)
    return t.spark.read.text(path)


query(
    "snk_1",
    lambda t: _lines_back(t, ratings.movie_average_all(t.movies, t.ratings), ratings.movie_average_line()),
    f"""SELECT title || ' AverageRating: ' || avg || ' (TotalRatings: ' || n || ')' AS value FROM (
        SELECT movie_id, coalesce(title, 'Unknown Movie') AS title, {HALF_UP_TEXT} AS avg, count(*) AS n
        FROM ratings LEFT JOIN movies USING (movie_id) GROUP BY movie_id, title)""",
    "movies ratings",
)


def _tabbed(t: Tables) -> DataFrame:
    path = t.scratch("counts")
    sinks.write_delimited(reviews.rows_per(t.reviews, "category"), path)
    return t.spark.read.text(path)


query("snk_2", _tabbed, "SELECT category || chr(9) || count(id) AS value FROM reviews GROUP BY category", "reviews")


def _titled(t: Tables) -> DataFrame:
    path = t.scratch("report")
    sinks.save_result(sales.orders_by_month(t.orders), path, "Orders per month")
    return t.spark.read.schema("Ten_Bai STRING, Purchase_Year INT, Purchase_Month INT, Total_Orders BIGINT").csv(path, header=True)


query(
    "snk_3",
    _titled,
    """SELECT 'Orders per month' AS Ten_Bai, CAST(year(Order_Purchase_TS) AS INTEGER) AS Purchase_Year,
              CAST(month(Order_Purchase_TS) AS INTEGER) AS Purchase_Month, count(DISTINCT Order_ID) AS Total_Orders
       FROM shop_orders GROUP BY ALL""",
    "shop_orders",
)


def _replaced(t: Tables) -> DataFrame:
    path = t.scratch("report")
    for least in (0, 4):
        sinks.overwrite_csv(frames.peak_frames(t.frames, least), path)
    return t.spark.read.schema("frame_id BIGINT, person_count INT, process_latency_seconds DOUBLE").csv(path, header=True)


query(
    "snk_4",
    _replaced,
    "SELECT frame_id, person_count, process_latency_seconds FROM frames WHERE person_count >= 4",
    "frames",
)
query(
    "snk_5",
    lambda t: stored_detections(t).where("inserted_at > timestamp'2020-01-01'").select(
        "frame_id", F.col("datetime").cast("timestamp_ntz").alias("datetime")
    ),
    f"SELECT frame_id, datetime FROM ({INGEST_SQL})",
    "frames",
)
BOXES = """CASE WHEN k % 5 > 0 THEN transform(sequence(0, k % 5 - 1),
             i -> named_struct('box', array(10 * i, 0, 10 * i + 8, 16), 'confidence', 0.5D + i / 16)) ELSE array() END"""
BOXES_SQL = "[{'box': [10 * i, 0, 10 * i + 8, 16], 'confidence': 0.5::DOUBLE + i / 16} FOR i IN range(k % 5)]"


def boxed_events(t: Tables) -> DataFrame:
    keyed = t.keyed_events.selectExpr("CAST(event_id AS BIGINT) AS frame_id", "k")
    return keyed.selectExpr("frame_id", "k", f"{BOXES} AS detections")


query(
    "snk_6",
    lambda t: _lines_back(t, sinks.as_json(boxed_events(t).select("frame_id", F.size("detections").alias("person_count"), "detections"))),
    f"""SELECT CAST(to_json({{'frame_id': event_id, 'person_count': k % 5, 'detections': {BOXES_SQL}}}) AS VARCHAR) AS value
        FROM keyed_events""",
    "keyed_events",
)


def _log_back(t: Tables) -> DataFrame:
    path, log = t.scratch("log"), frames.detection_log(t.frames)
    sinks.overwrite_csv(log, path)
    return t.spark.read.schema(log.schema).csv(path, header=True)


query("snk_7", _log_back, LOG_SQL, "frames")
query(
    "snk_8",
    lambda t: _lines_back(t, frames.report_text(t.frames, F.lit("2024-02-29 08:30:00").cast("timestamp")).select("value")),
    f"""WITH report AS ({REPORT_SQL}), shares AS ({DISTRIBUTION_SQL}) SELECT unnest([
        repeat('=', 60), '  BÁO CÁO KẾT QUẢ - HỆ THỐNG ĐẾM NGƯỜI TỪ CAMERA', repeat('=', 60),
        '  Thời gian tạo báo cáo : 2024-02-29 08:30:00', '', '', '', '', '',
        '--- FILE KẾT QUẢ ---',
        '  results/detection_log.csv       - Log chi tiết từng frame',
        '  spark_outputs/summary_stats/    - Thống kê tổng hợp (Spark)',
        '  spark_outputs/rolling_averages/ - Rolling average (Spark)',
        '  spark_outputs/peak_frames/      - Các frame đông người (Spark)',
        '', repeat('=', 60),
        '--- THỐNG KÊ TỔNG QUAN ---',
        '  Tổng số frame xử lý   : ' || format('{{:,}}', "Total_Frames"),
        '  Tổng lượt phát hiện   : ' || format('{{:,}}', "Total_Detections"),
        '  Tỉ lệ frame có người  : ' || printf('%.1f', "Detection_Rate_Pct") || '%',
        '--- SỐ LƯỢNG NGƯỜI (PER FRAME) ---',
        '  Trung bình            : ' || printf('%.2f', "Average_Count") || ' người/frame',
        '  Cao nhất (peak)       : ' || "Max_Count" || ' người',
        '  Thấp nhất             : ' || "Min_Count" || ' người',
        '  Frame đông nhất       : #' || "Peak_Frame" || ' lúc ' || "Peak_Time",
        '--- HIỆU NĂNG XỬ LÝ ---',
        '  Latency trung bình    : ' || printf('%.1f', "Average_Latency_ms") || ' ms',
        '  Latency cao nhất      : ' || printf('%.1f', "Max_Latency_ms") || ' ms',
        '  FPS tương đương       : ~' || printf('%.1f', "FPS") || ' FPS',
        '--- PHÂN PHỐI SỐ NGƯỜI ---']) AS value FROM report
        UNION ALL SELECT '  ' || person_count || ' người : ' || printf('%5d', frames) || ' frames (' || printf('%5.1f', pct) || '%) ' || bar
        FROM shares""",
    "frames",
)
