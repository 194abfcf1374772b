"""The end-to-end analyses."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.plans import frames, ratings, reviews, sales
from tallyframe.registry.core import half_up, mean_cents, query
from tallyframe.registry.tables import Tables
from tallyframe.sinks.files import as_json, write_json
from tallyframe.streaming import detections, live
from tallyframe.streaming import frames as frame_stream

# Ratings ---------------------------------------------------------------------------------------

_TITLED = "coalesce(title, 'Unknown Movie') AS title"

query(
    "rat_01",
    lambda t: ratings.movie_average_all(t.movies, t.ratings),
    f"""SELECT movie_id, {_TITLED}, avg(rating) AS avg, count(*) AS n
        FROM ratings LEFT JOIN movies USING (movie_id) GROUP BY ALL""",
    "movies ratings",
)
query(
    "rat_02",
    lambda t: ratings.best_movie(t.movies, t.ratings),
    f"""SELECT {_TITLED}, avg FROM (SELECT movie_id, avg(rating) AS avg FROM ratings GROUP BY movie_id HAVING count(*) >= 5)
        LEFT JOIN movies USING (movie_id) ORDER BY avg DESC, CAST(movie_id AS VARCHAR) LIMIT 1""",
    "movies ratings",
)
_GENRE = """SELECT genre, avg(rating) AS avg, count(*) AS n
    FROM ratings JOIN (SELECT movie_id, {item} AS genre FROM (SELECT movie_id, unnest(string_split(genres, '|')) AS item FROM movies))
    USING (movie_id) GROUP BY genre"""
query("rat_03", lambda t: ratings.genre_average(t.movies, t.ratings), _GENRE.format(item="trim(item)"), "movies ratings")
query(
    "rat_04",
    lambda t: ratings.gender_average_wide(t.movies, t.user_ratings, t.users),
    f"""SELECT movie_id, {_TITLED}, coalesce(avg(rating) FILTER (upper(gender) = 'M'), 0) AS male_avg,
               coalesce(avg(rating) FILTER (upper(gender) = 'F'), 0) AS female_avg
        FROM ratings JOIN users USING (user_id) LEFT JOIN movies USING (movie_id)
        WHERE upper(gender) IN ('M', 'F') GROUP BY ALL""",
    "movies ratings users",
)
query(
    "rat_05",
    lambda t: ratings.age_average_wide(t.movies, t.user_ratings, t.users),
    f"""SELECT movie_id, {_TITLED}, avg(rating) FILTER (age <= 18) AS age_0_18, avg(rating) FILTER (age > 18 AND age <= 35) AS age_18_35,
               avg(rating) FILTER (age > 35 AND age <= 50) AS age_35_50, avg(rating) FILTER (age > 50) AS age_50_plus
        FROM ratings JOIN users USING (user_id) LEFT JOIN movies USING (movie_id) GROUP BY movie_id, title""",
    "movies ratings users",
)
query(
    "rat_06",
    lambda t: ratings.movie_average(t.movies, t.ratings),
    "SELECT movie_id, title, avg(rating) AS avg, count(*) AS n FROM ratings JOIN movies USING (movie_id) GROUP BY ALL",
    "movies ratings",
)
query(
    "rat_07",
    lambda t: ratings.best_movie_known(t.movies, t.ratings, least=40),
    """SELECT movie_id, title, avg(rating) AS avg, count(*) AS n FROM ratings JOIN movies USING (movie_id)
       GROUP BY ALL HAVING count(*) >= 40 ORDER BY avg DESC, movie_id LIMIT 1""",
    "movies ratings",
)
query("rat_08", lambda t: ratings.genre_average(t.movies, t.ratings, trimmed=False), _GENRE.format(item="item"), "movies ratings")
query(
    "rat_09",
    lambda t: ratings.gender_average(t.movies, t.user_ratings, t.users),
    """SELECT movie_id, title, gender, avg(rating) AS avg, count(*) AS n
       FROM ratings JOIN users USING (user_id) JOIN movies USING (movie_id) GROUP BY ALL""",
    "movies ratings users",
)
AGE_CODE_SQL = """CASE age WHEN 1 THEN 'Under 18' WHEN 18 THEN '18-24' WHEN 25 THEN '25-34' WHEN 35 THEN '35-44'
    WHEN 45 THEN '45-49' WHEN 50 THEN '50-55' WHEN 56 THEN '56+' ELSE 'Unknown' END"""
query(
    "rat_10",
    lambda t: ratings.age_code_average(t.movies, t.user_ratings, t.users),
    f"""SELECT movie_id, title, {AGE_CODE_SQL} AS age_group, avg(rating) AS avg, count(*) AS n
        FROM ratings JOIN users USING (user_id) JOIN movies USING (movie_id) GROUP BY ALL""",
    "movies ratings users",
)
query(
    "rat_11",
    lambda t: ratings.occupation_average(t.user_ratings, t.users, t.occupations),
    """SELECT occupation_name, avg(rating) AS avg, count(*) AS n
       FROM ratings JOIN users USING (user_id) JOIN occupations USING (occupation) GROUP BY occupation_name""",
    "ratings users occupations",
)
query(
    "rat_12",
    lambda t: ratings.year_average(t.ratings),
    "SELECT CAST(year(make_timestamp(ts * 1000000)) AS INTEGER) AS year, avg(rating) AS avg, count(*) AS n FROM rating_rows GROUP BY 1",
    "rating_rows",
)

# Reviews ---------------------------------------------------------------------------------------


def words_sql(columns: str, distinct: str, where: str = "") -> str:
    """SQL for the content words of the distinct rows over ``distinct``."""
    return f"""SELECT {columns}, word FROM (
        SELECT {columns}, unnest(string_split(clean, ' ')) AS word FROM (SELECT DISTINCT {distinct}, clean FROM cleaned {where}))
        WHERE word <> '' AND word NOT IN (SELECT stopword FROM stopwords)"""


query(
    "rev_01",
    lambda t: reviews.review_words(t.reviews, t.stopwords),
    words_sql("id, category, aspect, sentiment", "id, review, category, aspect, sentiment"),
    "cleaned stopwords",
)
query(
    "rev_02",
    lambda t: reviews.frequent_words(t.reviews, t.stopwords),
    f"SELECT word, count(*) AS freq FROM ({words_sql('id', 'id, review')}) GROUP BY word HAVING count(*) > 500",
    "cleaned stopwords",
)
query(
    "rev_03",
    lambda t: reviews.rows_per(t.reviews, "category"),
    "SELECT category, count(id) AS total_comments FROM reviews GROUP BY category",
    "reviews",
)
query(
    "rev_04",
    lambda t: reviews.rows_per(t.reviews, "aspect"),
    "SELECT aspect, count(id) AS total_comments FROM reviews GROUP BY aspect",
    "reviews",
)
for _number, _most, _kind in (("05", "07", "negative"), ("06", "08", "positive")):
    _counts = f"SELECT aspect, count(id) AS total_{_kind} FROM reviews WHERE sentiment = '{_kind}' GROUP BY aspect"
    query(
        f"rev_{_number}",
        lambda t, kind=_kind: reviews.rows_per(t.reviews, "aspect", kind, f"total_{kind}"),
        _counts,
        "reviews",
    )
    query(
        f"rev_{_most}",
        lambda t, kind=_kind: reviews.most_of(
            reviews.rows_per(t.reviews, "aspect", kind, f"total_{kind}"), "aspect", f"total_{kind}"
        ),
        f"{_counts} ORDER BY 2 DESC, 1 LIMIT 1",
        "reviews",
    )
for _number, _kind in (("09", "positive"), ("10", "negative")):
    _words = words_sql("category, sentiment", "id, review, category, sentiment", f"WHERE sentiment = '{_kind}'")
    query(
        f"rev_{_number}",
        lambda t, kind=_kind: reviews.top_words(t.reviews, t.stopwords, sentiment=kind),
        f"""SELECT category, sentiment, word, count(*) AS freq FROM ({_words}) GROUP BY category, sentiment, word
            QUALIFY row_number() OVER (PARTITION BY category ORDER BY freq DESC, word) <= 5""",
        "cleaned stopwords",
    )
query(
    "rev_11",
    lambda t: reviews.top_words(t.reviews, t.stopwords),
    f"""SELECT category, word, count(*) AS freq FROM ({words_sql("category", "id, review, category")}) GROUP BY category, word
        QUALIFY row_number() OVER (PARTITION BY category ORDER BY freq DESC, word) <= 5""",
    "cleaned stopwords",
)

# Sales -----------------------------------------------------------------------------------------


def _typed_rows(t: Tables) -> DataFrame:
    """Orders with five parsed times next to items with their revenue, one row per item."""
    orders = sales.clean_orders(t.raw_orders).select("Order_ID", "Customer_Trx_ID", *sales.ORDER_TIMES.values())
    revenue = sales.item_revenue().cast("double").alias("Item_Revenue")
    rows = t.items.select("Order_ID", "Order_Item_ID", "Product_ID", "Seller_ID", revenue).join(orders, "Order_ID")
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in sales.ORDER_TIMES.values()})


query(
    "sal_01",
    _typed_rows,
    """SELECT i.Order_ID, Order_Item_ID, Product_ID, Seller_ID, CAST(Item_Revenue AS DOUBLE) AS Item_Revenue, Customer_Trx_ID,
              Order_Purchase_TS,
              CASE WHEN Order_Status <> 'P' THEN Order_Purchase_TS + to_minutes(8 * 60 + 15) END AS Order_Approved_TS,
              CASE WHEN Order_Status <> 'P' THEN Order_Purchase_TS + to_minutes(17 * 60 + 5) END AS Order_Delivered_Carrier_TS,
              CASE WHEN Order_Status = 'F' THEN Order_Purchase_TS + to_minutes(23 * 60 + 59) END AS Order_Delivered_Customer_TS,
              Order_Purchase_TS + to_minutes(10 * 60 + 30) AS Order_Estimated_Delivery_TS
       FROM shop_items i JOIN shop_orders USING (Order_ID)""",
    "shop_items shop_orders",
)
query(
    "sal_02",
    lambda t: sales.overview(t.orders, t.customers, t.items),
    f"""SELECT '{sales.METRIC_ORDERS}' AS "Metric", (SELECT count(*) FROM (SELECT DISTINCT Order_ID FROM shop_orders)) AS "Value"
        UNION ALL SELECT '{sales.METRIC_CUSTOMERS}', (SELECT count(*) FROM (SELECT DISTINCT Customer_Trx_ID FROM shop_customers))
        UNION ALL SELECT '{sales.METRIC_SELLERS}', (SELECT count(*) FROM (SELECT DISTINCT Seller_ID FROM shop_items))""",
    "shop_orders shop_customers shop_items",
)
query(
    "sal_03",
    lambda t: sales.orders_by_country(t.orders, t.customers),
    """SELECT Customer_Country, Customer_Country_Code, count(DISTINCT Order_ID) AS Total_Orders
       FROM shop_orders LEFT JOIN shop_customers USING (Customer_Trx_ID) GROUP BY ALL""",
    "shop_orders shop_customers",
)
query(
    "sal_04",
    lambda t: sales.orders_by_month(t.orders),
    """SELECT CAST(year(Order_Purchase_TS) AS INTEGER) AS Purchase_Year, CAST(month(Order_Purchase_TS) AS INTEGER) AS Purchase_Month,
              count(DISTINCT Order_ID) AS Total_Orders FROM shop_orders WHERE Order_Purchase_TS IS NOT NULL GROUP BY ALL""",
    "shop_orders",
)
query(
    "sal_05",
    lambda t: sales.review_cleaning(t.order_reviews),
    """SELECT (SELECT count(*) FROM order_reviews) AS "Rows_Before", (SELECT count(*) FROM valid_reviews) AS "Rows_Valid" """,
    "order_reviews valid_reviews",
)
query(
    "sal_06",
    lambda t: sales.average_score(t.order_reviews),
    f"SELECT {half_up('sum(Review_Score_Int)', 'count(*)', 3)} AS Average_Review_Score FROM valid_reviews",
    "valid_reviews",
)
query(
    "sal_07",
    lambda t: sales.score_distribution(t.order_reviews),
    "SELECT Review_Score_Int, count(*) AS Number_Of_Reviews FROM valid_reviews GROUP BY 1",
    "valid_reviews",
)
query(
    "sal_08",
    lambda t: sales.revenue_by_category(t.items, t.orders, t.products, year=2000),
    """SELECT Product_Category_Name, CAST(sum(Item_Revenue) AS DOUBLE) AS Total_Revenue_2000, count(*) AS Total_Items_Sold
       FROM shop_items JOIN shop_orders USING (Order_ID) LEFT JOIN products USING (Product_ID)
       WHERE year(Order_Purchase_TS) = 2000 GROUP BY 1""",
    "shop_items shop_orders products",
)
PRODUCT_SALES_SQL = f"""SELECT Product_ID, Product_Category_Name, count(*) AS Units_Sold,
           {half_up('sum(Review_Score_Int)', 'count(Review_Score_Int)', 3)} AS Average_Review_Score
    FROM shop_items LEFT JOIN products USING (Product_ID) LEFT JOIN valid_reviews USING (Order_ID) GROUP BY ALL"""
query(
    "sal_09",
    lambda t: sales.product_sales(t.items, t.products, t.order_reviews),
    PRODUCT_SALES_SQL,
    "shop_items products valid_reviews",
)
query(
    "sal_10",
    lambda t: sales.best_selling_product(t.items, t.products, t.order_reviews),
    f"{PRODUCT_SALES_SQL} ORDER BY Units_Sold DESC, Average_Review_Score DESC NULLS LAST, Product_ID LIMIT 1",
    "shop_items products valid_reviews",
)
_DELAY = half_up("s", "86400", 2)
DELAYS_SQL = f"""SELECT *, {_DELAY} AS Delivery_Delay_Days,
           CASE WHEN {_DELAY} > 0 THEN 'Late' ELSE 'On time or early' END AS Delivery_Performance
    FROM (SELECT *, date_diff('second', Shipping_Limit_TS, Order_Delivered_Carrier_TS) AS s
          FROM limited_items JOIN shop_orders USING (Order_ID)
          WHERE Order_Delivered_Carrier_TS IS NOT NULL AND Shipping_Limit_TS IS NOT NULL)"""
query(
    "sal_11",
    lambda t: sales.delivery_detail(t.orders, t.limited_items),
    f"""SELECT Order_ID, Order_Status, Order_Delivered_Carrier_TS, Order_Item_ID, Shipping_Limit_TS, Delivery_Delay_Days,
               Delivery_Performance FROM ({DELAYS_SQL})""",
    "limited_items shop_orders",
)
query(
    "sal_12",
    lambda t: sales.delivery_summary(t.orders, t.limited_items),
    f"""SELECT Delivery_Performance, count(*) AS Number_Of_Order_Items,
               {mean_cents("CAST(Delivery_Delay_Days AS DECIMAL(12,2))")} AS Average_Delay_Days,
               min(Delivery_Delay_Days) AS Min_Delay_Days, max(Delivery_Delay_Days) AS Max_Delay_Days
        FROM ({DELAYS_SQL}) GROUP BY 1""",
    "limited_items shop_orders",
)
SEGMENTS_SQL = f"""SELECT *, CASE WHEN Total_Orders > 1
             THEN {half_up("date_diff('day', First_Purchase_TS, Last_Purchase_TS)", "(Total_Orders - 1)", 2)} END AS Purchase_Frequency_Days,
           CASE WHEN Total_Orders >= 4 AND Average_Order_Value >= quantile_disc(Average_Order_Value, 0.75) OVER () THEN 'High-value loyal'
                WHEN Total_Orders >= 4 THEN 'Loyal' WHEN Total_Orders BETWEEN 2 AND 3 THEN 'Repeat' ELSE 'One-time' END AS Customer_Segment
    FROM (SELECT Customer_Trx_ID, count(DISTINCT Order_ID) AS Total_Orders, {mean_cents("Order_Value")} AS Average_Order_Value,
                 min(Order_Purchase_TS) AS First_Purchase_TS, max(Order_Purchase_TS) AS Last_Purchase_TS
          FROM shop_orders LEFT JOIN (SELECT Order_ID, sum(Item_Revenue) AS Order_Value FROM shop_items GROUP BY 1) USING (Order_ID)
          WHERE Order_Purchase_TS IS NOT NULL GROUP BY 1)"""
query("sal_13", lambda t: sales.customer_segments(t.orders, t.items), SEGMENTS_SQL, "shop_orders shop_items")
query(
    "sal_14",
    lambda t: sales.segment_summary(t.orders, t.items),
    f"""SELECT Customer_Segment, count(*) AS Number_Of_Customers, {half_up("sum(Total_Orders)", "count(*)", 2)} AS Avg_Total_Orders,
               {mean_cents("CAST(Average_Order_Value AS DECIMAL(14,2))")} AS Avg_Order_Value,
               {mean_cents("CAST(Purchase_Frequency_Days AS DECIMAL(14,2))")} AS Avg_Frequency_Days
        FROM ({SEGMENTS_SQL}) GROUP BY 1""",
    "shop_orders shop_items",
)
SELLERS_SQL = f"""SELECT Seller_ID, CAST(sum(Item_Revenue) AS DOUBLE) AS Total_Revenue, count(DISTINCT Order_ID) AS Total_Orders,
           count(*) AS Total_Items_Sold, {mean_cents("Item_Revenue")} AS Avg_Item_Revenue FROM shop_items GROUP BY 1"""
query(
    "sal_15",
    lambda t: sales.seller_ranking(t.items),
    f"SELECT *, dense_rank() OVER (ORDER BY Total_Revenue DESC, Total_Orders DESC) AS Seller_Rank FROM ({SELLERS_SQL})",
    "shop_items",
)

# Frames ----------------------------------------------------------------------------------------

query(
    "cam_01",
    lambda t: frames.summary(t.frames),
    f"""SELECT count(frame_id) AS Total_Frames, CAST(sum(person_count) AS BIGINT) AS Total_People_Detected,
               {half_up("sum(person_count)", "count(person_count)", 2)} AS Average_Person_Count, max(person_count) AS Peak_Person_Count,
               {half_up("CAST(sum(CAST(process_latency_seconds AS DECIMAL(18,6))) * 1000000 AS HUGEINT)",
                        "(count(process_latency_seconds) * 1000)", 2)} AS Avg_Latency_ms FROM frames""",
    "frames",
)
query(
    "cam_02",
    lambda t: frames.peak_frames(t.frames),
    "SELECT frame_id, person_count, process_latency_seconds FROM frames WHERE person_count >= 4",
    "frames",
)
query(
    "cam_03",
    lambda t: frames.rolling_average(t.frames),
    """SELECT frame_id, person_count, process_latency_seconds,
              round(avg(person_count) OVER (ORDER BY frame_id, "timestamp" ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 2)
              AS Rolling_Avg_Count FROM frames""",
    "frames",
)
LOG_SQL = """SELECT frame_id, ((epoch_us(ts) + 500) // 1000) / 1000.0 AS "timestamp", strftime(ts, '%Y-%m-%d %H:%M:%S') AS datetime,
       person_count, CAST(round(CAST(coalesce(process_latency_seconds, 0) AS DECIMAL(18,6)) * 1000, 2) AS DOUBLE)
       AS process_latency_ms, CAST(round(CAST(total_latency_seconds AS DECIMAL(18,6)) * 1000, 2) AS DOUBLE) AS total_latency_ms FROM frames"""
query("cam_04", lambda t: frames.detection_log(t.frames), LOG_SQL, "frames")
REPORT_SQL = """SELECT count(*) AS "Total_Frames", CAST(sum(c) AS BIGINT) AS "Total_Detections",
       avg(CASE WHEN c > 0 THEN 100.0 ELSE 0.0 END) AS "Detection_Rate_Pct", avg(c) AS "Average_Count", max(c) AS "Max_Count",
       min(c) AS "Min_Count", CAST(sum(ms) AS DOUBLE) / count(*) AS "Average_Latency_ms", CAST(max(ms) AS DOUBLE) AS "Max_Latency_ms",
       arg_min(frame_id, (-c, frame_id)) AS "Peak_Frame", strftime(arg_min(ts, (-c, frame_id)), '%Y-%m-%d %H:%M:%S') AS "Peak_Time",
       1000 / "Average_Latency_ms" AS "FPS"
  FROM (SELECT *, coalesce(person_count, 0) AS c, CAST(coalesce(process_latency_seconds, 0) AS DECIMAL(18,6)) * 1000 AS ms FROM frames)"""
query("cam_05", lambda t: frames.report_figures(t.frames), REPORT_SQL, "frames")
DISTRIBUTION_SQL = """SELECT person_count, frames, pct, repeat('#', CAST(floor(pct / 2) AS INTEGER)) AS bar FROM (
       SELECT coalesce(person_count, 0) AS person_count, count(*) AS frames,
              count(*) * 100.0::DOUBLE / (SELECT count(*) FROM frames) AS pct FROM frames GROUP BY 1)"""
query("cam_06", lambda t: frames.distribution(t.frames), DISTRIBUTION_SQL, "frames")
LIVE_SQL = """SELECT person_count AS current_count, CAST(CAST(coalesce(process_latency_seconds, 0) AS DECIMAL(18,6)) * 1000 AS DOUBLE)
       AS latency_ms, strftime(ts, '%H:%M:%S') AS latest_time, (SELECT count(*) FROM frames) AS total_records
  FROM frames ORDER BY "timestamp" DESC, frame_id DESC LIMIT 1"""
query("cam_07", lambda t: frames.live_metrics(t.frames), LIVE_SQL, "frames")
TREND_SQL = """SELECT strftime(ts, '%H:%M:%S') AS time, strftime(ts, '%Y-%m-%d %H:%M:%S') AS datetime, frame_id, "timestamp", person_count,
       process_latency_seconds FROM frames ORDER BY "timestamp" DESC, frame_id DESC LIMIT 50"""
query("cam_08", lambda t: frames.recent_trend(t.frames), TREND_SQL, "frames")


def counting_detector(slow: float = 0.0) -> frame_stream.LoadDetector:
    """A stand-in for a model: the payload is the number of persons, each gets a box of its own. Four persons take
    ``slow`` seconds.

    An inner function travels to the tasks by value, so they need not find this package.
    """

    def load() -> frame_stream.Detector:
        def boxes(payload: bytes) -> list[frame_stream.Box] | None:
            try:
                persons = int(payload.decode("utf-8"))
            except ValueError:
                return None
            if slow and persons == 4:
                time.sleep(slow)
            return [((10 * i, 0, 10 * i + 8, 16), 0.5 + i / 16) for i in range(persons)]

        return lambda payloads: map(boxes, payloads)

    return load


def publish_frames(t: Tables) -> str:
    """Write the frame table as JSON messages; gives the folder."""
    folder = t.scratch("messages")
    write_json(t.frames, folder)
    return folder


def stored_detections(t: Tables) -> DataFrame:
    """Run the storage job over the published messages until none is left; gives the table."""
    table = t.scratch("detections")
    messages = detections.message_files(t.spark, publish_frames(t))
    detections.store_detections(messages, table, t.scratch("progress"), {"availableNow": True}, t.scratch("rejects")).awaitTermination()
    return t.spark.read.parquet(table)


def _ingested(t: Tables) -> DataFrame:
    moment = F.col("datetime").cast("timestamp_ntz").alias("datetime")
    rows = stored_detections(t).where("inserted_at is not null")
    return rows.select("frame_id", "timestamp", "person_count", "process_latency_seconds", "total_latency_seconds", moment)


INGEST_SQL = """SELECT frame_id, "timestamp", person_count, coalesce(process_latency_seconds, 0) AS process_latency_seconds, total_latency_seconds,
       ts AS datetime FROM frames"""
query("cam_09", _ingested, INGEST_SQL, "frames")


def detected_messages(t: Tables, slow: float = 0.0) -> DataFrame:
    """Run the detector job over frame files until none is left; gives the JSON messages."""
    frames_in, messages = t.scratch("frames"), t.scratch("messages")
    t.frame_messages.write.parquet(frames_in)
    found = frame_stream.detection_messages(frame_stream.frame_files(t.spark, frames_in), counting_detector(slow))
    detections.append_stream(found, messages, t.scratch("progress"), {"availableNow": True}, "text").awaitTermination()
    return t.spark.read.text(messages)


def _detected(t: Tables) -> DataFrame:
    records = detections.parse_messages(detected_messages(t))
    last = F.get("detections", F.size("detections") - 1)
    return records.select(
        "frame_id", "timestamp", "person_count", F.coalesce(last["box"][2], F.lit(-1)).alias("last_right"), last["confidence"].alias("last_confidence")
    )


DETECTED_SQL = """SELECT CASE WHEN k % 7 <> 0 AND k % 11 = 0 THEN -1 ELSE CAST(event_id AS BIGINT) END AS frame_id,
       epoch_us(ts) / 1e6 AS "timestamp", k % 5 AS person_count, CASE WHEN k % 5 > 0 THEN 10 * (k % 5) - 2 ELSE -1 END AS last_right,
       CASE WHEN k % 5 > 0 THEN 0.5::DOUBLE + (k % 5 - 1) / 16 END AS last_confidence FROM keyed_events WHERE event_type <> 'error'"""
query("cam_10", _detected, DETECTED_SQL, "keyed_events")

# Stream operators over the same messages -------------------------------------------------------


def _counters(t: Tables) -> DataFrame:
    records = detections.parse_messages(detections.message_files(t.spark, publish_frames(t)))
    name = f"live_{uuid.uuid4().hex}"
    live.running_counters(records, name, t.scratch("progress"), {"availableNow": True}).awaitTermination()
    return t.spark.table(name)


def _trend(t: Tables) -> DataFrame:
    """The storage stream in several batches, each replacing the trend of the one before."""
    folder, trend, progress = publish_frames(t), t.scratch("trend"), t.scratch("progress")
    records = detections.parse_messages(t.spark.readStream.option("maxFilesPerTrigger", 2).text(folder))
    started = live.trend_stream(records, t.scratch("table"), trend, progress, {"availableNow": True})
    started.awaitTermination()
    return live.read_trend(t.spark, trend)


SLOW = 0.001  # seconds that the stand-in for a model takes for a frame with four persons


def _latency(t: Tables) -> DataFrame:
    """Latency measures of the detector job, frame by frame: slow frames took as long as they must, all other
    frames together less per frame than a slow one, and no frame was done before its work began."""
    records = detections.parse_messages(detected_messages(t, SLOW))
    slow = F.col("person_count") == 4
    worked, waited = F.col("process_latency_seconds"), F.col("total_latency_seconds")
    return records.groupBy(slow.alias("slow"), (waited >= worked).alias("waited")).agg(
        F.count(F.lit(1)).alias("n"), (F.min(worked) >= SLOW).alias("all_slow"), (F.median(worked) < SLOW / 2).alias("most_fast")
    )


def _restarted(t: Tables) -> DataFrame:
    """Run the storage job twice on one checkpoint, with messages added in between."""
    folder, table, progress = t.scratch("messages"), t.scratch("detections"), t.scratch("progress")
    for kind in ("process_latency_seconds is null", "process_latency_seconds is not null"):
        as_json(t.frames.where(kind)).write.mode("append").text(folder)
        messages = detections.message_files(t.spark, folder)
        detections.store_detections(messages, table, progress, {"availableNow": True}).awaitTermination()
    return t.spark.read.parquet(table).groupBy("frame_id").agg(F.count(F.lit(1)).alias("copies"))


query(
    "stm_1",
    lambda t: detections.parse_messages(detected_messages(t)).groupBy("person_count").agg(F.count(F.lit(1)).alias("n")),
    "SELECT k % 5 AS person_count, count(*) AS n FROM keyed_events WHERE event_type <> 'error' GROUP BY 1",
    "keyed_events",
)
query(
    "stm_2",
    lambda t: stored_detections(t).groupBy("person_count").agg(F.count("inserted_at").alias("n")),
    "SELECT person_count, count(*) AS n FROM frames GROUP BY 1",
    "frames",
)
query("stm_3", _counters, LIVE_SQL, "frames")
query("stm_4", _trend, TREND_SQL.replace("       process_latency_seconds", "       coalesce(process_latency_seconds, 0) AS process_latency_seconds"), "frames")
query(
    "stm_5",
    _latency,
    """SELECT k % 5 = 4 AS slow, TRUE AS waited, count(*) AS n, k % 5 = 4 AS all_slow, k % 5 <> 4 AS most_fast
       FROM keyed_events WHERE event_type <> 'error' GROUP BY ALL""",
    "keyed_events",
)
query("stm_6", _restarted, "SELECT frame_id, count(*) AS copies FROM frames GROUP BY 1", "frames")
