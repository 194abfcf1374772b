"""Conditions and scalar functions, each over every row of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import labels, numbers, text, times
from tallyframe.operators import aggregates, words
from tallyframe.plans import frames, ratings, sales
from tallyframe.registry.blocks_io import BOXES_SQL, HALF_UP_TEXT, boxed_events
from tallyframe.registry.core import half_up, mean_cents, query
from tallyframe.registry.flows import AGE_CODE_SQL, DELAYS_SQL, DISTRIBUTION_SQL
from tallyframe.registry.tables import Tables
from tallyframe.sources.files import BOX_SCHEMA

# Conditions ------------------------------------------------------------------------------------

query(
    "case_1",
    lambda t: t.users.select("user_id", labels.age_band(F.col("age") - 1).alias("band")),
    """SELECT user_id, CASE WHEN age - 1 <= 18 THEN '0-18' WHEN age - 1 <= 35 THEN '18-35' WHEN age - 1 <= 50 THEN '35-50' ELSE '50+' END AS band
       FROM users""",
    "users",
)
query(
    "case_2",
    lambda t: t.users.select("user_id", labels.age_code_label(F.col("age")).alias("age_group")),
    f"SELECT user_id, {AGE_CODE_SQL} AS age_group FROM users",
    "users",
)
query(
    "case_3",
    lambda t: aggregates.count_by(sales.delivery_detail(t.orders, t.limited_items), ["Order_Status", "Delivery_Performance"]),
    f"SELECT Order_Status, Delivery_Performance, count(*) AS n FROM ({DELAYS_SQL}) GROUP BY ALL",
    "limited_items shop_orders",
)
_PER_CUSTOMER = """SELECT Customer_Trx_ID, count(*) AS n, min(Order_Purchase_TS) AS first, max(Order_Purchase_TS) AS last
                   FROM shop_orders GROUP BY 1"""


def _per_customer(t: Tables) -> DataFrame:
    bought = F.col("Order_Purchase_TS")
    return t.orders.groupBy("Customer_Trx_ID").agg(
        F.count(F.lit(1)).alias("n"), F.min(bought).alias("first"), F.max(bought).alias("last")
    )


query(
    "case_4",
    lambda t: t.given("customer").select(
        "c_custkey",
        labels.customer_segment(F.col("c_nationkey") % 6, F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")), F.lit(5000.0)).alias("segment"),
    ),
    """SELECT c_custkey, CASE WHEN c_nationkey % 6 >= 4 AND c_acctbal >= 5000 THEN 'High-value loyal' WHEN c_nationkey % 6 >= 4 THEN 'Loyal'
              WHEN c_nationkey % 6 >= 2 THEN 'Repeat' ELSE 'One-time' END AS segment FROM customer""",
)
query(
    "case_5",
    lambda t: _per_customer(t).select(
        "Customer_Trx_ID", labels.purchase_gap_days(F.col("first"), F.col("last"), F.col("n")).alias("gap")
    ),
    f"""SELECT Customer_Trx_ID, CASE WHEN n > 1 THEN {half_up("date_diff('day', first, last)", "(n - 1)", 2)} END AS gap
        FROM ({_PER_CUSTOMER})""",
    "shop_orders",
)
query(
    "case_6",
    lambda t: ratings.age_average_wide(t.movies, t.user_ratings, t.users).select(
        "movie_id",
        labels.zero_if_missing(F.col("age_0_18")).alias("youngest"),
        labels.text_or_missing(F.when(F.col("age_0_18").isNotNull(), "some")).alias("shown"),
    ),
    """SELECT movie_id, coalesce(avg(rating) FILTER (age <= 18), 0) AS youngest,
              CASE WHEN count(*) FILTER (age <= 18) > 0 THEN 'some' ELSE 'NA' END AS shown
       FROM ratings JOIN users USING (user_id) GROUP BY 1""",
    "ratings users",
)
query(
    "case_7",
    lambda t: t.rating_rows.join(t.movies, "movie_id", "left").select(
        "l_orderkey", "movie_id", labels.title_or_unknown(F.col("title")).alias("title")
    ),
    "SELECT l_orderkey, movie_id, coalesce(title, 'Unknown Movie') AS title FROM rating_rows LEFT JOIN movies USING (movie_id)",
    "rating_rows movies",
)

# Text ------------------------------------------------------------------------------------------


def _texts(name: str, function, sql: str) -> None:
    """A function of whole texts, compared by the checksum of each result."""
    query(
        name,
        lambda t: t.given("documents").select("doc_id", F.md5(function(F.col("text"))).alias("text_md5")),
        f"SELECT doc_id, md5({sql}) AS text_md5 FROM documents",
    )


_texts("str_1", F.lower, "lower(text)")
_texts("str_2", text.strip_punctuation, r"regexp_replace(text, '[^\p{L}\p{N}\s]', ' ', 'g')")
_texts("str_3", text.collapse_spaces, r"regexp_replace(text, '\s+', ' ', 'g')")
_texts("str_4", text.trim_all, r"regexp_replace(text, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')")
query(
    "str_5",
    lambda t: aggregates.count_by(words.words_of(t.given("documents"), "text", "lang"), ["lang", "word"]),
    r"""SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(string_split(trim(regexp_replace(regexp_replace(lower(text),
        '[^\p{L}\p{N}\s]', ' ', 'g'), '\s+', ' ', 'g')), ' ')) AS word FROM documents) WHERE word <> '' GROUP BY ALL""",
)
query(
    "str_6",
    lambda t: t.movies.select(
        F.explode(F.arrays_zip(text.list_items(F.col("genres")).alias("trimmed"), text.list_items(F.col("genres"), False).alias("raw"))).alias("g")
    ).select("g.trimmed", "g.raw"),
    "SELECT trim(raw) AS trimmed, raw FROM (SELECT unnest(string_split(genres, '|')) AS raw FROM movies)",
    "movies",
)
query(
    "str_7",
    lambda t: t.movies.select(text.strip_carriage_return(F.concat(F.lit("\r"), "title", F.lit("\r"))).alias("title")),
    "SELECT title FROM movies",
    "movies",
)
query(
    "str_8",
    lambda t: t.users.select("user_id", F.upper("gender").alias("gender")),
    "SELECT user_id, upper(gender) AS gender FROM users",
    "users",
)
query(
    "str_9",
    lambda t: aggregates.average_by(t.ratings, ["movie_id"], "rating").select(
        "movie_id", text.fixed2_half_up(F.col("avg")).alias("half_up"), text.fixed2_half_even(F.col("avg")).alias("half_even")
    ),
    f"SELECT movie_id, {HALF_UP_TEXT} AS half_up, printf('%.2f', avg(rating)) AS half_even FROM ratings GROUP BY 1",
    "ratings",
)
query(
    "str_10",
    lambda t: ratings.movie_average(t.movies, t.ratings).select(ratings.movie_bar_line().alias("value")),
    """SELECT movie_id || ' | ' || title || ' | Average Rating: ' || printf('%.2f', avg(rating)) || ' | Total Ratings: ' || count(*) AS value
       FROM ratings JOIN movies USING (movie_id) GROUP BY movie_id, title""",
    "ratings movies",
)
query(
    "str_11",
    lambda t: frames.distribution(t.frames).select("person_count", "bar"),
    f"SELECT person_count, bar FROM ({DISTRIBUTION_SQL})",
    "frames",
)
query(
    "str_12",
    lambda t: t.given("part").select("p_partkey", text.thousands(F.col("p_partkey") * 9973).alias("shown")),
    "SELECT p_partkey, format('{:,}', p_partkey * 9973) AS shown FROM part",
)

# Time ------------------------------------------------------------------------------------------

query(
    "dt_1",
    lambda t: sales.clean_orders(t.raw_orders).select(
        "Order_ID",
        F.col("Order_Purchase_TS").cast("timestamp_ntz").alias("Order_Purchase_TS"),
        F.col("Order_Delivered_Customer_TS").cast("timestamp_ntz").alias("Order_Delivered_Customer_TS"),
    ),
    """SELECT Order_ID, Order_Purchase_TS, CASE WHEN Order_Status = 'F' THEN Order_Purchase_TS + to_minutes(23 * 60 + 59) END
              AS Order_Delivered_Customer_TS FROM shop_orders""",
    "shop_orders",
)
query(
    "dt_2",
    lambda t: t.orders.select("Order_ID", F.year("Order_Purchase_TS").alias("year"), F.month("Order_Purchase_TS").alias("month")),
    """SELECT Order_ID, CAST(year(Order_Purchase_TS) AS INTEGER) AS year, CAST(month(Order_Purchase_TS) AS INTEGER) AS month
       FROM shop_orders""",
    "shop_orders",
)
query(
    "dt_3",
    lambda t: t.rating_rows.select("l_orderkey", times.epoch_year(F.col("ts")).alias("year")),
    "SELECT l_orderkey, CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem",
)
query(
    "dt_4",
    lambda t: sales.delivery_detail(t.orders, t.limited_items).select("Order_ID", "Order_Item_ID", "Delivery_Delay_Days"),
    f"SELECT Order_ID, Order_Item_ID, Delivery_Delay_Days FROM ({DELAYS_SQL})",
    "limited_items shop_orders",
)
query(
    "dt_5",
    lambda t: _per_customer(t).select("Customer_Trx_ID", times.whole_days_between(F.col("last"), F.col("first")).alias("days")),
    f"SELECT Customer_Trx_ID, CAST(date_diff('day', first, last) AS INTEGER) AS days FROM ({_PER_CUSTOMER})",
    "shop_orders",
)
query(
    "dt_6",
    lambda t: t.frames.select(
        "frame_id",
        times.epoch_text(F.when(F.col("process_latency_seconds").isNotNull(), F.col("timestamp"))).alias("second"),
        times.epoch_text(F.col("timestamp"), times.CLOCK_FORMAT).alias("clock"),
    ),
    """SELECT frame_id, CASE WHEN process_latency_seconds IS NULL THEN 'N/A' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS second,
              strftime(ts, '%H:%M:%S') AS clock FROM frames""",
    "frames",
)
query(
    "dt_7",
    lambda t: t.frames.select("frame_id", times.epoch_to_timestamp(F.col("timestamp")).cast("timestamp_ntz").alias("datetime")),
    "SELECT frame_id, ts AS datetime FROM frames",
    "frames",
)

# Numbers and types -----------------------------------------------------------------------------

query(
    "mth_1",
    lambda t: t.items.select(
        "Order_ID",
        "Order_Item_ID",
        (numbers.money(F.col("Price")) - numbers.money(F.col("Freight_Value"))).cast("double").alias("net"),
        F.try_divide(F.col("Price"), F.col("Order_Item_ID") - 1).alias("ratio"),
    ),
    """SELECT Order_ID, Order_Item_ID, CAST(Price - Freight_Value AS DOUBLE) AS net,
              CASE WHEN Order_Item_ID > 1 THEN CAST(Price AS DOUBLE) / (Order_Item_ID - 1) END AS ratio FROM shop_items""",
    "shop_items",
)
query(
    "mth_2",
    lambda t: t.items.groupBy("Order_ID").agg(
        numbers.exact_mean(numbers.money(F.col("Price")), 2).cast("double").alias("two"),
        numbers.exact_mean(numbers.money(F.col("Price")), 3).cast("double").alias("three"),
    ),
    f"SELECT Order_ID, {mean_cents('Price', 2)} AS two, {mean_cents('Price', 3)} AS three FROM shop_items GROUP BY 1",
    "shop_items",
)
query(
    "mth_3",
    lambda t: t.frames.select(
        "frame_id", numbers.to_millis(F.col("process_latency_seconds")).alias("ms")
    ),
    "SELECT frame_id, CAST(CAST(process_latency_seconds AS DECIMAL(18,6)) * 1000 AS DOUBLE) AS ms FROM frames",
    "frames",
)
query(
    "mth_4",
    lambda t: t.items.groupBy("Seller_ID").agg(F.count("Freight_Value").alias("part"), F.count(F.lit(1)).alias("whole")).select(
        "Seller_ID", numbers.percent_of(F.col("part"), F.col("whole")).alias("pct")
    ),
    "SELECT Seller_ID, count(Freight_Value) * 100.0::DOUBLE / count(*) AS pct FROM shop_items GROUP BY 1",
    "shop_items",
)
query(
    "typ_1",
    lambda t: t.order_reviews.select(
        "Order_ID",
        numbers.truncated_int(F.col("Review_Score")).alias("whole"),
        numbers.to_long(F.col("Review_Score")).alias("long"),
        numbers.to_double(F.col("Review_Score")).alias("real"),
    ),
    """SELECT Order_ID, CAST(trunc(TRY_CAST(Review_Score AS DOUBLE)) AS INTEGER) AS whole,
              CASE WHEN Review_Score NOT LIKE '%.%' THEN TRY_CAST(Review_Score AS BIGINT) END AS long,
              TRY_CAST(Review_Score AS DOUBLE) AS real FROM order_reviews""",
    "order_reviews",
)
query(
    "arr_1",
    lambda t: boxed_events(t).select("frame_id", F.size("detections").alias("person_count")),
    "SELECT CAST(event_id AS BIGINT) AS frame_id, k % 5 AS person_count FROM keyed_events",
    "keyed_events",
)
query(
    "arr_2",
    lambda t: boxed_events(t).select("frame_id", F.explode("detections").alias("d")).select(
        "frame_id", F.col("d.box")[0].alias("x1"), F.col("d.box")[2].alias("x2"), "d.confidence"
    ),
    f"""SELECT frame_id, CAST(d.box[1] AS INTEGER) AS x1, CAST(d.box[3] AS INTEGER) AS x2, d.confidence AS confidence
        FROM (SELECT CAST(event_id AS BIGINT) AS frame_id, unnest({BOXES_SQL}) AS d FROM keyed_events)""",
    "keyed_events",
)


def _round_trip(t: Tables) -> DataFrame:
    """Records to JSON text and back."""
    texts = boxed_events(t).select(F.to_json(F.struct("frame_id", "detections")).alias("value"))
    record = F.from_json("value", f"frame_id BIGINT, detections {BOX_SCHEMA}").alias("r")
    return texts.select(record).select("r.frame_id", F.size("r.detections").alias("boxes"), F.get("r.detections", F.lit(0))["confidence"].alias("first"))


query(
    "jsn_1",
    _round_trip,
    "SELECT CAST(event_id AS BIGINT) AS frame_id, k % 5 AS boxes, CASE WHEN k % 5 > 0 THEN 0.5::DOUBLE END AS first FROM keyed_events",
    "keyed_events",
)
query(
    "nul_1",
    lambda t: t.frames.select("frame_id", F.coalesce("process_latency_seconds", F.lit(0.0)).alias("seconds")),
    "SELECT frame_id, coalesce(process_latency_seconds, 0) AS seconds FROM frames",
    "frames",
)
