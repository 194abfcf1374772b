"""Projections, filters, joins, aggregations, windows, order, limits, sets and table functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import labels, numbers, text, times
from tallyframe.operators import aggregates, joins, ordered, rows, words
from tallyframe.plans import frames, ratings, reviews, sales
from tallyframe.registry.core import half_up, query
from tallyframe.registry.flows import AGE_CODE_SQL, counting_detector, words_sql
from tallyframe.registry.tables import Tables
from tallyframe.sources import delimited
from tallyframe.streaming.frames import decode_headers, detect, detection_records

# Projections -----------------------------------------------------------------------------------

query(
    "prj_1",
    lambda t: t.reviews.select(F.col("id").alias("review_id"), F.col("category").alias("language"), "sentiment"),
    "SELECT id AS review_id, category AS language, sentiment FROM reviews",
    "reviews",
)
query(
    "prj_2",
    lambda t: t.items.select("Order_ID", "Order_Item_ID", sales.item_revenue().cast("double").alias("Item_Revenue")),
    "SELECT Order_ID, Order_Item_ID, CAST(Item_Revenue AS DOUBLE) AS Item_Revenue FROM shop_items",
    "shop_items",
)


def _positions(t: Tables) -> DataFrame:
    """Movie lines, every second title with a comma in it: the last field and the third one differ."""
    title = "CASE WHEN movie_id % 2 = 0 THEN concat(title, ', The') ELSE title END"
    lines = t.movies.selectExpr(f"concat_ws(',', movie_id, {title}, genres) AS value")
    last = delimited.parse_lines(lines, delimited.MOVIES, "drop")
    third = delimited.parse_lines(lines, delimited.MOVIES, "fail").select("movie_id", F.col("genres").alias("third"))
    return last.join(third, "movie_id")


query(
    "prj_3",
    _positions,
    "SELECT movie_id, title, trim(genres) AS genres, CASE WHEN movie_id % 2 = 0 THEN ' The' ELSE genres END AS third FROM movies",
    "movies",
)
query(
    "prj_4",
    lambda t: rows.title_first(t.products, "Products", "Title"),
    "SELECT 'Products' AS \"Title\", Product_ID, Product_Category_Name FROM products",
    "products",
)
query(
    "prj_5",
    lambda t: ratings.gender_average(t.movies, t.user_ratings, t.users).groupBy("movie_id").agg(
        F.count("gender").alias("genders"), F.sum("n").alias("n")
    ),
    """SELECT movie_id, count(DISTINCT gender) AS genders, count(*) AS n
       FROM ratings JOIN users USING (user_id) JOIN movies USING (movie_id) GROUP BY movie_id""",
    "ratings users movies",
)

# Filters ---------------------------------------------------------------------------------------

query(
    "flt_1",
    lambda t: t.order_reviews.where((F.col("Review_Score").isNotNull()) & (F.col("Review_Score") != "")),
    "SELECT Order_ID, Review_Score FROM order_reviews WHERE Review_Score <> ''",
    "order_reviews",
)
query(
    "flt_2",
    lambda t: t.reviews.where(F.col("sentiment") == "negative").select("id", "aspect"),
    "SELECT id, aspect FROM reviews WHERE sentiment = 'negative'",
    "reviews",
)
query(
    "flt_3",
    lambda t: sales.clean_reviews(t.order_reviews),
    "SELECT Order_ID, Review_Score, Review_Score_Int FROM valid_reviews",
    "valid_reviews",
)
query(
    "flt_4",
    lambda t: aggregates.average_by(t.ratings, ["movie_id"], "rating").where(F.col("n") >= 30),
    "SELECT movie_id, avg(rating) AS avg, count(*) AS n FROM ratings GROUP BY 1 HAVING count(*) >= 30",
    "ratings",
)
query(
    "flt_5",
    lambda t: t.orders.where(times.in_year(F.col("Order_Purchase_TS"), 1998)).select("Order_ID", "Order_Purchase_TS"),
    "SELECT Order_ID, Order_Purchase_TS FROM shop_orders WHERE year(Order_Purchase_TS) = 1998",
    "shop_orders",
)
query(
    "flt_6",
    lambda t: ratings.gender_average_wide(t.movies, t.user_ratings, t.users).select("movie_id"),
    "SELECT DISTINCT movie_id FROM ratings JOIN users USING (user_id) WHERE upper(gender) IN ('M', 'F')",
    "ratings users",
)

# Joins -----------------------------------------------------------------------------------------

query(
    "join_1",
    lambda t: ratings.movie_average_all(t.movies, t.ratings).select("movie_id", "title", "n"),
    """SELECT movie_id, coalesce(max(title), 'Unknown Movie') AS title, count(*) AS n
       FROM ratings LEFT JOIN movies USING (movie_id) GROUP BY movie_id""",
    "ratings movies",
)
query(
    "join_2",
    lambda t: aggregates.sums_by(t.ratings, ["movie_id"], "rating").join(
        t.movies.select("movie_id", F.explode(text.list_items(F.col("genres"))).alias("genre")), "movie_id"
    ),
    """SELECT movie_id, genre, sum(rating) AS total, count(*) AS n FROM ratings
       JOIN (SELECT movie_id, trim(unnest(string_split(genres, '|'))) AS genre FROM movies) USING (movie_id) GROUP BY ALL""",
    "ratings movies",
)
query(
    "join_3",
    lambda t: aggregates.count_by(joins.look_up(t.user_ratings, t.users, "user_id", ["gender"]), ["movie_id", "gender"]),
    "SELECT movie_id, gender, count(*) AS n FROM ratings JOIN users USING (user_id) GROUP BY ALL",
    "ratings users",
)
query(
    "join_4",
    lambda t: aggregates.count_by(words.content_words(t.reviews, "review", t.stopwords, "category"), ["category"]),
    """SELECT category, count(*) AS n FROM (SELECT category, unnest(string_split(clean, ' ')) AS word FROM cleaned)
       WHERE word <> '' AND word NOT IN (SELECT stopword FROM stopwords) GROUP BY 1""",
    "cleaned stopwords",
)
query(
    "join_5",
    lambda t: aggregates.average_by(t.ratings, ["movie_id"], "rating").join(t.movies.select("movie_id", "title"), "movie_id"),
    "SELECT movie_id, title, avg(rating) AS avg, count(*) AS n FROM ratings JOIN movies USING (movie_id) GROUP BY ALL",
    "ratings movies",
)
query(
    "join_6",
    lambda t: aggregates.average_by(joins.look_up(t.user_ratings, t.users, "user_id", ["age"]), ["age"], "rating"),
    "SELECT age, avg(rating) AS avg, count(*) AS n FROM ratings JOIN users USING (user_id) GROUP BY age",
    "ratings users",
)
query(
    "join_7",
    lambda t: t.users.select("user_id", "occupation").join(t.occupations, "occupation").select("user_id", "occupation_name"),
    "SELECT user_id, occupation_name FROM users JOIN occupations USING (occupation)",
    "users occupations",
)
query(
    "join_8",
    lambda t: t.orders.select("Order_ID", "Customer_Trx_ID").join(t.customers, "Customer_Trx_ID", "left"),
    """SELECT Customer_Trx_ID, Order_ID, Customer_Country, Customer_Country_Code
       FROM shop_orders LEFT JOIN shop_customers USING (Customer_Trx_ID)""",
    "shop_orders shop_customers",
)
query(
    "join_9",
    lambda t: t.items.select("Order_ID", "Order_Item_ID").join(t.orders.select("Order_ID", "Order_Purchase_TS"), "Order_ID"),
    "SELECT Order_ID, Order_Item_ID, Order_Purchase_TS FROM shop_items JOIN shop_orders USING (Order_ID)",
    "shop_items shop_orders",
)
query(
    "join_10",
    lambda t: t.items.select("Order_ID", "Product_ID")
    .join(t.products, "Product_ID", "left")
    .join(sales.clean_reviews(t.order_reviews).select("Order_ID", "Review_Score_Int"), "Order_ID", "left")
    .groupBy("Product_ID", "Product_Category_Name")
    .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("Review_Score_Int"), F.lit(0)).alias("score")),
    """SELECT Product_ID, Product_Category_Name, count(*) AS n, CAST(coalesce(sum(Review_Score_Int), 0) AS BIGINT) AS score
       FROM shop_items LEFT JOIN products USING (Product_ID) LEFT JOIN valid_reviews USING (Order_ID) GROUP BY ALL""",
    "shop_items products valid_reviews",
)
query(
    "join_11",
    lambda t: t.orders.select("Order_ID").join(
        t.items.select("Order_ID", sales.item_cents().alias("c")).groupBy("Order_ID").agg(numbers.from_cents(F.sum("c")).alias("Order_Value")),
        "Order_ID",
        "left",
    ),
    """SELECT Order_ID, CAST(v AS DOUBLE) AS Order_Value FROM shop_orders
       LEFT JOIN (SELECT Order_ID, sum(Item_Revenue) AS v FROM shop_items GROUP BY 1) USING (Order_ID)""",
    "shop_orders shop_items",
)

# Aggregations ----------------------------------------------------------------------------------

query(
    "agg_1",
    lambda t: aggregates.average_by(t.ratings, ["movie_id"], "rating"),
    "SELECT movie_id, avg(rating) AS avg, count(*) AS n FROM ratings GROUP BY 1",
    "ratings",
)
query(
    "agg_2",
    lambda t: aggregates.average_wide(
        joins.look_up(t.user_ratings, t.users.withColumn("gender", F.upper("gender")), "user_id", ["gender"]),
        ["movie_id"], "gender", "rating", {"M": "men", "F": "women"},
    ),
    """SELECT movie_id, avg(CASE WHEN upper(gender) = 'M' THEN rating END) AS men, avg(CASE WHEN upper(gender) = 'F' THEN rating END) AS women
       FROM ratings JOIN users USING (user_id) WHERE upper(gender) IN ('M', 'F') GROUP BY 1""",
    "ratings users",
)
query(
    "agg_3",
    lambda t: aggregates.average_wide(
        joins.look_up(t.user_ratings, t.users.withColumn("band", labels.age_band(F.col("age"))), "user_id", ["band"]),
        ["user_id"], "band", "rating", ratings.BAND_COLUMNS,
    ),
    """SELECT user_id, avg(rating) FILTER (age <= 18) AS age_0_18, avg(rating) FILTER (age BETWEEN 19 AND 35) AS age_18_35,
              avg(rating) FILTER (age BETWEEN 36 AND 50) AS age_35_50, avg(rating) FILTER (age > 50) AS age_50_plus
       FROM ratings JOIN users USING (user_id) GROUP BY 1""",
    "ratings users",
)
query(
    "agg_4",
    lambda t: aggregates.count_by(t.reviews, ["aspect"], counted="sentiment"),
    "SELECT aspect, count(sentiment) AS n FROM reviews GROUP BY 1",
    "reviews",
)
query(
    "agg_5",
    lambda t: aggregates.count_by(t.reviews, ["category", "sentiment", "aspect"]),
    "SELECT category, sentiment, aspect, count(*) AS n FROM reviews GROUP BY ALL",
    "reviews",
)
query(
    "agg_6",
    lambda t: t.items.agg(F.count(F.lit(1)).alias("items"), numbers.from_cents(F.sum(sales.item_cents())).alias("revenue")),
    "SELECT count(*) AS items, CAST(sum(Item_Revenue) AS DOUBLE) AS revenue FROM shop_items",
    "shop_items",
)
query(
    "agg_7",
    lambda t: t.orders.agg(aggregates.distinct_values("Customer_Trx_ID").alias("customers")),
    "SELECT count(*) AS customers FROM (SELECT DISTINCT Customer_Trx_ID FROM shop_orders)",
    "shop_orders",
)
query(
    "agg_8",
    lambda t: t.orders.groupBy("Order_Status").agg(F.count_distinct("Customer_Trx_ID").alias("customers")),
    "SELECT Order_Status, count(DISTINCT Customer_Trx_ID) AS customers FROM shop_orders GROUP BY 1",
    "shop_orders",
)
query(
    "agg_9",
    lambda t: sales.seller_performance(t.items),
    f"""SELECT Seller_ID, CAST(sum(Item_Revenue) AS DOUBLE) AS Total_Revenue, count(DISTINCT Order_ID) AS Total_Orders,
               count(*) AS Total_Items_Sold,
               {half_up("CAST(sum(Item_Revenue) * 100 AS HUGEINT)", "(count(Item_Revenue) * 100)", 2)} AS Avg_Item_Revenue
        FROM shop_items GROUP BY 1""",
    "shop_items",
)
query(
    "agg_10",
    lambda t: t.orders.groupBy("Customer_Trx_ID").agg(
        F.min("Order_Purchase_TS").alias("first"), F.max("Order_Purchase_TS").alias("last")
    ),
    "SELECT Customer_Trx_ID, min(Order_Purchase_TS) AS first, max(Order_Purchase_TS) AS last FROM shop_orders GROUP BY 1",
    "shop_orders",
)


def _quantiles(t: Tables) -> DataFrame:
    """The exact quantile, and whether the sketch keeps its promised rank error."""
    values = t.given("orders").select("o_totalprice")
    exact = ordered.exact_quantile(values, "o_totalprice", 0.75)
    sketch = ordered.sketched_quantile(values, "o_totalprice", 0.75, 0.01).scalar()
    rank = F.avg(F.when(F.col("o_totalprice") <= sketch, 1.0).otherwise(0.0))
    close = values.agg(rank.between(0.739, 0.761).alias("sketch_is_close")).scalar()
    return exact.select("quantile", close.alias("sketch_is_close"))


query("agg_11", _quantiles, "SELECT quantile_disc(o_totalprice, 0.75) AS quantile, TRUE AS sketch_is_close FROM orders")
query(
    "agg_12",
    lambda t: aggregates.best_row(t.frames, ["frame_id", "person_count"], F.col("person_count"), -F.col("frame_id")),
    "SELECT frame_id, person_count FROM frames ORDER BY person_count DESC NULLS LAST, frame_id LIMIT 1",
    "frames",
)
query(
    "agg_13",
    lambda t: t.items.groupBy("Order_ID").agg(F.count(F.lit(1)).alias("items")).join(t.orders, "Order_ID")
    .groupBy("Customer_Trx_ID").agg(F.max("items").alias("most"), F.count(F.lit(1)).alias("orders"))
    .groupBy("most").agg(F.count(F.lit(1)).alias("customers"), F.sum("orders").alias("orders")),
    """SELECT most, count(*) AS customers, CAST(sum(orders) AS BIGINT) AS orders FROM (
         SELECT Customer_Trx_ID, max(items) AS most, count(*) AS orders
         FROM (SELECT Order_ID, count(*) AS items FROM shop_items GROUP BY 1) JOIN shop_orders USING (Order_ID) GROUP BY 1)
       GROUP BY 1""",
    "shop_items shop_orders",
)
query(
    "agg_14",
    lambda t: aggregates.count_with_share(t.reviews, "category"),
    "SELECT category, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS pct FROM reviews GROUP BY 1",
    "reviews",
)
query(
    "agg_15",
    lambda t: t.frames.agg(aggregates.share_of_rows(F.col("person_count") > 0).alias("rate")),
    "SELECT avg(CASE WHEN person_count > 0 THEN 100.0 ELSE 0.0 END) AS rate FROM frames",
    "frames",
)
query(
    "agg_16",
    lambda t: aggregates.best_row(ratings.genre_average(t.movies, t.ratings), ["genre", "avg", "n"], F.col("avg"), F.col("genre")),
    """SELECT genre, avg(rating) AS avg, count(*) AS n FROM ratings
       JOIN (SELECT movie_id, trim(unnest(string_split(genres, '|'))) AS genre FROM movies) USING (movie_id)
       GROUP BY 1 ORDER BY 2 DESC, 1 DESC LIMIT 1""",
    "ratings movies",
)

# Windows, order and limits ---------------------------------------------------------------------


def _per_source(t: Tables) -> DataFrame:
    """A moving average within each kind of event, in buckets small enough to have many borders."""
    events = t.keyed_events.select("event_id", "event_type", "k")
    order = [F.asc("event_id")]
    averaged = ordered.centred_average(events, order, "k", "moving", 3, 1, ["event_type"], bucket_rows=1000)
    return averaged.select("event_id", "event_type", "k", F.round("moving", 6).alias("moving"))


query(
    "win_1",
    _per_source,
    """SELECT event_id, event_type, k, round(avg(k) OVER (PARTITION BY event_type ORDER BY event_id
              ROWS BETWEEN 3 PRECEDING AND 1 FOLLOWING), 6) AS moving FROM keyed_events""",
    "keyed_events",
)
query(
    "win_2",
    lambda t: ordered.dense_rank_all(aggregates.count_by(t.items, ["Product_ID"]), ["n"], "place"),
    "SELECT Product_ID, count(*) AS n, dense_rank() OVER (ORDER BY count(*) DESC) AS place FROM shop_items GROUP BY 1",
    "shop_items",
)
query(
    "win_3",
    lambda t: rows.top_per_group(
        aggregates.count_by(t.reviews, ["category", "aspect"]), ["category"], 3, F.desc("n"), F.asc("aspect")
    ),
    """SELECT category, aspect, count(*) AS n FROM reviews GROUP BY category, aspect
       QUALIFY row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, aspect) <= 3""",
    "reviews",
)
query(
    "srt_1",
    lambda t: ordered.number_as_given(ratings.movie_average(t.movies, t.ratings), "place"),
    """SELECT movie_id, title, avg(rating) AS avg, count(*) AS n, row_number() OVER (ORDER BY movie_id) - 1 AS place
       FROM ratings JOIN movies USING (movie_id) GROUP BY movie_id, title""",
    "ratings movies",
)
query(
    "srt_2",
    lambda t: ordered.number_as_given(frames.peak_frames(t.frames), "place"),
    """SELECT frame_id, person_count, process_latency_seconds, row_number() OVER (ORDER BY person_count DESC, frame_id) - 1 AS place
       FROM frames WHERE person_count >= 4""",
    "frames",
)
query(
    "srt_3",
    lambda t: ordered.number_as_given(aggregates.count_by(t.items, ["Seller_ID"]).orderBy(F.desc("n"), "Seller_ID"), "place"),
    "SELECT Seller_ID, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, Seller_ID) - 1 AS place FROM shop_items GROUP BY 1",
    "shop_items",
)
query(
    "srt_4",
    lambda t: ordered.number_as_given(
        t.movies.select("movie_id", F.col("movie_id").cast("string").alias("id_text")).orderBy("id_text"), "place"
    ),
    """SELECT movie_id, CAST(movie_id AS VARCHAR) AS id_text, row_number() OVER (ORDER BY CAST(movie_id AS VARCHAR)) - 1 AS place
       FROM movies""",
    "movies",
)
query(
    "lim_1",
    lambda t: rows.top_rows(t.orders.join(
        t.items.groupBy("Order_ID").agg(F.count(F.lit(1)).alias("n")), "Order_ID").select("Order_ID", "n"), 1, F.desc("n"), F.asc("Order_ID")),
    """SELECT Order_ID, n FROM shop_orders JOIN (SELECT Order_ID, count(*) AS n FROM shop_items GROUP BY 1) USING (Order_ID)
       ORDER BY n DESC, Order_ID LIMIT 1""",
    "shop_orders shop_items",
)
query(
    "lim_2",
    lambda t: reviews.most_of(reviews.rows_per(t.reviews, "category"), "category", "total_comments"),
    "SELECT category, count(id) AS total_comments FROM reviews GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
    "reviews",
)
query(
    "lim_3",
    lambda t: rows.latest_ascending(
        t.frames.select("frame_id", "timestamp"), 50, [F.desc("timestamp"), F.desc("frame_id")], [F.asc("timestamp"), F.asc("frame_id")]
    ),
    'SELECT frame_id, "timestamp" FROM frames ORDER BY "timestamp" DESC, frame_id DESC LIMIT 50',
    "frames",
)
query(
    "lim_4",
    lambda t: rows.top_rows(t.orders.select("Order_ID", "Order_Status"), 5, F.asc("Order_ID")),
    "SELECT Order_ID, Order_Status FROM shop_orders ORDER BY Order_ID LIMIT 5",
    "shop_orders",
)

# Sets ------------------------------------------------------------------------------------------

query(
    "set_1",
    lambda t: aggregates.average_by(
        rows.union_all(t.rating_rows.where("l_linenumber <= 3"), t.rating_rows.where("l_linenumber > 3")), ["movie_id"], "rating"
    ),
    """SELECT movie_id, avg(rating) AS avg, count(*) AS n FROM (SELECT * FROM rating_rows WHERE l_linenumber <= 3
       UNION ALL SELECT * FROM rating_rows WHERE l_linenumber > 3) GROUP BY 1""",
    "rating_rows",
)
query(
    "set_2",
    lambda t: rows.distinct_rows(t.reviews).select("id", F.md5("review").alias("review_md5"), "category", "aspect", "sentiment"),
    "SELECT id, md5(review) AS review_md5, category, aspect, sentiment FROM (SELECT DISTINCT * FROM reviews)",
    "reviews",
)
_PROJECTIONS = {
    "two": ["id", "review"],
    "three": ["id", "review", "category"],
    "four": ["id", "review", "category", "sentiment"],
    "five": ["id", "review", "category", "aspect", "sentiment"],
}
query(
    "set_3",
    lambda t: rows.union_all(
        *[rows.distinct_rows(t.reviews, *names).agg(F.lit(key).alias("key"), F.count(F.lit(1)).alias("n")) for key, names in _PROJECTIONS.items()]
    ),
    " UNION ALL ".join(
        f"SELECT '{key}' AS key, count(*) AS n FROM (SELECT DISTINCT {', '.join(names)} FROM reviews)" for key, names in _PROJECTIONS.items()
    ),
    "reviews",
)

# Functions of the user -------------------------------------------------------------------------

query(
    "udf_1",
    lambda t: t.rating_lines().select(delimited.split_fields(F.col("value")).alias("f")).selectExpr(
        "size(f) AS fields", "trim(f[1]) AS movie"
    ),
    "SELECT 4 AS fields, CAST(movie_id AS VARCHAR) AS movie FROM rating_rows",
    "rating_rows",
)
query(
    "udf_2",
    lambda t: aggregates.count_by(t.users.select(labels.age_code_label(F.col("age")).alias("age_group")), ["age_group"]),
    f"SELECT {AGE_CODE_SQL} AS age_group, count(*) AS n FROM users GROUP BY 1",
    "users",
)
query(
    "udf_3",
    lambda t: aggregates.count_by(t.ratings.select(times.epoch_year(F.col("ts")).alias("year")), ["year"]),
    "SELECT CAST(year(make_timestamp(ts * 1000000)) AS INTEGER) AS year, count(*) AS n FROM rating_rows GROUP BY 1",
    "rating_rows",
)
query(
    "udf_4",
    lambda t: t.movies.select("movie_id", F.explode(text.list_items(F.col("genres"))).alias("genre")),
    "SELECT movie_id, trim(unnest(string_split(genres, '|'))) AS genre FROM movies",
    "movies",
)
query(
    "udf_5",
    lambda t: aggregates.average_of_sums(aggregates.sums_by(t.rating_rows, ["movie_id", "l_linenumber"], "rating"), ["l_linenumber"]),
    "SELECT l_linenumber, avg(rating) AS avg, count(*) AS n FROM rating_rows GROUP BY 1",
    "rating_rows",
)
query(
    "udf_6",
    lambda t: detection_records(detect(decode_headers(t.frame_messages), counting_detector())).select("timestamp", "person_count"),
    """SELECT epoch_us(ts) / 1e6 AS "timestamp", k % 5 AS person_count FROM keyed_events WHERE event_type <> 'error'""",
    "keyed_events",
)
query(
    "udf_7",
    lambda t: reviews.top_words(t.reviews, t.stopwords, k=3),
    f"""SELECT category, word, count(*) AS freq FROM ({words_sql("category", "id, review, category")}) GROUP BY category, word
        QUALIFY row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, word) <= 3""",
    "cleaned stopwords",
)
