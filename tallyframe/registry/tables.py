"""The given tables seen as movies, reviews, shop and camera data, and the same views in SQL.

Irregular rows the analyses have to cope with (unknown movies and users, missing customers, bad
scores, repeated reviews, missing latencies) are derived from the tables by rule; no row is left out.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyframe.functions.times import timestamp_epoch
from tallyframe.session import scratch_path
from tallyframe.sources.files import word_list

STOPWORD_LINES = [
    "the", "of", "and", "is", "on", "in\r", "it", "that", "der", "die", "und", "le", "la", "et",
    "un", "que", "el", "de", "los", "of the", "", "the",
]


_SCHEMAS: dict[str, StructType] = {}


class Tables:
    """Lazy access to the given tables and to the views on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def given(self, name: str) -> DataFrame:
        """A given table. Its schema is read from the file once, not again for each query."""
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    # Ratings -----------------------------------------------------------------------------------

    @cached_property
    def movies(self) -> DataFrame:
        return self.given("part").selectExpr("p_partkey AS movie_id", "p_name AS title", "concat(p_type, '| ', p_brand) AS genres")

    @cached_property
    def ratings(self) -> DataFrame:
        """Ratings without their users, so that nothing is joined where no user is asked for."""
        return self.rating_rows.select("movie_id", "rating", "ts")

    @cached_property
    def rating_rows(self) -> DataFrame:
        return self.given("lineitem").select(
            "l_orderkey",
            "l_linenumber",
            "l_returnflag",
            "l_suppkey",
            F.expr("CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -1 - l_partkey ELSE l_partkey END").alias("movie_id"),
            (F.ceil(F.col("l_quantity") / 5) * F.lit(0.5).cast("double")).alias("rating"),
            F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("ts"),
        )

    @cached_property
    def user_ratings(self) -> DataFrame:
        buyer = self.given("orders").selectExpr(
            "o_orderkey AS l_orderkey",
            "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN -1 - o_custkey ELSE o_custkey END AS user_id",
        )
        return self.rating_rows.join(buyer, "l_orderkey", "left").select("user_id", "movie_id", "rating", "ts")

    def rating_lines(self, rows: DataFrame | None = None, instead: str = "") -> DataFrame:
        """Ratings as text, with ``::`` on even lines and a comma and blank on odd ones. ``instead``
        holds WHEN clauses that put other lines in the place of some."""
        fields = "CAST(l_suppkey AS STRING), CAST(movie_id AS STRING), CAST(rating AS STRING), CAST(ts AS STRING)"
        line = f"CASE {instead} WHEN l_linenumber % 2 = 0 THEN concat_ws('::', {fields}) ELSE concat_ws(', ', {fields}) END AS value"
        return (rows or self.rating_rows).selectExpr(line)

    @cached_property
    def users(self) -> DataFrame:
        return self.given("customer").selectExpr(
            "c_custkey AS user_id",
            "CASE WHEN c_custkey % 11 = 0 THEN 'x' WHEN c_custkey % 2 = 0 THEN 'm' ELSE 'F' END AS gender",
            "CAST(1 + c_custkey % 60 AS INT) AS age",
            "c_nationkey AS occupation",
        )

    @cached_property
    def occupations(self) -> DataFrame:
        return self.given("nation").selectExpr("n_nationkey AS occupation", "n_name AS occupation_name")

    # Reviews -----------------------------------------------------------------------------------

    @cached_property
    def reviews(self) -> DataFrame:
        joined = self.given("documents").select("doc_id", "text", "lang", "source").join(self.given("labels"), "doc_id", "left")
        aspects = F.expr(
            "CASE WHEN toxic = 1 THEN array(source, source) WHEN quality = 1 THEN array(source, 'GENERAL') ELSE array(source) END"
        )
        return joined.select(
            F.col("doc_id").alias("id"),
            F.col("text").alias("review"),
            F.col("lang").alias("category"),
            F.explode(aspects).alias("aspect"),
            F.expr("CASE quality WHEN 1 THEN 'positive' WHEN 0 THEN 'negative' END").alias("sentiment"),
        )

    @cached_property
    def stopwords(self) -> DataFrame:
        return word_list(self.spark.createDataFrame([(line,) for line in STOPWORD_LINES], "value STRING"))

    # Shop --------------------------------------------------------------------------------------

    @cached_property
    def raw_orders(self) -> DataFrame:
        """Orders as exported: all times are text, one of them not always a time."""
        return self.given("orders").selectExpr(
            "o_orderkey AS Order_ID",
            "CASE WHEN o_orderkey % 97 > 0 THEN concat('A', o_custkey * 4 + o_orderkey % 4) END AS Customer_Trx_ID",
            "o_orderstatus AS Order_Status",
            "date_format(o_orderdate, 'yyyy-MM-dd HH:mm') AS Order_Purchase_Timestamp",
            "CASE WHEN o_orderstatus <> 'P' THEN date_format(o_orderdate, 'yyyy-MM-dd 08:15') END AS Order_Approved_At",
            "CASE WHEN o_orderstatus <> 'P' THEN date_format(o_orderdate, 'yyyy-MM-dd 17:05') END AS Order_Delivered_Carrier_Date",
            "CASE WHEN o_orderstatus = 'F' THEN date_format(o_orderdate, 'yyyy-MM-dd 23:59') ELSE 'not yet' END"
            " AS Order_Delivered_Customer_Date",
            "date_format(o_orderdate, 'yyyy-MM-dd 10:30') AS Order_Estimated_Delivery_Date",
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.given("orders").selectExpr(
            "o_orderkey AS Order_ID",
            "CASE WHEN o_orderkey % 97 > 0 THEN concat('A', o_custkey * 4 + o_orderkey % 4) END AS Customer_Trx_ID",
            "o_orderstatus AS Order_Status",
            "o_orderdate AS Order_Purchase_TS",
            "CASE WHEN o_orderstatus <> 'P' THEN o_orderdate"
            " + make_dt_interval(CAST(o_orderkey % 15 AS INT), 0, 0, (o_orderkey % 7) * 150) END AS Order_Delivered_Carrier_TS",
        )

    @cached_property
    def customers(self) -> DataFrame:
        nations = self.given("nation").selectExpr("n_nationkey AS c_nationkey", "n_name AS Customer_Country")
        return self.given("customer").join(nations, "c_nationkey").selectExpr(
            "explode(transform(array(0, 1, 2, 3), account -> concat('A', c_custkey * 4 + account))) AS Customer_Trx_ID",
            "Customer_Country",
            "concat('C', c_nationkey) AS Customer_Country_Code",
        )

    @cached_property
    def items(self) -> DataFrame:
        return self.given("lineitem").selectExpr(
            "l_orderkey AS Order_ID",
            "l_linenumber AS Order_Item_ID",
            "CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -1 - l_partkey ELSE l_partkey END AS Product_ID",
            "l_suppkey AS Seller_ID",
            "l_extendedprice AS Price",
            "CASE WHEN l_returnflag = 'N' AND l_linenumber = 6 THEN NULL ELSE l_quantity END AS Freight_Value",
        )

    @cached_property
    def limited_items(self) -> DataFrame:
        """Items with their shipping limit, which counts from the date of the order."""
        dates = self.given("orders").selectExpr("o_orderkey AS Order_ID", "o_orderdate")
        limit = F.expr("o_orderdate + make_dt_interval(Order_Item_ID)").alias("Shipping_Limit_TS")
        return self.items.join(dates, "Order_ID").select("Order_ID", "Order_Item_ID", limit)

    @cached_property
    def order_reviews(self) -> DataFrame:
        score = F.expr(
            "CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN '9' WHEN o_orderkey % 13 = 0 THEN '4.5'"
            " WHEN o_orderkey % 29 = 0 THEN 'n/a' ELSE left(o_orderpriority, 1) END"
        )
        copies = F.expr("explode(CASE WHEN o_orderkey % 23 = 0 THEN array(1, 2) ELSE array(1) END)")
        reviews = self.given("orders").select(F.col("o_orderkey").alias("Order_ID"), score.alias("Review_Score"), copies.alias("copy"))
        return reviews.select("Order_ID", "Review_Score")

    @cached_property
    def products(self) -> DataFrame:
        return self.given("part").selectExpr("p_partkey AS Product_ID", "p_type AS Product_Category_Name")

    # Frames ------------------------------------------------------------------------------------

    @cached_property
    def keyed_events(self) -> DataFrame:
        """Events with the number in their properties, read from the JSON once per row."""
        return self.given("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))

    @cached_property
    def frames(self) -> DataFrame:
        k = F.col("k")
        return self.keyed_events.select(
            F.col("event_id").cast("bigint").alias("frame_id"),
            timestamp_epoch(F.col("ts")).alias("timestamp"),
            (k % 5).alias("person_count"),
            F.when((F.col("event_type") != "error") | (k % 10 != 0), F.col("value") / 1000).alias("process_latency_seconds"),
            (F.col("value") / 500).alias("total_latency_seconds"),
        )

    @cached_property
    def frame_messages(self) -> DataFrame:
        """One message per event: its count as payload, or bytes that are no text for an error."""
        k = F.col("k")
        payload = F.when(F.col("event_type") == "error", F.unhex(F.lit("FFFE"))).otherwise(F.encode((k % 5).cast("string"), "UTF-8"))

        def header(key: str, text):
            return F.struct(F.lit(key).alias("key"), F.encode(text, "UTF-8").alias("value"))

        number = header("frame_id", F.col("event_id").cast("string"))
        micros = F.unix_micros(F.col("ts").cast("timestamp")).cast("string")
        moment = header("timestamp", F.regexp_replace(micros, r"(\d{6})$", ".$1"))
        source = header("source", F.col("event_type"))
        headers = F.when(k % 7 == 0, F.array(number, moment)).when(k % 11 == 0, F.array(moment, source))
        return self.keyed_events.select(payload.alias("value"), headers.otherwise(F.array(number, moment, source)).alias("headers"))


_WORDS = ", ".join(f"('{line}')" for line in sorted({line.replace("\r", "") for line in STOPWORD_LINES} - {""}))
_CLEAN = r"trim(regexp_replace(regexp_replace(lower(review), '[^\p{L}\p{N}\s]', ' ', 'g'), '\s+', ' ', 'g'))"

# View -> (views it reads, SQL over the given tables).
SQL_VIEWS: dict[str, tuple[list[str], str]] = {
    "movies": ([], "SELECT p_partkey AS movie_id, p_name AS title, p_type || '| ' || p_brand AS genres FROM part"),
    "rating_rows": (
        [],
        """SELECT l_orderkey, l_linenumber, l_returnflag, l_suppkey,
                  CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -1 - l_partkey ELSE l_partkey END AS movie_id,
                  ceil(l_quantity / 5) * 0.5 AS rating, CAST(epoch(l_shipdate) AS BIGINT) AS ts FROM lineitem""",
    ),
    "ratings": (
        ["rating_rows"],
        """SELECT CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN -1 - o_custkey ELSE o_custkey END AS user_id,
                  movie_id, rating, ts FROM rating_rows LEFT JOIN orders ON o_orderkey = l_orderkey""",
    ),
    "users": (
        [],
        """SELECT c_custkey AS user_id, CASE WHEN c_custkey % 11 = 0 THEN 'x' WHEN c_custkey % 2 = 0 THEN 'm' ELSE 'F' END AS gender,
                  CAST(1 + c_custkey % 60 AS INTEGER) AS age, c_nationkey AS occupation FROM customer""",
    ),
    "occupations": ([], "SELECT n_nationkey AS occupation, n_name AS occupation_name FROM nation"),
    "reviews": (
        [],
        """SELECT doc_id AS id, text AS review, lang AS category,
                  unnest(CASE WHEN toxic = 1 THEN [source, source] WHEN quality = 1 THEN [source, 'GENERAL'] ELSE [source] END) AS aspect,
                  CASE quality WHEN 1 THEN 'positive' WHEN 0 THEN 'negative' END AS sentiment
           FROM documents LEFT JOIN labels USING (doc_id)""",
    ),
    "stopwords": ([], f"SELECT * FROM (VALUES {_WORDS}) AS t(stopword)"),
    "cleaned": (["reviews"], f"SELECT *, {_CLEAN} AS clean FROM reviews"),
    "shop_orders": (
        [],
        """SELECT o_orderkey AS Order_ID,
                  CASE WHEN o_orderkey % 97 > 0 THEN 'A' || (o_custkey * 4 + o_orderkey % 4) END AS Customer_Trx_ID,
                  o_orderstatus AS Order_Status, o_orderdate AS Order_Purchase_TS,
                  CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_days(CAST(o_orderkey % 15 AS INTEGER))
                       + to_seconds((o_orderkey % 7) * 150) END AS Order_Delivered_Carrier_TS FROM orders""",
    ),
    "shop_customers": (
        [],
        """SELECT 'A' || (c_custkey * 4 + a) AS Customer_Trx_ID, n_name AS Customer_Country, 'C' || c_nationkey AS Customer_Country_Code
           FROM customer JOIN nation ON n_nationkey = c_nationkey, (VALUES (0), (1), (2), (3)) AS t(a)""",
    ),
    "shop_items": (
        [],
        """SELECT l_orderkey AS Order_ID, l_linenumber AS Order_Item_ID,
                  CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -1 - l_partkey ELSE l_partkey END AS Product_ID,
                  l_suppkey AS Seller_ID, CAST(l_extendedprice AS DECIMAL(12,2)) AS Price,
                  CAST(CASE WHEN l_returnflag = 'N' AND l_linenumber = 6 THEN NULL ELSE l_quantity END AS DECIMAL(12,2)) AS Freight_Value,
                  Price + Freight_Value AS Item_Revenue FROM lineitem""",
    ),
    "limited_items": (
        [],
        """SELECT l_orderkey AS Order_ID, l_linenumber AS Order_Item_ID, o_orderdate + to_days(l_linenumber) AS Shipping_Limit_TS
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    ),
    "order_reviews": (
        [],
        """SELECT Order_ID, Review_Score FROM (SELECT o_orderkey AS Order_ID,
                  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN '9' WHEN o_orderkey % 13 = 0 THEN '4.5'
                       WHEN o_orderkey % 29 = 0 THEN 'n/a' ELSE o_orderpriority[1] END AS Review_Score,
                  unnest(CASE WHEN o_orderkey % 23 = 0 THEN [1, 2] ELSE [1] END) AS copy FROM orders)""",
    ),
    "valid_reviews": (
        ["order_reviews"],
        """SELECT Order_ID, Review_Score, CAST(trunc(TRY_CAST(Review_Score AS DOUBLE)) AS INTEGER) AS Review_Score_Int
           FROM order_reviews WHERE trunc(TRY_CAST(Review_Score AS DOUBLE)) BETWEEN 1 AND 5""",
    ),
    "products": ([], "SELECT p_partkey AS Product_ID, p_type AS Product_Category_Name FROM part"),
    "keyed_events": ([], "SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"),
    "frames": (
        ["keyed_events"],
        """SELECT CAST(event_id AS BIGINT) AS frame_id, epoch_us(ts) / 1e6 AS "timestamp", ts,
                  k % 5 AS person_count,
                  CASE WHEN event_type <> 'error' OR k % 10 <> 0 THEN value / 1000 END AS process_latency_seconds, value / 500 AS total_latency_seconds FROM keyed_events""",
    ),
}
