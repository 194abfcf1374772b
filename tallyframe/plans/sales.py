"""Sales: orders, review scores, revenue, delivery, customer segments and seller ranks.

Tables keep the column names of the shop export: Orders, Customer_List, Order_Items,
Order_Reviews and Products. Money is summed in whole cents and given back as a double.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.labels import customer_segment, delivery_flag, purchase_gap_days
from tallyframe.functions.numbers import cents, exact_mean, from_cents, mean_of_cents, money, truncated_int
from tallyframe.functions.times import days_between, in_year, parse_minute
from tallyframe.operators.aggregates import count_by, distinct_values
from tallyframe.operators.ordered import dense_rank_all, exact_quantile, sketched_quantile
from tallyframe.operators.rows import union_all
from tallyframe.session import stored

# Text column -> parsed column, and the names of the overview metrics.
ORDER_TIMES = {
    "Order_Purchase_Timestamp": "Order_Purchase_TS",
    "Order_Approved_At": "Order_Approved_TS",
    "Order_Delivered_Carrier_Date": "Order_Delivered_Carrier_TS",
    "Order_Delivered_Customer_Date": "Order_Delivered_Customer_TS",
    "Order_Estimated_Delivery_Date": "Order_Estimated_Delivery_TS",
}
METRIC_ORDERS = "Tổng số đơn hàng"
METRIC_CUSTOMERS = "Số lượng khách hàng"
METRIC_SELLERS = "Số lượng người bán"


def clean_orders(orders: DataFrame) -> DataFrame:
    """Add the five order times as timestamps; text of another form gives NULL."""
    return orders.withColumns({parsed: parse_minute(F.col(text)) for text, parsed in ORDER_TIMES.items()})


def item_revenue() -> Column:
    """Price and freight; NULL if either is."""
    return money(F.col("Price")) + money(F.col("Freight_Value"))


def item_cents() -> Column:
    """The same in cents, for sums."""
    return cents(F.col("Price")) + cents(F.col("Freight_Value"))


def clean_items(items: DataFrame) -> DataFrame:
    return items.withColumns({"Shipping_Limit_TS": parse_minute(F.col("Shipping_Limit_Date")), "Item_Revenue": item_revenue()})


def clean_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews with a whole score from 1 to 5; fractions are cut off, other text goes."""
    scored = reviews.withColumn("Review_Score_Int", truncated_int(F.col("Review_Score")))
    return scored.where(F.col("Review_Score_Int").between(1, 5))


def overview(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """Number of distinct orders, customers and sellers, a missing key counting as one."""

    def metric(name: str, table: DataFrame, key: str) -> DataFrame:
        return table.agg(F.lit(name).alias("Metric"), distinct_values(key).alias("Value"))

    return union_all(
        metric(METRIC_ORDERS, orders, "Order_ID"),
        metric(METRIC_CUSTOMERS, customers, "Customer_Trx_ID"),
        metric(METRIC_SELLERS, items, "Seller_ID"),
    )


def orders_by_country(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct orders per country; orders without a customer form a group without a country."""
    place = ["Customer_Country", "Customer_Country_Code"]
    places = customers.select("Customer_Trx_ID", *place)
    placed = orders.select("Order_ID", "Customer_Trx_ID").join(places, "Customer_Trx_ID", "left")
    return placed.groupBy(*place).agg(F.count_distinct("Order_ID").alias("Total_Orders")).orderBy(F.desc("Total_Orders"))


def orders_by_month(orders: DataFrame) -> DataFrame:
    """Distinct orders per month of purchase, years ascending, months descending."""
    bought = F.col("Order_Purchase_TS")
    months = orders.where(bought.isNotNull()).select(
        "Order_ID", F.year(bought).alias("Purchase_Year"), F.month(bought).alias("Purchase_Month")
    )
    counts = months.groupBy("Purchase_Year", "Purchase_Month").agg(F.count_distinct("Order_ID").alias("Total_Orders"))
    return counts.orderBy(F.asc("Purchase_Year"), F.desc("Purchase_Month"))


def review_cleaning(reviews: DataFrame) -> DataFrame:
    """Rows before and after cleaning, in one pass."""
    valid = truncated_int(F.col("Review_Score")).between(1, 5)
    return reviews.agg(F.count(F.lit(1)).alias("Rows_Before"), F.count_if(valid).alias("Rows_Valid"))


def average_score(reviews: DataFrame) -> DataFrame:
    score = exact_mean(F.col("Review_Score_Int"), 3).cast("double")
    return clean_reviews(reviews).agg(score.alias("Average_Review_Score"))


def score_distribution(reviews: DataFrame) -> DataFrame:
    return count_by(clean_reviews(reviews), ["Review_Score_Int"], "Number_Of_Reviews").orderBy("Review_Score_Int")


def revenue_by_category(items: DataFrame, orders: DataFrame, products: DataFrame, year: int = 2024) -> DataFrame:
    """Revenue and items per category of the orders of one year.

    The year reaches the scan of the orders. Items are summed per product before the category is
    looked up, so the product table joins rows of products, not of items.
    """
    bought = orders.where(in_year(F.col("Order_Purchase_TS"), year)).select("Order_ID")
    sold = items.select("Order_ID", "Product_ID", item_cents().alias("cents")).join(bought, "Order_ID")
    per_product = sold.groupBy("Product_ID").agg(F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("items"))
    named = per_product.join(products.select("Product_ID", "Product_Category_Name"), "Product_ID", "left")
    total = from_cents(F.sum("cents")).alias(f"Total_Revenue_{year}")
    grouped = named.groupBy("Product_Category_Name").agg(total, F.sum("items").alias("Total_Items_Sold"))
    return grouped.orderBy(F.desc(f"Total_Revenue_{year}"))


def product_sales(items: DataFrame, products: DataFrame, reviews: DataFrame) -> DataFrame:
    """Units sold and mean score per product; an item counts once per review of its order.

    Each order's reviews are folded to their number and score sum, so the join does not fan out:
    an order with no valid review still counts one row per item. Products tie often, so their id
    ends the order and spreads it.
    """
    per_order = clean_reviews(reviews).groupBy("Order_ID").agg(
        F.count(F.lit(1)).alias("reviews"), F.sum("Review_Score_Int").alias("score")
    )
    reviewed = items.select("Order_ID", "Product_ID").join(per_order, "Order_ID", "left")
    per_product = reviewed.groupBy("Product_ID").agg(
        F.sum(F.coalesce("reviews", F.lit(1))).alias("units"), F.sum("reviews").alias("reviews"), F.sum("score").alias("score")
    )
    named = per_product.join(products.select("Product_ID", "Product_Category_Name"), "Product_ID", "left")
    keys = ["Product_ID", "Product_Category_Name"]
    merged = named.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in ("units", "reviews", "score")])
    mean = F.round(F.col("score") / F.col("reviews").cast("decimal(18,0)"), 3).cast("double")
    sold = merged.select(*keys, F.col("units").alias("Units_Sold"), mean.alias("Average_Review_Score"))
    return sold.orderBy(F.desc("Units_Sold"), F.desc("Average_Review_Score"), F.asc("Product_ID"))


def best_selling_product(items: DataFrame, products: DataFrame, reviews: DataFrame) -> DataFrame:
    """The first row of :func:`product_sales`; its order makes way for a heap of one row."""
    return product_sales(items, products, reviews).limit(1)


def _delays(orders: DataFrame, items: DataFrame) -> DataFrame:
    handed_over = orders.where(F.col("Order_Delivered_Carrier_TS").isNotNull())
    handed_over = handed_over.select("Order_ID", "Order_Status", "Order_Delivered_Carrier_TS")
    limits = items.where(F.col("Shipping_Limit_TS").isNotNull()).select("Order_ID", "Order_Item_ID", "Shipping_Limit_TS")
    delay = days_between(F.col("Order_Delivered_Carrier_TS"), F.col("Shipping_Limit_TS"))
    joined = limits.join(handed_over, "Order_ID").withColumn("Delivery_Delay_Days", delay)
    return joined.withColumn("Delivery_Performance", delivery_flag(F.col("Delivery_Delay_Days")))


def delivery_detail(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Delay of each item in days against its shipping limit, and whether it is late."""
    return _delays(orders, items).select(
        "Order_ID",
        "Order_Status",
        "Order_Delivered_Carrier_TS",
        "Order_Item_ID",
        "Shipping_Limit_TS",
        "Delivery_Delay_Days",
        "Delivery_Performance",
    )


def delivery_summary(orders: DataFrame, items: DataFrame) -> DataFrame:
    delay = F.col("Delivery_Delay_Days")
    summary = _delays(orders, items).groupBy("Delivery_Performance").agg(
        F.count(F.lit(1)).alias("Number_Of_Order_Items"),
        mean_of_cents(cents(delay)).alias("Average_Delay_Days"),
        F.min(delay).alias("Min_Delay_Days"),
        F.max(delay).alias("Max_Delay_Days"),
    )
    return summary.orderBy("Delivery_Performance")


def _customer_metrics(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders, mean order value and purchase dates per customer, by way of the value per order."""
    values = items.select("Order_ID", item_cents().alias("cents")).groupBy("Order_ID").agg(F.sum("cents").alias("cents"))
    bought = orders.where(F.col("Order_Purchase_TS").isNotNull()).select("Order_ID", "Customer_Trx_ID", "Order_Purchase_TS")
    metrics = bought.join(values, "Order_ID", "left").groupBy("Customer_Trx_ID").agg(
        F.count_distinct("Order_ID").alias("Total_Orders"),
        mean_of_cents(F.col("cents")).alias("Average_Order_Value"),
        F.min("Order_Purchase_TS").alias("First_Purchase_TS"),
        F.max("Order_Purchase_TS").alias("Last_Purchase_TS"),
    )
    gap = purchase_gap_days(F.col("First_Purchase_TS"), F.col("Last_Purchase_TS"), F.col("Total_Orders"))
    return metrics.withColumn("Purchase_Frequency_Days", gap)


def _segmented(orders: DataFrame, items: DataFrame, fraction: float, relative_error: float) -> DataFrame:
    """The metrics are read for the limit, of one column, and for the segments, so they are stored once."""
    metrics = stored(_customer_metrics(orders, items), "metrics")
    if relative_error > 0:
        limit = sketched_quantile(metrics, "Average_Order_Value", fraction, relative_error)
    else:
        limit = exact_quantile(metrics, "Average_Order_Value", fraction)
    segment = customer_segment(F.col("Total_Orders"), F.col("Average_Order_Value"), limit.scalar())
    return metrics.withColumn("Customer_Segment", segment)


def customer_segments(orders: DataFrame, items: DataFrame, fraction: float = 0.75, relative_error: float = 0.0) -> DataFrame:
    """Metrics and segment per customer; the high-value limit is a quantile of the mean values."""
    return _segmented(orders, items, fraction, relative_error)


def segment_summary(orders: DataFrame, items: DataFrame, fraction: float = 0.75, relative_error: float = 0.0) -> DataFrame:
    summary = _segmented(orders, items, fraction, relative_error).groupBy("Customer_Segment").agg(
        F.count(F.lit(1)).alias("Number_Of_Customers"),
        exact_mean(F.col("Total_Orders"), 2).cast("double").alias("Avg_Total_Orders"),
        mean_of_cents(cents(F.col("Average_Order_Value"))).alias("Avg_Order_Value"),
        mean_of_cents(cents(F.col("Purchase_Frequency_Days"))).alias("Avg_Frequency_Days"),
    )
    return summary.orderBy(F.desc("Number_Of_Customers"))


def seller_performance(items: DataFrame) -> DataFrame:
    return items.select("Seller_ID", "Order_ID", item_cents().alias("cents")).groupBy("Seller_ID").agg(
        from_cents(F.sum("cents")).alias("Total_Revenue"),
        F.count_distinct("Order_ID").alias("Total_Orders"),
        F.count(F.lit(1)).alias("Total_Items_Sold"),
        mean_of_cents(F.col("cents")).alias("Avg_Item_Revenue"),
    )


def seller_ranking(items: DataFrame) -> DataFrame:
    """Sellers by revenue, then by orders; equal sellers share a rank and no rank is left out."""
    ranked = dense_rank_all(seller_performance(items), ["Total_Revenue", "Total_Orders"], "Seller_Rank")
    return ranked.orderBy("Seller_Rank", "Seller_ID")
