from __future__ import annotations

import datetime

import pytest

from tallyframe.plans import sales


def day(number, hour=0, second=0):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(days=number, hours=hour, seconds=second)


@pytest.fixture(scope="module")
def orders(spark):
    schema = "Order_ID STRING, Customer_Trx_ID STRING, Order_Status STRING, Order_Purchase_TS TIMESTAMP, Order_Delivered_Carrier_TS TIMESTAMP"
    rows = [(f"a{i}", "A", "done", day(10 * i), day(10 * i, 1)) for i in range(4)]
    rows += [(f"b{i}", "B", "done", day(i), None) for i in range(2)]
    rows += [("c0", "C", "open", day(400), day(401)), ("d0", None, "open", None, day(1)), ("a0", "A", "done", day(0), day(0, 1))]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def customers(spark):
    rows = [("A", "France", "FR"), ("B", "Spain", "ES"), (None, "Nowhere", "NO"), (None, "Nowhere", "NO")]
    return spark.createDataFrame(rows, "Customer_Trx_ID STRING, Customer_Country STRING, Customer_Country_Code STRING")


@pytest.fixture(scope="module")
def items(spark):
    schema = "Order_ID STRING, Order_Item_ID INT, Product_ID STRING, Seller_ID STRING, Price DOUBLE, Freight_Value DOUBLE, Shipping_Limit_TS TIMESTAMP"
    rows = [
        ("a0", 1, "p", "s1", 10.0, 1.0, day(0, 1, -431)), ("a1", 1, "p", "s1", 20.0, 1.0, day(10, 1, -433)),
        ("a2", 1, "q", "s2", 31.0, 1.0, day(22)), ("a3", 1, "r", "s2", 5.0, None, None), ("b0", 1, "p", "s3", 32.0, 0.0, day(0)),
        ("c0", 1, "q", "s4", 1.0, 1.0, day(300)), ("zz", 9, "q", "s4", 1.0, 1.0, day(300)),
    ]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([("p", "toys"), ("q", "food")], "Product_ID STRING, Product_Category_Name STRING")


@pytest.fixture(scope="module")
def scores(spark):
    rows = [("a0", "5"), ("a0", "2"), ("a1", "4.5"), ("a2", "0"), ("b0", "6"), ("b0", "n/a"), ("c0", None), ("c0", "1")]
    return spark.createDataFrame(rows, "Order_ID STRING, Review_Score STRING")


def test_times_and_revenue_are_added(spark, rows):
    schema = ", ".join(f"{name} STRING" for name in ["Order_ID", *sales.ORDER_TIMES])
    raw = spark.createDataFrame([("1", "2024-01-02 03:04", None, "bad", "2024-01-02", "2024-01-02 00:00")], schema)
    assert rows(sales.clean_orders(raw).selectExpr(*[f"CAST({name} AS STRING)" for name in sales.ORDER_TIMES.values()])) == [
        ("2024-01-02 03:04:00", None, None, None, "2024-01-02 00:00:00")
    ]
    item = spark.createDataFrame([(1.1, 2.2, "2024-01-01 10:00"), (1.0, None, None)], "Price DOUBLE, Freight_Value DOUBLE, Shipping_Limit_Date STRING")
    assert [row.Item_Revenue and float(row.Item_Revenue) for row in sales.clean_items(item).collect()] == [3.3, None]


def test_overview_counts_a_missing_key_once(rows, orders, customers, items):
    assert rows(sales.overview(orders, customers, items)) == sorted(
        [(sales.METRIC_ORDERS, 8), (sales.METRIC_CUSTOMERS, 3), (sales.METRIC_SELLERS, 4)]
    )


def test_countries_most_orders_first_with_a_null_group(rows, orders, customers):
    found = rows(sales.orders_by_country(orders, customers), ordered=True)
    assert found[0] == ("France", "FR", 4) and set(found[1:]) == {("Spain", "ES", 2), (None, None, 2)}


def test_months_descend_within_ascending_years(rows, orders):
    assert rows(sales.orders_by_month(orders), ordered=True) == [(2024, 1, 6), (2025, 2, 1)]


def test_dirty_scores(rows, scores):
    assert rows(sales.review_cleaning(scores)) == [(8, 4)]
    assert rows(sales.average_score(scores)) == [(3.0,)]
    assert rows(sales.score_distribution(scores), ordered=True) == [(1, 1), (2, 1), (4, 1), (5, 1)]


def test_revenue_of_one_year(rows, items, orders, products):
    once = orders.distinct()
    assert rows(sales.revenue_by_category(items, once, products), ordered=True) == [("toys", 64.0, 3), ("food", 32.0, 1), (None, None, 1)]
    assert rows(sales.revenue_by_category(items, once, products, 2025)) == [("food", 2.0, 1)]


def test_several_products_rows_and_orders_fan_out_as_a_join_would(rows, items, orders, products):
    doubled = products.unionByName(products.where("Product_ID = 'p'"))
    assert rows(sales.revenue_by_category(items, orders, doubled))[1] == ("toys", 150.0, 8)


def test_units_count_once_per_valid_review_of_the_order(rows, items, products, scores):
    found = rows(sales.product_sales(items, products, scores), ordered=True)
    assert found == [("p", "toys", 4, 3.667), ("q", "food", 3, 1.0), ("r", None, 1, None)]
    assert rows(sales.best_selling_product(items, products, scores)) == [("p", "toys", 4, 3.667)]


def test_delays(rows, orders, items):
    once = orders.distinct()
    detail = rows(sales.delivery_detail(once, items), "Order_ID", "Delivery_Delay_Days", "Delivery_Performance")
    assert detail == [("a0", 0.0, "On time or early"), ("a1", 0.01, "Late"), ("a2", -1.96, "On time or early"), ("c0", 101.0, "Late")]
    assert rows(sales.delivery_summary(once, items), ordered=True) == [("Late", 2, 50.51, 0.01, 101.0), ("On time or early", 2, -0.98, -1.96, 0.0)]


def test_customer_metrics_and_segments(rows, orders, items):
    once = orders.distinct()
    columns = ["Customer_Trx_ID", "Total_Orders", "Average_Order_Value", "Purchase_Frequency_Days", "Customer_Segment"]
    assert rows(sales.customer_segments(once, items, 0.75), *columns) == [
        ("A", 4, 21.33, 10.0, "Loyal"), ("B", 2, 32.0, 1.0, "Repeat"), ("C", 1, 2.0, None, "One-time"),
    ]
    top = rows(sales.customer_segments(once, items, 0.5), "Customer_Trx_ID", "Customer_Segment")
    assert top[0] == ("A", "High-value loyal")
    sketched = rows(sales.customer_segments(once, items, 0.5, relative_error=0.01), "Customer_Trx_ID", "Customer_Segment")
    assert sketched == top


def test_segment_summary(rows, orders, items):
    found = rows(sales.segment_summary(orders.distinct(), items))
    assert found == [("Loyal", 1, 4.0, 21.33, 10.0), ("One-time", 1, 1.0, 2.0, None), ("Repeat", 1, 2.0, 32.0, 1.0)]


def test_equal_sellers_share_a_rank(rows, items):
    found = rows(sales.seller_ranking(items), "Seller_ID", "Total_Revenue", "Total_Orders", "Seller_Rank", ordered=True)
    assert found == [("s1", 32.0, 2, 1), ("s2", 32.0, 2, 1), ("s3", 32.0, 1, 2), ("s4", 4.0, 2, 3)]


def test_the_year_reaches_the_scan(spark, tmp_path, items, products):
    path = str(tmp_path / "orders")
    spark.sql("SELECT 'a' AS Order_ID, timestamp_ntz'2024-05-05 00:00:00' AS Order_Purchase_TS").write.parquet(path)
    report = sales.revenue_by_category(items, spark.read.parquet(path), products)
    assert "GreaterThanOrEqual(Order_Purchase_TS" in report._jdf.queryExecution().executedPlan().toString()
