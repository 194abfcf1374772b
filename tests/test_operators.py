from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import aggregates, joins
from tallyframe.operators import rows as row_ops
from tallyframe.plans.sales import orders_by_country
from tallyframe.session import cut, scratch_path, shared_dir, stored


@pytest.fixture
def settings(spark):
    """Set options for one test."""
    before = {}

    def put(**options):
        for key, value in options.items():
            name = "spark.sql." + key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def test_a_hot_user_is_split_over_several_tasks(spark, settings):
    """A third of all ratings are of one user: the join spreads that user's partition."""
    settings(
        autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", adaptive__advisoryPartitionSizeInBytes="4k",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="8k", adaptive__skewJoin__skewedPartitionFactor="2.0", shuffle__partitions="16",
    )
    ratings = spark.range(0, 30000, 1, 8).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id % 500 END AS user_id", "id % 40 AS movie_id", "id % 5 AS rating")
    users = spark.range(500).selectExpr("id AS user_id", "IF(id % 2 = 0, 'm', 'f') AS gender")
    joined = joins.look_up(ratings, users, "user_id", ["gender"])
    means = aggregates.average_by(joined, ["movie_id", "gender"], "rating")
    assert sum(row.n for row in means.collect()) == 30000
    assert "skew=true" in means._jdf.queryExecution().executedPlan().toString()


def test_orders_without_customer_are_split_over_several_tasks(spark, settings, rows):
    """A third of all orders has no customer; the left join spreads them as well."""
    settings(
        autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", adaptive__advisoryPartitionSizeInBytes="4k",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="8k", adaptive__skewJoin__skewedPartitionFactor="2.0", shuffle__partitions="16",
    )
    orders = spark.range(0, 30000, 1, 8).selectExpr("id AS Order_ID", "CASE WHEN id % 3 > 0 THEN id % 1000 END AS Customer_Trx_ID")
    customers = spark.range(1000).selectExpr("id AS Customer_Trx_ID", "concat('L', id % 3) AS Customer_Country", "id % 3 AS Customer_Country_Code")
    report = orders_by_country(orders, customers)
    counts = {row.Customer_Country: row.Total_Orders for row in report.collect()}
    assert counts[None] == 10000 and sum(counts.values()) == 30000
    assert "skew=true" in report._jdf.queryExecution().executedPlan().toString()


def test_look_up_drops_or_keeps_unmatched(spark, rows):
    facts = spark.createDataFrame([(1, 5), (2, 6), (None, 7)], "k INT, v INT")
    names = spark.createDataFrame([(1, "one"), (3, "three"), (None, "none")], "k INT, name STRING")
    assert rows(joins.look_up(facts, names, "k", ["name"])) == [(1, 5, "one")]
    assert rows(joins.look_up(facts, names, "k", ["name"], True)) == sorted([(1, 5, "one"), (2, 6, None), (None, 7, None)], key=repr)


def test_listed_values_go_and_nulls_stay(spark, rows):
    words = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "word STRING, n INT")
    stop = spark.createDataFrame([("b",), ("a b",), (None,)], "entry STRING")
    assert rows(joins.without_listed(words, "word", stop, "entry")) == sorted([("a", 1), (None, 4)], key=repr)


def test_one_row_per_key(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k INT, t STRING")
    assert rows(joins.one_row_per_key(df, "k", "t")) == [(1, "b"), (2, None)]


def test_average_counts_only_values(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None)], "k STRING, v DOUBLE")
    assert rows(aggregates.average_by(df, ["k"], "v")) == [("a", 1.0, 1), ("b", None, 0)]
    assert rows(aggregates.average_of_sums(aggregates.sums_by(df, ["k"], "v"), ["k"])) == [("a", 1.0, 1)]


def test_distinct_values_count_null_once(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k INT")
    assert rows(df.agg(aggregates.distinct_values("k"))) == [(3,)]
    assert rows(df.where("k is not null").agg(aggregates.distinct_values("k"))) == [(2,)]
    assert rows(df.where("false").agg(aggregates.distinct_values("k"))) == [(0,)]


def test_wide_average_skips_other_groups(spark, rows):
    df = spark.createDataFrame([(1, "M", 1.0), (1, "F", 3.0), (2, "x", 5.0), (3, "M", None)], "k INT, g STRING, v DOUBLE")
    assert rows(aggregates.average_wide(df, ["k"], "g", "v", {"M": "m", "F": "f"})) == [(1, 1.0, 3.0)]


def test_share_reads_the_rows_once(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k STRING")
    shares = aggregates.count_with_share(df, "k")
    assert rows(shares) == sorted([("a", 2, 50.0), ("b", 1, 25.0), (None, 1, 25.0)], key=repr)
    shares.collect()
    assert "ReusedExchange" in shares._jdf.queryExecution().executedPlan().toString()


def test_best_row(spark, rows):
    df = spark.createDataFrame([(1, 4.0), (2, 5.0), (3, 5.0), (4, None)], "id INT, v DOUBLE")
    assert rows(aggregates.best_row(df, ["id", "v"], F.col("v"), -F.col("id"))) == [(2, 5.0)]
    assert rows(aggregates.best_row(df.where("false"), ["id"], F.col("v"))) == []


def test_unions_and_distinct_rows(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "k INT, t STRING")
    assert row_ops.union_all(df, df.select("t", "k")).count() == 10
    assert row_ops.distinct_rows(df).count() == 3
    assert rows(row_ops.distinct_rows(df, "k")) == sorted([(1,), (None,)], key=repr)


def test_newest_rows_oldest_first(spark, rows):
    df = spark.createDataFrame([(3,), (1,), (4,), (2,)], "t INT")
    assert rows(row_ops.latest_ascending(df, 2, [F.desc("t")], [F.asc("t")]), ordered=True) == [(3,), (4,)]


def test_a_cut_table_is_read_from_the_shared_folder(spark):
    table = cut(spark.range(10).groupBy((F.col("id") % 2).alias("k")).count())
    assert table.count() == 2
    assert "Exchange" not in table._jdf.queryExecution().executedPlan().toString()
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


def test_a_cluster_without_shared_folder_is_an_error():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_a_stored_table_is_read_by_column(spark):
    table = stored(spark.range(10).selectExpr("id", "id * 2 AS twice", "'x' AS unused"), "t")
    assert table.agg(F.sum("twice")).first()[0] == 90
    assert "ReadSchema: struct<twice:bigint>" in table.select("twice")._jdf.queryExecution().executedPlan().toString()
