from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.operators import ordered
from tallyframe.operators.rows import top_per_group


def frames(spark, count, seed=1, hot=0.0, partitions=5):
    """Random rows; a share ``hot`` of them has the same key."""
    draw = random.Random(seed)
    values = [(0 if draw.random() < hot else draw.randrange(count), i, draw.choice([None, 0, 1, 2, 3])) for i in range(count)]
    return spark.createDataFrame(values, "k INT, i INT, v INT").repartition(partitions)


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_row_index_counts_on_over_all_partitions(spark, partitions):
    df = frames(spark, 500, hot=0.4)
    found = ordered.with_row_index(df, [F.asc("k"), F.desc("i")], "at", partitions).collect()
    expected = sorted(df.collect(), key=lambda row: (row.k, -row.i))
    assert [(row.k, row.i) for row in sorted(found, key=lambda row: row.at)] == [(row.k, row.i) for row in expected]
    assert sorted(row.at for row in found) == list(range(500))


def test_row_index_splits_a_key_that_holds_all_rows(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), "id")
    indexed = ordered.with_row_index(df, [F.asc("k")], "at", 8)
    assert sorted(row.at for row in indexed.collect()) == list(range(1000))
    parts = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(8, "k", "_tie")
    assert parts.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 500


def test_row_index_of_nothing(spark):
    assert ordered.with_row_index(spark.range(0), [F.asc("id")]).collect() == []


@pytest.mark.parametrize(("before", "after", "bucket"), [(2, 2, 3), (2, 2, 1), (0, 4, 7), (5, 1, 2), (2, 2, 1000)])
def test_spread_moving_average_equals_the_plain_window(spark, before, after, bucket):
    df = frames(spark, 200, seed=before + bucket, hot=0.3)
    order = [F.asc("k"), F.asc("i")]
    spread = ordered.centred_average(df, order, "v", "m", before, after, bucket_rows=bucket, partitions=6)
    plain = df.withColumn("m", F.avg("v").over(Window.orderBy(*order).rowsBetween(-before, after)))
    assert sorted(map(tuple, spread.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_moving_average_stays_within_its_group(spark):
    df = frames(spark, 150, seed=4).withColumn("g", F.col("i") % 4)
    spread = ordered.centred_average(df, [F.asc("i")], "v", "m", groups=["g"], bucket_rows=5, partitions=4)
    plain = df.withColumn("m", F.avg("v").over(Window.partitionBy("g").orderBy("i").rowsBetween(-2, 2)))
    columns = ["g", "i", "m"]
    assert sorted(map(tuple, spread.select(*columns).collect()), key=repr) == sorted(map(tuple, plain.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("count", [0, 1, 3])
def test_moving_average_of_few_rows(spark, count):
    df = spark.range(count).select("id", F.col("id").cast("int").alias("v"))
    found = sorted(map(tuple, ordered.centred_average(df, [F.asc("id")], "v", "m").collect()))
    assert found == [(i, i, sum(range(count)) / count) for i in range(count)]


@pytest.mark.parametrize("partitions", [1, 5])
def test_dense_rank_equals_the_plain_window(spark, partitions):
    df = frames(spark, 120, seed=9, hot=0.5).select("i", (F.col("k") % 7).alias("a"), "v")
    found = ordered.dense_rank_all(df, ["a", "v"], "r", partitions)
    plain = df.withColumn("r", F.dense_rank().over(Window.orderBy(F.desc("a"), F.desc("v"))))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 0.75, 1.0])
def test_exact_quantile_is_the_value_at_its_rank(spark, fraction):
    df = frames(spark, 101, seed=3, hot=0.2).withColumn("k", F.when(F.col("i") % 10 != 0, F.col("k")))
    values = sorted(row.k for row in df.collect() if row.k is not None)
    rank = max(-(-int(fraction * 100) * len(values) // 100) - 1, 0)
    assert [row.quantile for row in ordered.exact_quantile(df, "k", fraction).collect()] == [values[rank]]


@pytest.mark.parametrize("shape", ["spread", "few", "one", "skewed", "decimal", "day", "special"])
@pytest.mark.parametrize("fraction", [0.0, 0.31, 0.75, 1.0])
def test_selection_equals_the_sorted_values(spark, shape, fraction):
    kinds = {
        "spread": "rand(5)",
        "few": "CAST(rand(5) * 7 AS INT)",
        "one": "3",
        "skewed": "CASE WHEN id % 3 = 0 THEN 10L ELSE CAST(pow(rand(5), 9) * 1000 AS BIGINT) END",
        "decimal": "CAST(rand(5) * 1000 AS DECIMAL(12,2))",
        "day": "date_add(DATE'2020-01-01', CAST(rand(5) * 900 AS INT))",
        "special": "CASE id % 50 WHEN 0 THEN double('NaN') WHEN 1 THEN double('-Infinity') ELSE rand(5) END",
    }
    df = spark.range(3000).selectExpr(f"CASE WHEN id % 11 > 0 THEN {kinds[shape]} END AS x").repartition(5)
    values = [row.x for row in df.where("x IS NOT NULL").orderBy("x").collect()]
    expected = values[max(math.ceil(len(values) * fraction) - 1, 0)]
    for rows, accuracy in ((20, 50), (400, 1000), (1 << 16, 10_000)):
        found = [row.quantile for row in ordered.exact_quantile(df, "x", fraction, rows, accuracy).collect()]
        assert found == [expected] or (found[0] != found[0] and expected != expected)


def test_selection_sorts_a_slice_only(spark):
    found = ordered.exact_quantile(spark.range(200_000).selectExpr("hash(id) AS x"), "x", 0.5, slice_rows=500)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan and found.count() == 1


def test_quantile_of_text_is_its_value_too(spark):
    words = spark.createDataFrame([(word,) for word in "delta alpha echo bravo charlie".split()], "x string")
    assert [row.quantile for row in ordered.exact_quantile(words, "x", 0.5, slice_rows=2).collect()] == ["charlie"]


def test_quantile_of_nothing_is_no_row_and_null(spark):
    empty = spark.range(3).select(F.lit(None).cast("double").alias("x"))
    assert ordered.exact_quantile(empty, "x", 0.75).collect() == []
    assert ordered.sketched_quantile(empty, "x", 0.75).first()[0] is None


def test_top_per_group_takes_k_of_each_and_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", w, n) for w, n in (("x", 3), ("y", 3), ("z", 1), ("w", 9))] + [("b", "q", 1)], "g STRING, w STRING, n INT")
    top = top_per_group(df, ["g"], 2, F.desc("n"), F.asc("w"))
    assert sorted(map(tuple, top.collect())) == [("a", "w", 9), ("a", "x", 3), ("b", "q", 1)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
