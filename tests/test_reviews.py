from __future__ import annotations

import pytest

from tallyframe.plans import reviews

SCHEMA = "id INT, review STRING, category STRING, aspect STRING, sentiment STRING"


@pytest.fixture(scope="module")
def given(spark):
    rows = [
        (1, "Phòng đẹp, phòng SẠCH!", "ROOMS", "CLEAN", "positive"),
        (1, "Phòng đẹp, phòng SẠCH!", "ROOMS", "CLEAN", "positive"),
        (1, "Phòng đẹp, phòng SẠCH!", "ROOMS", "STYLE", "positive"),
        (1, "Phòng đẹp, phòng SẠCH!", "HOTEL", "STYLE", "negative"),
        (2, "và giá và giá, tại sao", "PRICES", "GENERAL", "negative"),
        (3, "...", "PRICES", "GENERAL", "positive"),
        (4, None, "PRICES", "CLEAN", None),
        (None, "giá tốt", "PRICES", None, "positive"),
        (5, "tốt", None, "CLEAN", "neutral"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def stop(spark):
    return spark.createDataFrame([("và",), ("tại sao",)], "stopword STRING")


def test_words_of_distinct_rows_without_stop_words(rows, given, stop):
    found = rows(reviews.review_words(given, stop))
    assert len(found) == 3 * 4 + 4 + 2 + 1
    assert (2, "tại", "PRICES", "GENERAL", "negative") in found and (2, "và", "PRICES", "GENERAL", "negative") not in found
    assert found.count((1, "phòng", "ROOMS", "CLEAN", "positive")) == 2
    assert (None, "tốt", "PRICES", None, "positive") in found


def test_frequent_words_count_each_review_once(rows, given, stop):
    assert rows(reviews.frequent_words(given, stop, 1)) == [("giá", 3), ("phòng", 2), ("tốt", 2)]
    assert rows(reviews.frequent_words(given, stop, 2)) == [("giá", 3)]


def test_rows_without_id_are_not_counted(rows, given):
    assert rows(reviews.rows_per(given, "category")) == sorted([("HOTEL", 1), ("PRICES", 3), ("ROOMS", 3), (None, 1)], key=repr)
    assert rows(reviews.rows_per(given, "aspect", "positive", "n")) == sorted([("CLEAN", 2), ("STYLE", 1), ("GENERAL", 1), (None, 0)], key=repr)


def test_most_of_takes_the_first_name_in_a_tie(spark, rows):
    counts = spark.createDataFrame([("b", 3), ("a", 3), ("c", 1)], "aspect STRING, n BIGINT")
    assert rows(reviews.most_of(counts, "aspect", "n")) == [("a", 3)]


def test_top_words_per_category_and_sentiment(rows, given, stop):
    assert rows(reviews.top_words(given, stop, 1)) == sorted(
        [("HOTEL", "phòng", 2), ("PRICES", "giá", 3), ("ROOMS", "phòng", 2), (None, "tốt", 1)], key=repr
    )
    assert rows(reviews.top_words(given, stop, 2, "negative")) == [
        ("HOTEL", "negative", "phòng", 2), ("HOTEL", "negative", "sạch", 1),
        ("PRICES", "negative", "giá", 2), ("PRICES", "negative", "sao", 1),
    ]


def test_the_sentiment_filter_goes_below_the_distinct(given, stop):
    plan = reviews.top_words(given, stop, 2, "negative")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Filter") > plan.rindex("Aggregate")
    assert "LeftAnti" in plan
