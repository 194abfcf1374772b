from __future__ import annotations

import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe.functions import labels, numbers, text, times
from tallyframe.operators.words import words_of


def one(spark, schema, values, *columns):
    return [tuple(row) for row in spark.createDataFrame(values, schema).select(*columns).collect()]


def test_age_bands_include_their_upper_end(spark):
    ages = [-3, 0, 18, 19, 35, 36, 50, 51, None]
    found = one(spark, "age INT", [(age,) for age in ages], labels.age_band(F.col("age")))
    assert [band for (band,) in found] == ["0-18", "0-18", "0-18", "18-35", "18-35", "35-50", "35-50", "50+", None]


def test_only_exact_age_codes_have_a_label(spark):
    ages = [1, 18, 25, 28, 35, 45, 50, 56, 57, None]
    found = one(spark, "age INT", [(age,) for age in ages], labels.age_code_label(F.col("age")))
    expected = ["Under 18", "18-24", "25-34", "Unknown", "35-44", "45-49", "50-55", "56+", "Unknown", "Unknown"]
    assert [label for (label,) in found] == expected


def test_late_is_judged_on_the_rounded_delay(spark):
    start = datetime.datetime(2024, 1, 1)
    moments = [(start + datetime.timedelta(seconds=seconds), start) for seconds in (431, 432, 433, 0, -86400)]
    delay = times.days_between(F.col("a"), F.col("b"))
    found = one(spark, "a TIMESTAMP, b TIMESTAMP", moments, delay, labels.delivery_flag(delay))
    late, on_time = "Late", "On time or early"
    assert found == [(0.0, on_time), (0.01, late), (0.01, late), (0.0, on_time), (-1.0, on_time)]


def test_customer_segments_and_missing_values(spark):
    rows = [(4, 10.0), (4, 9.0), (5, None), (3, 99.0), (2, 1.0), (1, 99.0)]
    found = one(spark, "n INT, v DOUBLE", rows, labels.customer_segment(F.col("n"), F.col("v"), F.lit(10.0)))
    assert [s for (s,) in found] == ["High-value loyal", "Loyal", "Loyal", "Repeat", "Repeat", "One-time"]


def test_purchase_gap_is_null_for_one_order(spark):
    day = datetime.datetime
    rows = [(day(2024, 1, 1), day(2024, 1, 11), 1), (day(2024, 1, 1), day(2024, 1, 11), 4), (day(2024, 1, 1), day(2024, 1, 1), 2)]
    gap = labels.purchase_gap_days(F.col("a"), F.col("b"), F.col("n"))
    assert one(spark, "a TIMESTAMP, b TIMESTAMP, n BIGINT", rows, gap) == [(None,), (3.33,), (0.0,)]


def test_defaults(spark):
    found = one(
        spark, "x DOUBLE, s STRING", [(None, None), (1.5, "t")],
        labels.zero_if_missing(F.col("x")), labels.text_or_missing(F.col("s")), labels.title_or_unknown(F.col("s")),
    )
    assert found == [(0.0, "NA", "Unknown Movie"), (1.5, "t", "t")]


@pytest.mark.parametrize("number", [3.125, 3.375, 2.675, 1.005, 0.125, 4.085, 2.5, 0.0, 1234.565])
def test_two_decimals_in_both_styles(spark, number):
    (even, up), = one(spark, "x DOUBLE", [(number,)], text.fixed2_half_even(F.col("x")), text.fixed2_half_up(F.col("x")))
    assert even == f"{number:.2f}"
    assert abs(float(up) - number) <= 0.005 + 1e-9 and float(up) >= float(even)


TEXTS = st.lists(st.text(alphabet=st.sampled_from("aZéßđạ9 ٣\t\n\r.,-_'\"*()!🙂 x"), max_size=40), min_size=1, max_size=30)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TEXTS)
def test_one_split_gives_the_words_of_the_cleaned_text(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, t STRING")
    cleaned = df.select("id", F.explode(F.split(text.clean_text(F.col("t")), " ")).alias("word")).where("word <> ''")
    ours = words_of(df, "t", "id")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, cleaned.collect()))


def test_cleaning_keeps_accented_letters_and_digits(spark):
    found = one(spark, "t STRING", [("  Phòng RẤT   tốt!!! (10/10)\tok ",), ("...",), ("",)], text.clean_text(F.col("t")))
    assert found == [("phòng rất tốt 10 10 ok",), ("",), ("",)]


def test_list_items_trimmed_and_raw(spark):
    found = one(spark, "g STRING", [("A| B |C",)], text.list_items(F.col("g")), text.list_items(F.col("g"), False))
    assert found == [(["A", "B", "C"], ["A", " B ", "C"])]


def test_control_characters_are_trimmed_at_both_ends(spark):
    assert one(spark, "t STRING", [("\t a b\r\n",)], text.trim_all(F.col("t"))) == [("a b",)]


def test_bars_and_separators(spark):
    found = one(spark, "p DOUBLE, n BIGINT", [(0.8, 1935), (59.1, 12)], text.percent_bar(F.col("p")), text.thousands(F.col("n")))
    assert found == [("", "1,935"), ("#" * 29, "12")]


def test_bad_time_text_is_null_and_timestamps_stay(spark):
    found = one(spark, "t STRING", [("2024-02-29 10:30",), ("2024-02-30 10:30",), ("soon",), (None,)], times.parse_minute(F.col("t")).cast("string"))
    assert found == [("2024-02-29 10:30:00",), (None,), (None,), (None,)]
    moment = spark.sql("SELECT timestamp'2024-05-06 07:08:09' AS t").select(times.parse_minute(F.col("t")).cast("string"))
    assert moment.first()[0] == "2024-05-06 07:08:09"


def test_epoch_helpers(spark):
    rows = [(978300760.25,), (None,)]
    year = times.epoch_year(F.col("s"))
    shown, clock = times.epoch_text(F.col("s")), times.epoch_text(F.col("s"), times.CLOCK_FORMAT)
    found = one(spark, "s DOUBLE", rows, year, shown, clock, times.timestamp_epoch(times.epoch_to_timestamp(F.col("s"))))
    assert found == [(2000, "2000-12-31 22:12:40", "22:12:40", 978300760.25), (None, "N/A", "N/A", None)]


def test_year_range_equals_the_year_function(spark):
    stamps = [("2023-12-31 23:59:59",), ("2024-01-01 00:00:00",), ("2024-12-31 23:59:59",), ("2025-01-01 00:00:00",), (None,)]
    df = spark.createDataFrame(stamps, "t STRING").withColumn("t", F.col("t").cast("timestamp"))
    assert df.where(times.in_year(F.col("t"), 2024)).count() == df.where(F.year("t") == 2024).count() == 2


def test_lenient_casts(spark):
    texts = ["4", "4.5", " 3 ", "n/a", "", None, "9"]
    found = one(
        spark, "s STRING", [(t,) for t in texts],
        numbers.truncated_int(F.col("s")), numbers.to_long(F.col("s")), numbers.to_double(F.col("s")),
    )
    assert found == [(4, 4, 4.0), (4, None, 4.5), (3, 3, 3.0), (None, None, None), (None, None, None), (None, None, None), (9, 9, 9.0)]


def test_exact_mean_rounds_the_true_quotient(spark):
    df = spark.createDataFrame([("a", "1.00"), ("a", "1.01"), ("b", None)], "k STRING, v STRING").withColumn("v", F.col("v").cast("decimal(12,2)"))
    found = df.groupBy("k").agg(numbers.exact_mean(F.col("v"), 2).cast("double").alias("m")).orderBy("k").collect()
    assert [tuple(row) for row in found] == [("a", 1.01), ("b", None)]


def test_empty_items_at_the_end_go_from_the_trimmed_form_only(spark):
    fields = [("A| B||",), ("A||B",), ("||",), ("",), (None,)]
    assert one(spark, "t STRING", fields, text.list_items(F.col("t"))) == [(["A", "B"],), (["A", "", "B"],), ([],), ([""],), (None,)]
    assert one(spark, "t STRING", fields[:1], text.list_items(F.col("t"), trimmed=False)) == [(["A", " B", "", ""],)]
