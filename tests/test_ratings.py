from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyframe.plans import ratings


@pytest.fixture(scope="module")
def movies(spark):
    rows = [(1, "One", "A| B"), (2, "Two", "B"), (3, "Same", "C"), (4, "Same", None), (10, "Ten", "A"), (5, "Unrated", "D"), (2, "Tva", "B")]
    return spark.createDataFrame(rows, "movie_id BIGINT, title STRING, genres STRING")


@pytest.fixture(scope="module")
def given(spark):
    rows = [(1, 1, 4.0), (2, 1, 5.0), (3, 2, 3.0), (9, 2, 2.0), (1, 3, 1.0), (2, 4, 5.0), (4, 10, 4.5), (5, 10, 4.5), (1, 99, 2.5)]
    stamped = [(*row, 978307199 + place) for place, row in enumerate(rows)]
    return spark.createDataFrame(stamped, "user_id BIGINT, movie_id BIGINT, rating DOUBLE, ts BIGINT")


@pytest.fixture(scope="module")
def users(spark):
    rows = [(1, "m", 18, 0), (2, "F", 19, 1), (3, "x", 35, 0), (4, "M", 51, 7), (5, "F", None, 1)]
    return spark.createDataFrame(rows, "user_id BIGINT, gender STRING, age INT, occupation INT")


@pytest.fixture(scope="module")
def occupations(spark):
    return spark.createDataFrame([(0, "clerk"), (1, "cook"), (2, "unused")], "occupation INT, occupation_name STRING")


def test_all_rated_movies_once_with_unknown_ones(rows, movies, given):
    found = rows(ratings.movie_average_all(movies, given))
    assert found == sorted(
        [(1, "One", 4.5, 2), (2, "Two", 2.5, 2), (3, "Same", 1.0, 1), (4, "Same", 5.0, 1), (10, "Ten", 4.5, 2), (99, "Unknown Movie", 2.5, 1)],
        key=repr,
    )


def test_best_movie_ties_go_to_the_first_id_in_text_order(rows, movies, given):
    assert rows(ratings.best_movie(movies, given, 2)) == [("One", 4.5)]
    assert rows(ratings.best_movie(movies, given.where("movie_id <> 1"), 2)) == [("Ten", 4.5)]
    assert rows(ratings.best_movie(movies, given, 1)) == [("Same", 5.0)]
    assert rows(ratings.best_movie(movies, given, 5)) == []


def test_text_order_of_ids_is_not_their_number_order(spark, rows, movies):
    tied = spark.createDataFrame([(1, 2, 4.0, 0), (1, 10, 4.0, 0)], "user_id BIGINT, movie_id BIGINT, rating DOUBLE, ts BIGINT")
    assert rows(ratings.best_movie(movies, tied, 1)) == [("Ten", 4.0)]
    assert rows(ratings.best_movie_known(movies.where("title <> 'Tva'"), tied, 1), "movie_id") == [(2,)]


def test_unknown_best_movie_has_the_stand_in_title(rows, movies, given):
    assert rows(ratings.best_movie(movies, given.where("movie_id = 99"), 1)) == [("Unknown Movie", 2.5)]


def test_genres_trimmed_and_raw(rows, movies, given):
    one_each = movies.where("title <> 'Tva'")
    assert rows(ratings.genre_average(one_each, given)) == [("A", 4.5, 4), ("B", 3.5, 4), ("C", 1.0, 1)]
    assert rows(ratings.genre_average(one_each, given, trimmed=False)) == [(" B", 4.5, 2), ("A", 4.5, 4), ("B", 2.5, 2), ("C", 1.0, 1)]


def test_genders_side_by_side(rows, movies, given, users):
    assert rows(ratings.gender_average_wide(movies, given, users)) == sorted(
        [(1, "One", 4.0, 5.0), (3, "Same", 1.0, 0.0), (4, "Same", 0.0, 5.0), (10, "Ten", 4.5, 4.5), (99, "Unknown Movie", 2.5, 0.0)], key=repr
    )


def test_age_bands_side_by_side(rows, movies, given, users):
    assert rows(ratings.age_average_wide(movies, given, users)) == sorted(
        [
            (1, "One", 4.0, 5.0, None, None), (2, "Two", None, 3.0, None, None), (3, "Same", 1.0, None, None, None),
            (4, "Same", None, 5.0, None, None), (10, "Ten", None, None, None, 4.5), (99, "Unknown Movie", 2.5, None, None, None),
        ],
        key=repr,
    )


def test_known_movies_only_in_id_order(rows, movies, given):
    found = rows(ratings.movie_average(movies.where("title <> 'Tva'"), given), ordered=True)
    assert found == [(1, "One", 4.5, 2), (2, "Two", 2.5, 2), (3, "Same", 1.0, 1), (4, "Same", 5.0, 1), (10, "Ten", 4.5, 2)]


def test_long_reports(rows, movies, given, users, occupations):
    one_each = movies.where("title <> 'Tva'")
    assert (3, "Same", "m", 1.0, 1) in rows(ratings.gender_average(one_each, given, users))
    ages = rows(ratings.age_code_average(one_each, given, users), "movie_id", "age_group", "n")
    assert (1, "18-24", 1) in ages and (1, "Unknown", 1) in ages and (2, "35-44", 1) in ages
    assert rows(ratings.occupation_average(given, users, occupations)) == [("clerk", 2.625, 4), ("cook", 14.5 / 3, 3)]


def test_years_follow_the_session_zone(rows, given):
    assert rows(ratings.year_average(given)) == [(2000, 4.0, 1), (2001, 27.5 / 8, 8)]


def test_text_lines(rows, movies, given, users):
    one_each = movies.where("title <> 'Tva'")
    assert rows(ratings.movie_average_all(movies, given).where("movie_id = 1"), ratings.movie_average_line()) == [("One AverageRating: 4.50 (TotalRatings: 2)",)]
    assert rows(ratings.best_movie(movies, given, 2), ratings.best_movie_line(2))[0][0] == (
        "One is the highest rated movie with an average rating of 4.50 among movies with at least 2 ratings."
    )
    assert rows(ratings.genre_average(movies, given).where("genre = 'C'"), ratings.genre_average_line()) == [("C Avg:1.00, Count: 1",)]
    assert rows(ratings.gender_average_wide(movies, given, users).where("movie_id = 3"), ratings.gender_wide_line()) == [
        ("Same Male: 1.00, Female: 0.00",)
    ]
    assert rows(ratings.age_average_wide(movies, given, users).where("movie_id = 1"), ratings.age_wide_line()) == [
        ("One 0-18: 4.00 18-35: 5.00 35-50: NA 50+: NA",)
    ]
    assert rows(ratings.movie_average(one_each, given).where("movie_id = 10"), ratings.movie_bar_line()) == [
        ("10 | Ten | Average Rating: 4.50 | Total Ratings: 2",)
    ]
    assert rows(ratings.year_average(given).where("year = 2000"), ratings.bar_line(F.col("year"))) == [
        ("2000 | Average Rating: 4.00 | Total Ratings: 1",)
    ]


def test_best_movie_report(rows, movies, given):
    some = ratings.best_movie_report(ratings.best_movie_known(movies.where("title <> 'Tva'"), given, 2), 2).orderBy("line_no")
    assert rows(some, "value", ordered=True)[1:] == [("MovieID: 1",), ("Title: One",), ("Average Rating: 4.50",), ("Total Ratings: 2",)]
    none = ratings.best_movie_report(ratings.best_movie_known(movies, given, 50), 50)
    assert rows(none, "value") == [("Khong co phim nao co it nhat 50 luot danh gia.",)]


def test_ratings_are_folded_before_they_are_shuffled(movies, given, users, occupations):
    for report in (ratings.movie_average(movies, given), ratings.genre_average(movies, given), ratings.occupation_average(given, users, occupations)):
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "partial_sum(rating" in plan or "partial_avg(rating" in plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
