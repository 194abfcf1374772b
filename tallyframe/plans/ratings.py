"""Movie ratings: averages by movie, genre, gender, age, occupation and year.

Tables: movies(movie_id, title, genres), ratings(user_id, movie_id, rating, ts),
users(user_id, gender, age, occupation), occupations(occupation, occupation_name). Ratings are
folded per key before titles are joined, so the fact table is shuffled as partial sums only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.labels import AGE_BANDS, LAST_AGE_BAND, age_band, age_code_label
from tallyframe.functions.labels import text_or_missing, title_or_unknown, zero_if_missing
from tallyframe.functions.text import fixed2_half_even, fixed2_half_up, list_items
from tallyframe.functions.times import epoch_year
from tallyframe.operators.aggregates import average_by, average_of_sums, average_wide, best_row, sums_by
from tallyframe.operators.joins import look_up, one_row_per_key
from tallyframe.operators.rows import top_rows

GENDERS = {"M": "male_avg", "F": "female_avg"}
BAND_COLUMNS = {"0-18": "age_0_18", "18-35": "age_18_35", "35-50": "age_35_50", "50+": "age_50_plus"}
NO_BEST_MOVIE = "Khong co phim nao co it nhat {least} luot danh gia."  # fixed value: message text


def _titles(movies: DataFrame) -> DataFrame:
    return one_row_per_key(movies, "movie_id", "title")


def _with_title(per_movie: DataFrame, movies: DataFrame) -> DataFrame:
    """Every rated movie, with a stand-in title where the movie table lacks it."""
    titled = look_up(per_movie, _titles(movies), "movie_id", ["title"], keep_unmatched=True)
    return titled.withColumn("title", title_or_unknown(F.col("title")))


def movie_average_all(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """Mean and count of every rated movie, also of those missing in the movie table."""
    per_movie = average_by(ratings, ["movie_id"], "rating").where("n > 0")
    return _with_title(per_movie, movies).select("movie_id", "title", "avg", "n")


def best_movie(movies: DataFrame, ratings: DataFrame, least: int = 5) -> DataFrame:
    """The best mean among movies with enough ratings; the first id in text order wins a tie."""
    rated = average_by(ratings, ["movie_id"], "rating").where((F.col("n") >= least) & (F.col("avg") > 0))
    top = top_rows(rated, 1, F.desc("avg"), F.col("movie_id").cast("string"))
    winner = movies.where(F.col("movie_id") == top.select("movie_id").scalar()).agg(F.max("title").alias("title"))
    return top.select(title_or_unknown(winner.scalar()).alias("title"), "avg")


def genre_average(movies: DataFrame, ratings: DataFrame, trimmed: bool = True) -> DataFrame:
    """Mean over all ratings of all movies of a genre; ratings are summed per movie first."""
    per_movie = sums_by(ratings, ["movie_id"], "rating")
    listed = movies.where("genres is not null")
    genres = listed.select("movie_id", F.explode(list_items(F.col("genres"), trimmed)).alias("genre"))
    return average_of_sums(per_movie.join(genres, "movie_id"), ["genre"]).orderBy("genre")


def _rated_by(ratings: DataFrame, users: DataFrame, attribute: Column, name: str) -> DataFrame:
    """Ratings with one attribute of the user; ratings of unknown users go."""
    known = users.select("user_id", attribute.alias(name))
    return look_up(ratings.select("user_id", "movie_id", "rating"), known, "user_id", [name])


def gender_average_wide(movies: DataFrame, ratings: DataFrame, users: DataFrame) -> DataFrame:
    """Mean by men and by women side by side, 0 where one of them gave none."""
    rated = _rated_by(ratings, users, F.upper("gender"), "gender")
    wide = average_wide(rated, ["movie_id"], "gender", "rating", GENDERS)
    filled = [zero_if_missing(F.col(name)).alias(name) for name in GENDERS.values()]
    return _with_title(wide, movies).select("movie_id", "title", *filled)


def age_average_wide(movies: DataFrame, ratings: DataFrame, users: DataFrame) -> DataFrame:
    """Mean per age band side by side; users without an age are unknown."""
    rated = _rated_by(ratings, users.where("age is not null"), age_band(F.col("age")), "band")
    wide = average_wide(rated, ["movie_id"], "band", "rating", BAND_COLUMNS)
    return _with_title(wide, movies).select("movie_id", "title", *BAND_COLUMNS.values())


def movie_average(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """Mean and count of the movies of the movie table that have ratings."""
    per_movie = average_by(ratings, ["movie_id"], "rating")
    known = per_movie.join(movies.select("movie_id", "title"), "movie_id")
    return known.select("movie_id", "title", "avg", "n").orderBy("movie_id")


def best_movie_known(movies: DataFrame, ratings: DataFrame, least: int = 50) -> DataFrame:
    """The best mean among known movies with enough ratings; the smaller id wins a tie."""
    per_movie = average_by(ratings, ["movie_id"], "rating").where(F.col("n") >= least)
    known = per_movie.join(movies.select("movie_id", "title"), "movie_id")
    return best_row(known, ["movie_id", "title", "avg", "n"], F.col("avg"), -F.col("movie_id"))


def _long_average(movies: DataFrame, rated: DataFrame, group: str) -> DataFrame:
    means = average_by(rated, ["movie_id", group], "rating").join(movies.select("movie_id", "title"), "movie_id")
    return means.select("movie_id", "title", group, "avg", "n").orderBy("movie_id", group)


def gender_average(movies: DataFrame, ratings: DataFrame, users: DataFrame) -> DataFrame:
    return _long_average(movies, _rated_by(ratings, users, F.col("gender"), "gender"), "gender")


def age_code_average(movies: DataFrame, ratings: DataFrame, users: DataFrame) -> DataFrame:
    return _long_average(movies, _rated_by(ratings, users, age_code_label(F.col("age")), "age_group"), "age_group")


def occupation_average(ratings: DataFrame, users: DataFrame, occupations: DataFrame) -> DataFrame:
    """Mean by occupation name. Ratings are summed per user first, so the user tables join one row
    per user, and a user with very many ratings is no hot key."""
    per_user = sums_by(ratings, ["user_id"], "rating")
    named = users.select("user_id", "occupation").join(occupations, "occupation").select("user_id", "occupation_name")
    known = look_up(per_user, named, "user_id", ["occupation_name"])
    return average_of_sums(known, ["occupation_name"]).orderBy("occupation_name")


def year_average(ratings: DataFrame) -> DataFrame:
    years = ratings.select(epoch_year(F.col("ts")).alias("year"), "rating")
    return average_by(years, ["year"], "rating").orderBy("year")


# Text reports. The line templates of the two report families.


def movie_average_line() -> Column:
    return F.format_string("%s AverageRating: %s (TotalRatings: %d)", "title", fixed2_half_up(F.col("avg")), "n")


def best_movie_line(least: int = 5) -> Column:
    text = f"%s is the highest rated movie with an average rating of %s among movies with at least {least} ratings."
    return F.format_string(text, "title", fixed2_half_up(F.col("avg")))


def genre_average_line() -> Column:
    return F.format_string("%s Avg:%s, Count: %d", "genre", fixed2_half_up(F.col("avg")), "n")


def gender_wide_line() -> Column:
    male, female = (fixed2_half_up(F.col(name)) for name in GENDERS.values())
    return F.format_string("%s Male: %s, Female: %s", "title", male, female)


def age_wide_line() -> Column:
    def shown(mean: Column) -> Column:
        return text_or_missing(F.when(mean.isNotNull(), fixed2_half_up(mean)))

    labels = [*AGE_BANDS, LAST_AGE_BAND]
    template = "%s " + " ".join(f"{label}: %s" for label in labels)
    return F.format_string(template, "title", *[shown(F.col(BAND_COLUMNS[label])) for label in labels])


def bar_line(*leading: Column) -> Column:
    """Leading fields, mean and count parted by bars."""
    mean = F.concat(F.lit("Average Rating: "), fixed2_half_even(F.col("avg")))
    return F.concat_ws(" | ", *leading, mean, F.concat(F.lit("Total Ratings: "), F.col("n")))


def movie_bar_line() -> Column:
    return bar_line(F.col("movie_id"), F.col("title"))


def gender_bar_line() -> Column:
    return bar_line(F.col("movie_id"), F.col("title"), F.concat(F.lit("Gender: "), F.col("gender")))


def age_bar_line() -> Column:
    return bar_line(F.col("movie_id"), F.col("title"), F.concat(F.lit("Age Group: "), F.col("age_group")))


def best_movie_report(best: DataFrame, least: int = 50) -> DataFrame:
    """The best movie over several lines, or one line that there is none."""
    found = F.array(
        F.lit(f"PHIM CO DIEM TRUNG BINH CAO NHAT, IT NHAT {least} LUOT DANH GIA"),
        F.concat(F.lit("MovieID: "), F.col("row.movie_id")),
        F.concat(F.lit("Title: "), F.col("row.title")),
        F.concat(F.lit("Average Rating: "), fixed2_half_even(F.col("row.avg"))),
        F.concat(F.lit("Total Ratings: "), F.col("row.n")),
    )
    none = F.array(F.lit(NO_BEST_MOVIE.format(least=least)))
    only = best.agg(F.first(F.struct("*")).alias("row"))
    return only.select(F.posexplode(F.when(F.col("row").isNull(), none).otherwise(found)).alias("line_no", "value"))
