"""Whole jobs from input files to report files: ``python -m tallyframe.jobs <job> --help``.

Text files are parsed once, into typed tables in the shared folder; the reports then read only the
columns they need from there.
"""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyframe.plans import frames, ratings, reviews, sales
from tallyframe.session import build_session, stored
from tallyframe.sinks.files import overwrite_csv, save_result, write_delimited, write_lines
from tallyframe.sources import delimited, files
from tallyframe.streaming import detections, live
from tallyframe.streaming import frames as frame_stream

SALES_TABLES = ("Orders", "Customer_List", "Order_Items", "Order_Reviews", "Products")
SALES_TYPES = {"Order_Item_ID": "INT", "Price": "DECIMAL(12,2)", "Freight_Value": "DECIMAL(12,2)"}  # all other columns are text


def _parsed(spark: SparkSession, paths: str | Sequence[str], layout: delimited.Layout, mode: str) -> DataFrame:
    return stored(delimited.read_delimited_auto(spark, paths, layout, mode), "parsed")


def rating_reports(
    spark: SparkSession, movies: str, rated: Sequence[str], users: str, output: str, least: int = 5, mode: str = "drop"
) -> None:
    """Reports that keep unknown movies, with genders and age bands side by side."""
    movie_rows = _parsed(spark, movies, delimited.MOVIES, mode)
    rating_rows = _parsed(spark, rated, delimited.RATINGS, mode)
    user_rows = _parsed(spark, users, delimited.USERS, mode)
    movie_order = F.col("movie_id").cast("string")

    def by_text_id(report: DataFrame) -> DataFrame:
        return report.orderBy(movie_order)

    everything = by_text_id(ratings.movie_average_all(movie_rows, rating_rows))
    write_lines(everything, f"{output}/movies", ratings.movie_average_line())
    best = ratings.best_movie(movie_rows, rating_rows, least)
    write_lines(best, f"{output}/best_movie", ratings.best_movie_line(least))
    write_lines(ratings.genre_average(movie_rows, rating_rows), f"{output}/genres", ratings.genre_average_line())
    genders = by_text_id(ratings.gender_average_wide(movie_rows, rating_rows, user_rows))
    write_lines(genders, f"{output}/genders", ratings.gender_wide_line())
    ages = by_text_id(ratings.age_average_wide(movie_rows, rating_rows, user_rows))
    write_lines(ages, f"{output}/ages", ratings.age_wide_line())


def rating_tables(
    spark: SparkSession,
    movies: str,
    rated: Sequence[str],
    users: str,
    occupations: str,
    output: str,
    least: int = 50,
    mode: str = "fail",
) -> None:
    """Reports of known movies only, one row per movie and group, with occupations and years.

    With ``mode="fail"`` a report stops at a line that lacks a field which this report reads; a bad
    zip code stops none, a bad time stops the years only.
    """
    parse = "late" if mode == "fail" else mode
    movie_rows = _parsed(spark, movies, delimited.MOVIES, parse)
    rating_rows = _parsed(spark, rated, delimited.RATINGS, parse)
    user_rows = _parsed(spark, users, delimited.USERS, parse)
    occupation_rows = _parsed(spark, occupations, delimited.OCCUPATIONS, parse)

    def read(rows: DataFrame, *names: str) -> DataFrame:
        return delimited.demand(rows, *names) if mode == "fail" else rows.select(*names)

    titles, scores = read(movie_rows, "movie_id", "title"), read(rating_rows, "movie_id", "rating")
    given = read(rating_rows, "user_id", "movie_id", "rating")
    write_lines(ratings.movie_average(titles, scores), f"{output}/movies", ratings.movie_bar_line())
    best = ratings.best_movie_report(ratings.best_movie_known(titles, scores, least), least)
    write_lines(best.orderBy("line_no").coalesce(1), f"{output}/best_movie", F.col("value"))
    genres = ratings.genre_average(read(movie_rows, "movie_id", "genres"), scores, trimmed=False)
    write_lines(genres, f"{output}/genres", ratings.bar_line(F.col("genre")))
    genders = ratings.gender_average(titles, given, read(user_rows, "user_id", "gender"))
    write_lines(genders, f"{output}/genders", ratings.gender_bar_line())
    ages = ratings.age_code_average(titles, given, read(user_rows, "user_id", "age"))
    write_lines(ages, f"{output}/ages", ratings.age_bar_line())
    worked, names = read(user_rows, "user_id", "occupation"), read(occupation_rows, "occupation", "occupation_name")
    named = ratings.occupation_average(read(rating_rows, "user_id", "rating"), worked, names)
    write_lines(named, f"{output}/occupations", ratings.bar_line(F.col("occupation_name")))
    write_lines(ratings.year_average(read(rating_rows, "rating", "ts")), f"{output}/years", ratings.bar_line(F.col("year")))


def review_reports(spark: SparkSession, reviewed: str, stopwords: str, output: str, more_than: int = 500, k: int = 5) -> None:
    rows = stored(files.read_semicolon_typed(spark, reviewed), "reviews")
    stop = files.read_word_list(spark, stopwords)
    write_delimited(reviews.review_words(rows, stop), f"{output}/words", sep=";")
    write_delimited(reviews.frequent_words(rows, stop, more_than), f"{output}/frequent_words")
    for column in ("category", "aspect"):
        write_delimited(reviews.rows_per(rows, column), f"{output}/{column}_count")
    for kind in ("negative", "positive"):
        counts = reviews.rows_per(rows, "aspect", kind, f"total_{kind}")
        write_delimited(counts, f"{output}/{kind}_count")
        write_delimited(reviews.most_of(counts, "aspect", f"total_{kind}"), f"{output}/most_{kind}")
        write_delimited(reviews.top_words(rows, stop, k, kind), f"{output}/top_{kind}_words")
    write_delimited(reviews.top_words(rows, stop, k), f"{output}/top_words")


def read_shop(spark: SparkSession, folder: str, schemas: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The five exported tables, cleaned and stored, so that filters on parsed times reach their scan."""
    given, clean = schemas or {}, {"Orders": sales.clean_orders, "Order_Items": sales.clean_items}
    read = {name: files.read_quoted_csv(spark, f"{folder}/{name}.csv", given.get(name, SALES_TYPES)) for name in SALES_TABLES}
    return {name: stored(clean[name](table) if name in clean else table, name) for name, table in read.items()}


def sales_reports(
    spark: SparkSession,
    folder: str,
    output: str,
    year: int = 2024,
    relative_error: float = 0.01,
    schemas: dict[str, str] | None = None,
) -> None:
    shop = read_shop(spark, folder, schemas)
    orders, items = shop["Orders"], shop["Order_Items"]
    customers, scores, products = shop["Customer_List"], shop["Order_Reviews"], shop["Products"]
    reports = {
        "overview": sales.overview(orders, customers, items),
        "orders_by_country": sales.orders_by_country(orders, customers),
        "orders_by_month": sales.orders_by_month(orders),
        "average_score": sales.average_score(scores),
        "score_distribution": sales.score_distribution(scores),
        f"revenue_{year}_by_category": sales.revenue_by_category(items, orders, products, year),
        "product_sales": sales.product_sales(items, products, scores),
        "best_selling_product": sales.best_selling_product(items, products, scores),
        "delivery_detail": sales.delivery_detail(orders, items),
        "delivery_summary": sales.delivery_summary(orders, items),
        "customer_segments": sales.customer_segments(orders, items, relative_error=relative_error),
        "segment_summary": sales.segment_summary(orders, items, relative_error=relative_error),
        "seller_ranking": sales.seller_ranking(items),
    }
    for name, report in reports.items():
        save_result(report, f"{output}/{name}", name.replace("_", " "))


def frame_reports(spark: SparkSession, table: str, output: str, form: str = "parquet") -> None:
    """Reports over the stored detections, or over JSON lines of them."""
    if form == "parquet":
        rows = files.read_detections(spark, table)
    else:
        rows = stored(files.read_json_lines(spark, table).select(*files.LOG_FIELDS), "frames")
    overwrite_csv(frames.summary(rows), f"{output}/summary_stats")
    overwrite_csv(frames.peak_frames(rows), f"{output}/peak_frames")
    overwrite_csv(frames.rolling_average(rows), f"{output}/rolling_averages")
    overwrite_csv(frames.detection_log(rows), f"{output}/detection_log")
    overwrite_csv(frames.distribution(rows), f"{output}/distribution")
    write_lines(frames.report_text(rows).select("value").coalesce(1), f"{output}/summary_report")


def storage_job(
    spark: SparkSession, messages: str, table: str, checkpoint: str, once: bool = False, rejects: str | None = None
) -> StreamingQuery:
    """JSON messages in a folder into the table of detections, and those that are no records into ``rejects``."""
    trigger = {"availableNow": True} if once else None
    return detections.store_detections(detections.message_files(spark, messages), table, checkpoint, trigger, rejects)


def detector_job(
    spark: SparkSession,
    messages: str,
    output: str,
    checkpoint: str,
    load_detector: frame_stream.LoadDetector,
    once: bool = False,
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Frame messages in a folder into JSON messages, by a detector of the caller."""
    found = frame_stream.detection_messages(frame_stream.frame_files(spark, messages), load_detector, repeats_within)
    return detections.append_stream(found, output, checkpoint, {"availableNow": True} if once else None, "text")


def trend_job(spark: SparkSession, messages: str, table: str, trend: str, checkpoint: str, once: bool = False, k: int = 50) -> StreamingQuery:
    """JSON messages in a folder into a table, and the newest ``k`` of all into a trend that is replaced."""
    records = detections.parse_messages(detections.message_files(spark, messages))
    return live.trend_stream(records, table, trend, checkpoint, {"availableNow": True} if once else None, k)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallyframe.jobs")
    parser.add_argument("--master", help="Spark master, where spark-submit does not name one")
    jobs = parser.add_subparsers(dest="job", required=True)
    needs = {
        "rating-reports": ["movies", "ratings", "users", "output"],
        "rating-tables": ["movies", "ratings", "users", "occupations", "output"],
        "review-reports": ["reviews", "stopwords", "output"],
        "sales-reports": ["folder", "output"],
        "frame-reports": ["table", "output"],
        "store": ["messages", "table", "checkpoint"],
        "detect": ["messages", "output", "checkpoint", "detector"],
        "trend": ["messages", "table", "trend", "checkpoint"],
    }
    extras = {
        "rating-reports": {"least": int, "mode": str},
        "rating-tables": {"least": int, "mode": str},
        "review-reports": {"more-than": int, "k": int},
        "sales-reports": {"year": int, "relative-error": float},
        "frame-reports": {"form": str},
        "store": {"rejects": str, "once": bool},
        "detect": {"repeats-within": str, "once": bool},
        "trend": {"k": int, "once": bool},
    }  # options that may be left out: the functions' own defaults hold then
    for job, names in needs.items():
        options = jobs.add_parser(job)
        for name in names:
            options.add_argument(f"--{name}", required=True, nargs="+" if name == "ratings" else None)
        for name, kind in extras[job].items():
            how = {"action": "store_true"} if kind is bool else {"type": kind}
            options.add_argument(f"--{name}", default=argparse.SUPPRESS, **how)
    given = parser.parse_args(arguments)
    more = {name: value for name in (key.replace("-", "_") for key in extras[given.job]) if (value := getattr(given, name, None)) is not None}
    spark = build_session(f"tallyframe {given.job}", given.master)
    if given.job == "rating-reports":
        rating_reports(spark, given.movies, given.ratings, given.users, given.output, **more)
    elif given.job == "rating-tables":
        rating_tables(spark, given.movies, given.ratings, given.users, given.occupations, given.output, **more)
    elif given.job == "review-reports":
        review_reports(spark, given.reviews, given.stopwords, given.output, **more)
    elif given.job == "sales-reports":
        sales_reports(spark, given.folder, given.output, **more)
    elif given.job == "frame-reports":
        frame_reports(spark, given.table, given.output, **more)
    elif given.job == "store":
        storage_job(spark, given.messages, given.table, given.checkpoint, **more).awaitTermination()
    elif given.job == "trend":
        trend_job(spark, given.messages, given.table, given.trend, given.checkpoint, **more).awaitTermination()
    else:
        module, loader = given.detector.split(":")
        load_detector = getattr(importlib.import_module(module), loader)
        detector_job(spark, given.messages, given.output, given.checkpoint, load_detector, **more).awaitTermination()


if __name__ == "__main__":
    main()
