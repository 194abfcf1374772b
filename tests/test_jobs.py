from __future__ import annotations

import json

import pytest

from tallyframe import jobs
from tallyframe.registry.flows import counting_detector
from tallyframe.streaming.frames import FRAME_SCHEMA


def text_of(folder):
    return [line for part in sorted(folder.glob("part-*")) for line in part.read_text(encoding="utf-8").splitlines()]


def rating_files(folder):
    (folder / "movies.txt").write_bytes(b"1, Toys (1995), A|B\r\n2, Mat, B\r\n10, Heat, C\r\n")
    (folder / "r1.txt").write_bytes(b"1, 1, 4.0, 1600000000\r\n2, 1, 4.5, 1600000000\r\n")
    (folder / "r2.txt").write_bytes(b"1, 2, 3.0, 1600000000\r\n2, 10, 5.0, 1600000000\r\n1, 7, 1.0, 1600000000\r\n")
    (folder / "users.txt").write_bytes(b"1, M, 25, 0, 1\r\n2, F, 50, 1, 2\r\n")
    (folder / "jobs.txt").write_bytes(b"0,clerk\r\n1,cook\r\n2,none\r\n")


def test_rating_reports(spark, tmp_path):
    rating_files(tmp_path)
    given = [str(tmp_path / name) for name in ("r1.txt", "r2.txt")]
    out = tmp_path / "out"
    jobs.rating_reports(spark, str(tmp_path / "movies.txt"), given, str(tmp_path / "users.txt"), str(out), least=2)
    assert text_of(out / "movies") == [
        "Toys (1995) AverageRating: 4.25 (TotalRatings: 2)", "Heat AverageRating: 5.00 (TotalRatings: 1)",
        "Mat AverageRating: 3.00 (TotalRatings: 1)", "Unknown Movie AverageRating: 1.00 (TotalRatings: 1)",
    ]
    assert text_of(out / "best_movie") == [
        "Toys (1995) is the highest rated movie with an average rating of 4.25 among movies with at least 2 ratings."
    ]
    assert text_of(out / "genres") == ["A Avg:4.25, Count: 2", "B Avg:3.83, Count: 3", "C Avg:5.00, Count: 1"]
    assert text_of(out / "genders")[0] == "Toys (1995) Male: 4.00, Female: 4.50"
    assert text_of(out / "ages")[0] == "Toys (1995) 0-18: NA 18-35: 4.00 35-50: 4.50 50+: NA"


def test_rating_tables(spark, tmp_path):
    rating_files(tmp_path)
    given = [str(tmp_path / name) for name in ("r1.txt", "r2.txt")]
    out = tmp_path / "out"
    places = [str(tmp_path / name) for name in ("users.txt", "jobs.txt")]
    jobs.rating_tables(spark, str(tmp_path / "movies.txt"), given, *places, str(out), least=1)
    assert text_of(out / "movies")[0] == "1 |  Toys (1995) | Average Rating: 4.25 | Total Ratings: 2"
    assert text_of(out / "best_movie")[1:3] == ["MovieID: 10", "Title:  Heat"]
    assert text_of(out / "genres") == [
        " A | Average Rating: 4.25 | Total Ratings: 2", " B | Average Rating: 3.00 | Total Ratings: 1",
        " C | Average Rating: 5.00 | Total Ratings: 1", "B | Average Rating: 4.25 | Total Ratings: 2",
    ]
    assert text_of(out / "ages")[0] == "1 |  Toys (1995) | Age Group: 25-34 | Average Rating: 4.00 | Total Ratings: 1"
    assert text_of(out / "occupations") == ["clerk | Average Rating: 2.67 | Total Ratings: 3", "cook | Average Rating: 4.75 | Total Ratings: 2"]
    assert text_of(out / "years") == ["2020 | Average Rating: 3.50 | Total Ratings: 5"]


def test_review_reports(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text("1;Giá tốt, giá rẻ;PRICES;HOTEL;positive\n2;và phòng xấu;ROOMS;ROOMS;negative\n", encoding="utf-8")
    (tmp_path / "stop.txt").write_text("và\nlà\n", encoding="utf-8")
    out = tmp_path / "out"
    jobs.review_reports(spark, str(tmp_path / "reviews.csv"), str(tmp_path / "stop.txt"), str(out), more_than=1)
    assert text_of(out / "frequent_words") == ["giá\t2"]
    assert sorted(text_of(out / "category_count")) == ["PRICES\t1", "ROOMS\t1"]
    assert text_of(out / "most_negative") == ["ROOMS\t1"]
    assert sorted(text_of(out / "words"))[0] == "1;giá;PRICES;HOTEL;positive"
    assert sorted(text_of(out / "top_negative_words")) == ["ROOMS\tnegative\tphòng\t1", "ROOMS\tnegative\txấu\t1"]


def test_sales_reports_from_text_with_inferred_types(spark, tmp_path):
    files = {
        "Orders": "Order_ID;Customer_Trx_ID;Order_Status;Order_Purchase_Timestamp;Order_Approved_At;Order_Delivered_Carrier_Date;"
        "Order_Delivered_Customer_Date;Order_Estimated_Delivery_Date\n"
        "o1;c1;done;2024-01-05 10:00;2024-01-05 11:00;2024-01-08 10:00;;2024-01-09 00:00\n"
        "o2;c2;done;2023-01-05 10:00;;;;2024-01-09 00:00\n",
        "Customer_List": "Customer_Trx_ID;Customer_Country;Customer_Country_Code\nc1;France;FR\nc2;Spain;ES\n",
        "Order_Items": "Order_ID;Order_Item_ID;Product_ID;Seller_ID;Shipping_Limit_Date;Price;Freight_Value\n"
        "o1;1;p1;s1;2024-01-07 10:00;10.5;1.5\no2;1;p1;s2;2024-01-07 10:00;3;1\n",
        "Order_Reviews": "Order_ID;Review_Score\no1;5\no2;\no2;7\no1;abc\n",
        "Products": 'Product_ID;Product_Category_Name\np1;"toys; games"\n',
    }
    for name, content in files.items():
        (tmp_path / f"{name}.csv").write_text(content)
    jobs.sales_reports(spark, str(tmp_path), str(tmp_path / "out"))

    def report(name):
        return [tuple(row) for row in spark.read.option("header", True).csv(str(tmp_path / "out" / name)).collect()]

    assert report("revenue_2024_by_category") == [("revenue 2024 by category", "toys; games", "12.0", "1")]
    assert report("orders_by_month") == [("orders by month", "2023", "1", "1"), ("orders by month", "2024", "1", "1")]
    assert report("average_score") == [("average score", "5.0")]
    assert report("delivery_summary") == [("delivery summary", "Late", "1", "1.0", "1.0", "1.0")]
    assert report("best_selling_product") == [("best selling product", "p1", "toys; games", "2", "5.0")]
    assert report("segment_summary")[0][:3] == ("segment summary", "One-time", "2")
    assert [row[1] for row in report("seller_ranking")] == ["s1", "s2"]


def test_the_year_reaches_the_scan_of_the_stored_orders(spark, tmp_path, capsys):
    (tmp_path / "Orders.csv").write_text(
        "Order_ID;Customer_Trx_ID;Order_Status;Order_Purchase_Timestamp;Order_Approved_At;Order_Delivered_Carrier_Date;"
        'Order_Delivered_Customer_Date;Order_Estimated_Delivery_Date\no1;"c\n1";done;2024-01-05 10:00;;;;\n'
    )
    (tmp_path / "Order_Items.csv").write_text(
        "Order_ID;Order_Item_ID;Product_ID;Seller_ID;Shipping_Limit_Date;Price;Freight_Value\no1;1;p1;s1;2024-01-07 10:00;10.5;1.5\n"
    )
    for name in ("Customer_List", "Order_Reviews", "Products"):
        (tmp_path / f"{name}.csv").write_text("Product_ID;Product_Category_Name\np1;toys\n")
    shop = jobs.read_shop(spark, str(tmp_path))
    assert dict(shop["Order_Items"].dtypes)["Price"] == "decimal(12,2)"
    jobs.sales.revenue_by_category(shop["Order_Items"], shop["Orders"], shop["Products"], 2024).explain("formatted")
    pushed = [line for line in capsys.readouterr().out.splitlines() if "PushedFilters" in line and "Order_Purchase_TS" in line]
    assert any("GreaterThanOrEqual(Order_Purchase_TS" in line and "LessThan(Order_Purchase_TS" in line for line in pushed)


def test_frame_jobs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    records = [{"frame_id": i, "timestamp": 100.0 + i, "person_count": i, "process_latency_seconds": 0.05, "total_latency_seconds": 0.1} for i in range(6)]
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, records)))
    jobs.storage_job(spark, str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "progress"), once=True).awaitTermination()
    jobs.frame_reports(spark, str(tmp_path / "table"), str(tmp_path / "out"))
    assert "6,15,2.5,5,50.0" in text_of(tmp_path / "out" / "summary_stats")
    assert text_of(tmp_path / "out" / "peak_frames")[-2:] == ["5,5,0.05", "4,4,0.05"]
    report = text_of(tmp_path / "out" / "summary_report")
    assert report[0] == report[-1] == "=" * 60 and report[6] == "  Tổng số frame xử lý   : 6"
    jobs.frame_reports(spark, str(tmp_path / "in"), str(tmp_path / "again"), form="json")
    assert text_of(tmp_path / "again" / "summary_stats") == text_of(tmp_path / "out" / "summary_stats")


def test_detector_job(spark, tmp_path):
    rows = [(b"3", [("frame_id", b"1"), ("timestamp", b"5.5")]), (b"none", [("frame_id", b"2")])]
    spark.createDataFrame(rows, FRAME_SCHEMA).write.parquet(str(tmp_path / "in"))
    places = [str(tmp_path / name) for name in ("in", "out", "progress")]
    jobs.detector_job(spark, *places, counting_detector(), once=True).awaitTermination()
    (message,) = text_of(tmp_path / "out")
    record = json.loads(message)
    assert (record["frame_id"], record["timestamp"], record["person_count"], len(record["detections"])) == (1, 5.5, 3, 3)


def test_command_line_names_every_job(capsys):
    with pytest.raises(SystemExit):
        jobs.main(["--help"])
    shown = capsys.readouterr().out
    assert all(job in shown for job in ("rating-reports", "rating-tables", "review-reports", "sales-reports", "frame-reports", "store", "detect"))
    with pytest.raises(SystemExit):
        jobs.main(["store", "--messages", "x"])


def test_strict_tables_stop_at_a_malformed_line_before_any_report(spark, tmp_path):
    rating_files(tmp_path)
    (tmp_path / "r2.txt").write_text("1, 2, many, 1600000000\n")
    places = [str(tmp_path / name) for name in ("users.txt", "jobs.txt")]
    with pytest.raises(Exception, match="malformed line"):
        jobs.rating_tables(spark, str(tmp_path / "movies.txt"), str(tmp_path / "r2.txt"), *places, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_strict_reports_stop_at_their_own_fields(spark, tmp_path):
    rating_files(tmp_path)
    (tmp_path / "r3.txt").write_text("1, 1, 4.0, soon\n")
    places = [str(tmp_path / name) for name in ("users.txt", "jobs.txt")]
    given = [str(tmp_path / name) for name in ("r1.txt", "r2.txt", "r3.txt")]
    with pytest.raises(Exception, match="malformed line"):
        jobs.rating_tables(spark, str(tmp_path / "movies.txt"), given, *places, str(tmp_path / "out"))
    assert text_of(tmp_path / "out" / "movies") and text_of(tmp_path / "out" / "occupations")
    assert not list((tmp_path / "out").glob("years/part-*"))


def test_options_of_the_command_line(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "build_session", lambda name, master: spark)
    (tmp_path / "in").mkdir()
    lines = [json.dumps({"frame_id": i, "timestamp": 100.0 + i, "person_count": i}) for i in range(6)]
    (tmp_path / "in" / "a.json").write_text("\n".join([*lines, "{broken"]))
    places = {name: str(tmp_path / name) for name in ("in", "table", "rejects", "progress", "trend", "trend_progress", "trend_table")}
    jobs.main(["store", "--messages", places["in"], "--table", places["table"], "--checkpoint", places["progress"], "--rejects", places["rejects"], "--once"])
    assert spark.read.parquet(places["table"]).count() == 6 and spark.read.parquet(places["rejects"]).first()["reason"] == "no JSON"
    given = ["--messages", places["in"], "--table", places["trend_table"], "--trend", places["trend"], "--checkpoint", places["trend_progress"]]
    jobs.main(["trend", *given, "--k", "2", "--once"])
    assert sorted(row["frame_id"] for row in jobs.live.read_trend(spark, places["trend"]).collect()) == [4, 5]
    (tmp_path / "reviews.csv").write_text("1;tốt tốt giá;PRICES;HOTEL;positive\n")
    (tmp_path / "stop.txt").write_text("giá\n")
    given = ["--reviews", str(tmp_path / "reviews.csv"), "--stopwords", str(tmp_path / "stop.txt"), "--output", str(tmp_path / "out")]
    jobs.main(["review-reports", *given, "--more-than", "1"])
    assert text_of(tmp_path / "out" / "frequent_words") == ["tốt\t2"]
