from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe.sinks import files as sinks
from tallyframe.sources import delimited, files, quoted

CONTROL = "".join(map(chr, range(0x21)))
RATING_LINES = [
    "UserID,MovieID,Rating,Timestamp",
    "1::10::4.5::100",
    " 2 , 20 , 3 , 200 \r",
    "",
    "   ",
    "3,30",
    "4,40,bad,5",
    "5,x,4.0,6",
    "6,60,5.0",
    "7,70,,,",
]


def lines(spark, texts):
    return spark.createDataFrame([(text,) for text in texts], "value STRING")


def test_lenient_ratings(spark, rows):
    found = rows(delimited.parse_lines(lines(spark, RATING_LINES), delimited.RATINGS))
    assert found == [(1, 10, 4.5, 100), (2, 20, 3.0, 200), (6, 60, 5.0, None)]


def test_strict_ratings(spark, rows):
    good = ["1::10::4.5::100", "2,20,3,200\r"]
    assert rows(delimited.parse_lines(lines(spark, good), delimited.RATINGS, "fail")) == [(1, 10, 4.5, 100), (2, 20, 3.0, 200)]


@pytest.mark.parametrize("bad", ["3,30", "4,40,bad,5", "", "UserID,MovieID,Rating,Timestamp", "5,x,4.0,6"])
def test_strict_reading_stops_at_a_malformed_line(spark, bad):
    parsed = delimited.parse_lines(lines(spark, ["1,10,4.5,100", bad]), delimited.RATINGS, "fail")
    with pytest.raises(Exception, match="malformed line"):
        parsed.collect()


def test_a_report_stops_only_at_fields_it_reads(spark, rows):
    texts = ["1,10,4.5,100", "2,20,3.0,soon", "x,30,2.0,7", "4,40,1.5"]
    late = delimited.parse_lines(lines(spark, texts), delimited.RATINGS, "late")
    assert rows(delimited.demand(late, "movie_id", "rating")) == [(10, 4.5), (20, 3.0), (30, 2.0), (40, 1.5)]
    titles = spark.createDataFrame([(10, "A")], "movie_id long, title string")
    for names in (["rating", "ts"], ["user_id", "movie_id"]):
        with pytest.raises(Exception, match="malformed line: 2.20|malformed line: x.30|malformed line: 4.40"):
            delimited.demand(late, *names).collect()
    with pytest.raises(Exception, match="malformed line: x.30"):  # also where a join would pass the row by
        delimited.demand(late, "movie_id", "user_id").join(titles, "movie_id").collect()


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError):
        delimited.parse_lines(lines(spark, []), delimited.RATINGS, "skip")


def test_movie_positions(spark, rows):
    texts = ["1, Toys (1995), A|B", "2,Good, The Bad,C|D", "3::Plain, with comma::E", "4,Only title", "5,", "MovieID,Title,Genres"]
    assert rows(delimited.parse_lines(lines(spark, texts), delimited.MOVIES)) == [
        (1, "Toys (1995)", "A|B"), (2, "Good", "C|D"), (3, "Plain, with comma", "E"), (4, "Only title", None),
    ]
    strict = delimited.parse_lines(lines(spark, texts[:3]), delimited.MOVIES, "fail")
    assert rows(strict, "movie_id", "genres") == [(1, " A|B"), (2, " The Bad"), (3, "E")]


def test_users_without_age_stay_until_the_age_is_needed(spark, rows):
    texts = ["1,F,25,10,48067", "2,M,old,1,2", "3,m", "4"]
    found = rows(delimited.parse_lines(lines(spark, texts), delimited.USERS), "user_id", "gender", "age")
    assert found == [(1, "F", 25), (2, "M", None), (3, "m", None)]


def expected_rating(line):
    """The rules of the lenient reader in plain Python, None for a line that goes."""
    if line.startswith("UserID") or not line.strip(CONTROL):
        return None
    fields = line.split("::" if "::" in line else ",")
    while fields and not fields[-1]:
        fields.pop()
    fields = [field.strip(CONTROL) for field in fields]
    if len(fields) < 3 or not fields[1].isdigit() or not re.fullmatch(r"\d+(\.\d+)?", fields[2]):
        return None
    number = [int(fields[place]) if len(fields) > place and fields[place].isdigit() else None for place in (0, 1, 3)]
    return number[0], number[1], float(fields[2]), number[2]


FIELD = st.sampled_from(["", " ", "1", "22", " 3 ", "4.5", "x", "UserID", "\t7", "5\r"])
LINE = st.builds(lambda separator, fields, tail: separator.join(fields) + tail, st.sampled_from([",", "::"]), st.lists(FIELD, max_size=6), st.sampled_from(["", ",", "::", "\r"]))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(LINE, min_size=5, max_size=60))
def test_lenient_reading_follows_its_rules(spark, texts):
    parsed = delimited.parse_lines(lines(spark, texts), delimited.RATINGS)
    expected = [row for row in map(expected_rating, texts) if row]
    assert sorted(map(tuple, parsed.collect()), key=repr) == sorted(expected, key=repr)


def test_several_files_and_folders(spark, rows, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"1,10,4.0,1\r\n2,10,3.0,1\r\n")
    (tmp_path / "b.txt").write_text("3::10::5.0::1\n")
    both = delimited.read_delimited_auto(spark, [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")], delimited.RATINGS)
    folder = delimited.read_delimited_auto(spark, str(tmp_path), delimited.RATINGS)
    assert rows(both) == rows(folder) == [(1, 10, 4.0, 1), (2, 10, 3.0, 1), (3, 10, 5.0, 1)]


def test_semicolon_file_without_quoting(spark, rows, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('1;"great" room;ROOMS;HOTEL;positive\nx;ok;ROOMS\n3;;PRICES;HOTEL;negative;extra\n', encoding="utf-8")
    assert rows(files.read_semicolon_typed(spark, str(path))) == [
        (1, '"great" room', "ROOMS", "HOTEL", "positive"), (3, None, "PRICES", "HOTEL", "negative"), (None, "ok", "ROOMS", None, None),
    ]


def test_word_list(spark, rows, tmp_path):
    path = tmp_path / "w.txt"
    path.write_bytes("là\r\ncủa\r\n\r\nlà\r\nbao giờ\r\n".encode())
    assert rows(files.read_word_list(spark, str(path))) == [("bao giờ",), ("của",), ("là",)]
    inline = spark.createDataFrame([("a\r",), ("\r",), (None,), ("a",)], "value STRING")
    assert rows(files.word_list(inline)) == [("a",)]


def test_quoted_csv_with_line_breaks(spark, rows, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('Order_ID;Note;Price\n1;"a;b\nc ""d""";2.50\n2;;3\n')
    assert rows(files.read_quoted_csv(spark, str(path))) == [(1, 'a;b\nc "d"', 2.5), (2, None, 3.0)]
    typed = files.read_quoted_csv(spark, str(path), "Order_ID STRING, Note STRING, Price DECIMAL(12,2)")
    assert dict(typed.dtypes)["Price"] == "decimal(12,2)" and typed.count() == 2
    named = files.read_quoted_csv(spark, str(path), {"Price": "DOUBLE", "Other": "INT"})
    assert rows(named) == [("1", 'a;b\nc "d"', 2.5), ("2", None, 3.0)]


LAYOUT = "id INT, text STRING, other STRING"


def awkward_fields(spark, count):
    """Fields with line breaks, quotes and separators of many lengths, so that borders of blocks fall everywhere."""
    text = (
        "CASE id % 6 WHEN 0 THEN repeat(concat('line ', id, '\\n'), id % 37) WHEN 1 THEN concat('say \"', id, '\"; \"\"') WHEN 2 THEN ''"
        " WHEN 3 THEN repeat('\\n', id % 50 + 1) WHEN 4 THEN NULL ELSE repeat('\"\\n;', id % 90) END"
    )
    return spark.range(count).selectExpr("CAST(id AS INT) AS id", f"{text} AS text", "concat('x', id) AS other")


@pytest.mark.parametrize(("block", "count"), [("40b", 60), ("1k", 400), ("128m", 400)])
def test_quoted_csv_is_split_inside_records(spark, rows, tmp_path, block, count):
    given = awkward_fields(spark, count)
    given.coalesce(1).write.options(header=True, sep=";", escape='"', quoteAll=False).csv(str(tmp_path / "one"))
    given.repartition(3).write.options(header=True, sep=";", escape='"', quoteAll=True).csv(str(tmp_path / "three"))
    for folder in ("one", "three"):
        path = str(tmp_path / folder)
        plain = spark.read.schema(LAYOUT).options(header=True, sep=";", escape='"', multiLine=True).csv(path)
        kept = {key: spark.conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        try:
            found = files.read_quoted_csv(spark, path, LAYOUT)
            assert rows(found) == rows(plain) and found.count() == count
            blocks = quoted.quoted_lines(spark, path).select("file", "block").distinct().count()
            assert blocks > (50 if block == "40b" else 0)
        finally:
            for key, value in kept.items():
                spark.conf.set(key, value)


def test_one_large_file_is_read_by_several_tasks(spark, tmp_path):
    awkward_fields(spark, 60_000).coalesce(1).write.options(header=True, sep=";", escape='"').csv(str(tmp_path / "big"))
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        found = files.read_quoted_csv(spark, str(tmp_path / "big"), LAYOUT)
        tasks = found.select(F.spark_partition_id().alias("task")).where("id IS NOT NULL").distinct().count()
        assert tasks > 4 and found.count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_quoted_csv_with_carriage_returns_and_an_open_end(spark, rows, tmp_path):
    (tmp_path / "crlf.csv").write_bytes(b'a;b\r\n1;"x\r\ny"\r\n\r\n2;z\r\n')
    assert rows(files.read_quoted_csv(spark, str(tmp_path / "crlf.csv"), "a INT, b STRING")) == [(1, "x\ny"), (2, "z")]
    (tmp_path / "open.csv").write_text('a;b\n1;x\n2;"never closed\n3;y\n')
    assert rows(files.read_quoted_csv(spark, str(tmp_path / "open.csv"), "a INT, b STRING"), "a") == [(1,), (2,)]
    (tmp_path / "none.csv").write_text("a;b\n")
    assert rows(files.read_quoted_csv(spark, str(tmp_path / "none.csv"), "a INT, b STRING")) == []


def test_json_lines_round_trip(spark, rows, tmp_path):
    boxes = "array(named_struct('box', array(1, 2, 3, 4), 'confidence', 0.5D))"
    df = spark.sql(f"SELECT 7 AS frame_id, 1.5D AS timestamp, 1 AS person_count, {boxes} AS detections, 0.25D AS process_latency_seconds, 0.5D AS total_latency_seconds")
    sinks.write_json(df, str(tmp_path / "j"))
    back = files.read_json_lines(spark, str(tmp_path / "j"))
    assert back.collect() == df.collect()
    assert files.read_json_lines(spark, str(tmp_path / "j"), None).select("frame_id").first()[0] == 7


def test_projected_scan_reads_only_the_named_columns(spark, tmp_path):
    spark.range(5).selectExpr("id AS frame_id", "1 AS person_count", "'x' AS unused").write.parquet(str(tmp_path / "d"))
    df = files.read_detections(spark, str(tmp_path / "d"), ["frame_id", "person_count"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<frame_id:bigint,person_count:int>" in plan


def test_plain_fields_keep_blanks_and_quotes(spark, tmp_path):
    df = spark.createDataFrame([(' a "b" ', 1)], "t STRING, n INT")
    sinks.write_delimited(df, str(tmp_path / "t"))
    assert spark.read.text(str(tmp_path / "t")).first()[0] == ' a "b" \t1'


def test_saved_report_has_a_title_and_is_replaced(spark, tmp_path):
    path = str(tmp_path / "r")
    for values in ([(1,), (2,)], [(3,)]):
        sinks.save_result(spark.createDataFrame(values, "v INT"), path, "Title", one_file=True)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == [sinks.TITLE_COLUMN, "v"] and [tuple(row) for row in back.collect()] == [("Title", "3")]
    assert len(list((tmp_path / "r").glob("part-*"))) == 1


def test_text_lines(spark, tmp_path):
    sinks.write_lines(spark.createDataFrame([("x", 2)], "a STRING, b INT"), str(tmp_path / "l"), F.format_string("%s=%d", "a", "b"))
    assert spark.read.text(str(tmp_path / "l")).first()[0] == "x=2"
