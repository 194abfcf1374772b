"""Pages nested to any depth keep their structure."""

from __future__ import annotations

import time

import pytest

from tallyframe.llm import html_text


@pytest.mark.parametrize("depth", [10, 179, 400, 20_000])
def test_hidden_blocks_stay_hidden_below_any_depth(depth):
    inside = "<b hidden>no</b><div style='display:none'><div>no</div>no<p>no</div>yes"
    assert html_text.visible_text("<div>" * depth + inside + "</div>" * depth + "<p>after") == "yes\n\nafter"


@pytest.mark.parametrize("depth", [10, 179, 400, 5000])
def test_deep_markup_in_a_hidden_block(depth):
    page = "one<div hidden>" + "<div><span>" * depth + "no" + "</span></div>" * depth + "no</div><p>two"
    assert html_text.visible_text(page) == "one\n\ntwo"


def test_deep_tables_and_lists():
    assert html_text.visible_text("<table><tr><td>" * 300 + "x" + "</table>" * 300 + "y") == "x\n\ny"
    lines = html_text.visible_text("<ul><li>" * 300 + "x").split("\n")
    assert lines[-1].endswith("x") and lines[-1].count("-") == 300


def test_long_pages_of_open_tags_take_one_pass():
    for piece in ("<a ", "<a href='x", '<a b="', "</a ", "<a b= ", "<!", "<td rowspan='", "<script "):
        begun = time.perf_counter()
        html_text.visible_text("seen " + piece * (1_000_000 // len(piece)))
        assert time.perf_counter() - begun < 5, piece


def test_open_quotes_and_tags():
    show = html_text.visible_text
    assert show('<p title="odd>one</p><p>two') == "one\n\ntwo"
    assert show("<p>it's <b a=b'c>bold</b> 'here'") == "it's bold 'here'"
    assert show('<p>a<img alt="x > y">b') == "ab"
    assert show("one <a href=x two") == "one"
    assert show("1 < 2 and 3 > 2") == "1 < 2 and 3 > 2"


def test_row_spans_longer_than_a_thousand_rows():
    rows = "".join(f"<tr><td>r{k}" for k in range(1500))
    text = html_text.visible_text(f"<table><tr><td rowspan=1501>head<td>first{rows}</table>").split("\n")
    assert text[0] == "head  first" and all(line == f"      r{k}" for k, line in enumerate(text[1:]))


def test_repeated_rows_and_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "<p>a", "x", "y"), (1, "<p>a", "x", "y"), (2, None, None, None)], "page_id long, html string, text string, tag string")
    assert sorted(tuple(r) for r in html_text.extract_text(pages).collect()) == [(1, "a"), (1, "a"), (2, "")]
