"""Language identification: held-out accuracy on the given documents and brute force on small ones."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import language_id

FOLDER = "/root/testdata/sf0.01"
LAYOUT = "doc_id long, text string, lang string, source string, n_chars long, word string, n long"


def words(text):
    """Lower-case runs of letters."""
    return "".join(ch if ch.isalpha() else " " for ch in (text or "").lower()).split()


def grams(word):
    marked = f"\x02{word}\x03"
    return {n: [marked[at : at + n] for at in range(len(marked) - n + 1)] for n in range(1, 6)}


def brute(rows):
    learned = [(r[2], r[1]) for r in rows if r[0] is not None and r[1] is not None and r[2] is not None and zlib.crc32(str(r[0]).encode()) % 4 != 2]
    tables = defaultdict(Counter)  # (language, length or 0 for words)
    for lang, text in learned:
        for word in words(text):
            tables[lang, 0][word] += 1
            for n, found in grams(word).items():
                tables[lang, n].update(found)
    langs = sorted({lang for lang, n in tables if n == 0})
    weight = {key: sum(table.values()) + 0.5 * (len(table) + 1) for key, table in tables.items()}
    known = lambda n, name: any(name in tables[lang, n] for lang in langs)
    logs = lambda lang, n, name: math.log((tables[lang, n][name] + 0.5) / weight.get((lang, n), 0.5))
    for doc, text, *_ in rows:
        totals = dict.fromkeys(langs, 0.0)
        for word in words(text):
            if known(0, word):
                totals = {lang: total + logs(lang, 0, word) for lang, total in totals.items()}
                continue
            for n in range(5, 0, -1):
                found = [gram for gram in grams(word)[n] if known(n, gram)]
                if found:
                    totals = {lang: total + sum(logs(lang, n, gram) for gram in found) / len(found) for lang, total in totals.items()}
                    break
        if not words(text) or not langs:
            yield doc, doc is not None and zlib.crc32(str(doc).encode()) % 4 == 2, "und", 0.0
        else:
            best = max(langs, key=lambda lang: (totals[lang], [-ord(ch) for ch in lang]))
            yield doc, doc is not None and zlib.crc32(str(doc).encode()) % 4 == 2, best, 1 / sum(math.exp(t - totals[best]) for t in totals.values())


def awkward():
    rows = [(i, "the cat sat on the mat with a hat", "en", "s", 1, "w", 1) for i in range(12)]
    rows += [(i, "der Hund saß auf dem Tisch und fraß", "de", "s", 1, "w", 1) for i in range(12, 24)]
    rows += [(30, None, "en", None, None, None, None), (31, "", "en", None, None, None, None), (32, "123 ²³ _ ?!", "de", None, None, None, None)]
    rows += [(33, "THE HAT!", None, None, None, None, None), (34, "Hunde fraßen", None, None, None, None, None), (34, "Hunde fraßen", None, None, None, None, None)]
    rows += [(35, "мир", None, None, None, None, None), (None, "the mat", "en", None, None, None, None), (36, "cat\U0001f600hund", "en", None, None, None, None)]
    return rows + [(37, "hat tisch " * 50_000, "en", None, None, None, None), (38, "x" * 100_000, None, None, None, None, None)]


def test_awkward_documents_equal_brute_force(spark):
    rows = awkward()
    docs = spark.createDataFrame(rows, LAYOUT)
    found = sorted(map(tuple, language_id.identify(docs, language_id.train(docs)).collect()), key=repr)
    expected = sorted(brute(rows), key=repr)
    assert [r[:3] for r in found] == [r[:3] for r in expected]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in expected])


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None, "s", 1, "w", 1)], LAYOUT)
    assert language_id.identify(docs, language_id.train(docs)).collect()[0][2:] == ("und", 0.0)
    none = docs.limit(0)
    assert language_id.identify(none, language_id.train(none)).collect() == []


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = language_id.identify(docs, language_id.train(docs)).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right, rows = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert rows > 200 and right >= 0.98


def test_the_sample_is_bounded_and_fair(spark):
    rows = [(i, f"w{i}", "big" if i % 10 else "small", None, None, None, None) for i in range(4000)]
    taken = Counter(row["lang"] for row in language_id.training_rows(spark.createDataFrame(rows, LAYOUT), most=400).collect())
    assert 130 < taken["big"] < 270 and 130 < taken["small"] < 270


def test_pieces_of_a_long_text(monkeypatch):
    text = "ab cd, efg hij1k " * 40
    whole = language_id.word_counts(text)
    monkeypatch.setattr(language_id, "PIECE", 7)
    assert language_id.word_counts(text) == whole
