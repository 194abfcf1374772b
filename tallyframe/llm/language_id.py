"""Language of texts: known words by their frequency per language, other words by ever shorter character n-grams."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.session import stored

UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
LONGEST = 5  # characters of the longest n-gram; a word has a mark at both ends
MOST_DOCUMENTS = 6_000  # documents learned from, about as many of each language
MOST_WORDS, MOST_GRAMS = 200_000, 150_000  # entries of the model, per language a fair share
SMOOTHING = 0.5
PIECE = 1 << 20  # characters of a text that are split into words at once
KEPT_WORDS, KEPT_LENGTH = 200_000, 48  # of unseen words whose scores a task remembers

_WORDS = re.compile(r"[^\W\d_]+")
_BORDER = re.compile(r"[\W\d_]")


def word_counts(text: str) -> Counter:
    """How often each lower-case run of letters occurs, in pieces so that a long text makes no long list."""
    counts, at = Counter(), 0
    while at < len(text):
        end = len(text) if at + PIECE >= len(text) else at + PIECE
        border = _BORDER.search(text, end) if end < len(text) else None
        end = border.start() if border else len(text)
        counts.update(_WORDS.findall(text[at:end].lower()))
        at = end + 1
    return counts


def has_letter(counts: Counter) -> bool:
    return any(any(map(str.isalpha, word)) for word in counts)


def remainder(folds: int = FOLDS) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))


@dataclass
class Model:
    """Log frequencies per language: ``words`` and, by length, ``grams`` name rows of ``values``; ``floors`` hold
    those of words and grams (by length) that a language does not have."""

    languages: list[str]
    words: dict[str, int]
    grams: list[dict[str, int]]
    values: np.ndarray

    def unseen(self, word: str) -> np.ndarray | None:
        """Mean over the known n-grams of the greatest length at which any is known; None if there are none."""
        marked = f"\x02{word}\x03"
        for length in range(min(LONGEST, len(marked)), 0, -1):
            known = self.grams[length]
            rows = [row for at in range(len(marked) - length + 1) if (row := known.get(marked[at : at + length])) is not None]
            if rows:
                return self.values[rows].mean(axis=0)
        return None


class Scorer:
    """Scores of texts by one model; remembers the scores of unseen words."""

    def __init__(self, model: Model):
        self.model, self.kept = model, {}

    def unseen(self, word: str) -> np.ndarray | None:
        if len(word) > KEPT_LENGTH:
            return self.model.unseen(word)
        try:
            return self.kept[word]
        except KeyError:
            if len(self.kept) >= KEPT_WORDS:
                self.kept.clear()
            found = self.kept[word] = self.model.unseen(word)
            return found

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, probability by a flat prior); UNKNOWN and 0 for a text without letters or an empty model."""
        model = self.model
        if not text or not model.languages:
            return UNKNOWN, 0.0
        counts = word_counts(text)
        known = model.words
        rows, times, total = [], [], np.zeros(len(model.languages))
        for word, n in counts.items():
            row = known.get(word)
            if row is not None:
                rows.append(row)
                times.append(n)
            elif (found := self.unseen(word)) is not None:
                total += n * found
        if rows:
            total += np.array(times, float) @ model.values[rows]
        elif not has_letter(counts):
            return UNKNOWN, 0.0
        best = int(total.argmax())  # of equal ones the first in the order of the codes
        return model.languages[best], float(1 / np.exp(total - total[best]).sum())


def _counted(texts: DataFrame) -> DataFrame:
    """(lang, word, n) over the texts (lang, text), summed within a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = word_counts(text)
                words = [word for word in counts if any(map(str.isalpha, word))]
                arrays = [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string()), pa.array([counts[word] for word in words], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["lang", "word", "n"])

    return texts.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _most(counts: DataFrame, name: str, most: int, *groups: str) -> DataFrame:
    ranked = Window.partitionBy("lang", *groups).orderBy(F.desc("n"), name)
    return counts.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= most).drop("_rank")


def training_rows(docs: DataFrame, most: int = MOST_DOCUMENTS) -> DataFrame:
    """(lang, text): labelled documents that are not held out, about ``most`` in all, chosen by a hash of the id
    so that each language has its fair share."""
    usable = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    usable = usable.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder() != HELD_OUT))
    sizes = {row["lang"]: row["n"] for row in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_WORDS).collect()}
    share = max(1, most // max(len(sizes), 1))
    rates = {lang: min(1.0, share / n) for lang, n in sizes.items()}
    thin = [lang for lang, rate in rates.items() if rate < 1.0]
    if not thin:
        return usable.select("lang", "text")
    rate = F.coalesce(F.create_map(*[F.lit(part) for lang in thin for part in (lang, rates[lang])])[F.col("lang")], F.lit(1.0))
    drawn = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 20)) < rate * (1 << 20)
    return usable.where(drawn).select("lang", "text")


def train(docs: DataFrame, most_documents: int = MOST_DOCUMENTS, most_words: int = MOST_WORDS, most_grams: int = MOST_GRAMS) -> Model:
    """Fit on a bounded sample of ``docs``; the most frequent words and n-grams of each language make up the model.

    Words and n-grams are counted by Spark over the whole texts of the sample; what comes to the driver has at most
    ``most_words`` + ``most_grams`` rows and one total per language and length.
    """
    words = stored(_counted(training_rows(docs, most_documents)), "words")
    totals = {row["lang"]: (row["n"], row["kinds"]) for row in words.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()}
    languages = sorted(totals)
    if not languages:
        return Model([], {}, [{} for _ in range(LONGEST + 1)], np.zeros((0, 0)))
    marked = F.concat(F.lit("\x02"), F.col("word"), F.lit("\x03"))
    lengths = F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("word") + 2))).alias("length")
    spread = words.select("lang", "n", marked.alias("marked"), lengths)
    starts = F.sequence(F.lit(1), F.length("marked") - F.col("length") + 1)
    grams = spread.select("lang", "n", "length", F.explode(F.transform(starts, lambda at: F.substring(F.col("marked"), at, F.col("length")))).alias("gram"))
    grams = stored(grams.groupBy("lang", "length", "gram").agg(F.sum("n").alias("n")), "grams")
    sizes = {(row["lang"], row["length"]): (row["n"], row["kinds"]) for row in grams.groupBy("lang", "length").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()}
    column = {lang: at for at, lang in enumerate(languages)}
    names: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    entries: list[tuple[int, int, int, int]] = []
    best = _most(words, "word", max(1, most_words // len(languages))).select("lang", F.lit(0).alias("length"), F.col("word").alias("name"), "n")
    best = best.union(_most(grams, "gram", max(1, most_grams // (LONGEST * len(languages))), "length").select("lang", "length", F.col("gram").alias("name"), "n"))
    known: list[int] = []  # length by row of the values
    for lang, length, name, n in sorted(zip(*(part.to_pylist() for part in best.toArrow().columns))):
        place = names[length]
        if name not in place:
            place[name] = len(known)
            known.append(length)
        entries.append((place[name], column[lang], n, length))
    floors = np.zeros((LONGEST + 1, len(languages)))
    weights = np.zeros((LONGEST + 1, len(languages)))
    for length in range(LONGEST + 1):
        for lang, at in column.items():
            n, kinds = totals[lang] if length == 0 else sizes.get((lang, length), (0, 0))
            weights[length, at] = n + SMOOTHING * (kinds + 1)
            floors[length, at] = math.log(SMOOTHING / weights[length, at])
    values = floors[np.array(known, int)].astype(float)
    for row, at, n, length in entries:
        values[row, at] = math.log((n + SMOOTHING) / weights[length, at])
    return Model(languages, names[0], names, values)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    A text that is null or has no letter is UNKNOWN with score 0, and so is every text if there was nothing to learn
    from. A null doc_id is neither held out nor learned from. Repeated rows are rows of their own; whole texts
    are read, and columns other than doc_id and text are no input. An empty table gives no rows.
    """
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shipped.value)
        for batch in batches:
            found = [scorer.predict(text) for text in batch.column(2).to_pylist()]
            langs, scores = pa.array([lang for lang, _ in found], pa.string()), pa.array([score for _, score in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), langs, scores], ["doc_id", "held_out", "lang_pred", "score"])

    held_out = F.coalesce(remainder() == HELD_OUT, F.lit(False)).alias("held_out")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out, F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
