"""Toxicity of texts: a bidirectional gated recurrent network with attention pooling, trained in numpy."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = re.compile(r"\w+")
WINDOW, STRIDE = 48, 24
SIZE, HIDDEN = 12, 8
GRAMS = 4096  # rows of the table of character trigrams
MOST_DOCUMENTS, MOST_CHARACTERS = 3000, 50_000_000  # bounds of the sample that the network is fitted on, in whole documents
CLEAN_WINDOWS = 3  # of a clean document, learnt from per epoch
KNOWN_WORDS = 100_000  # kept between texts; a worker of Spark lives on and has them while other stages run
BATCH = 512


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def window_starts(count: int) -> range:
    """Overlapping windows that cover all words; none for no words."""
    return range(0, max(count - WINDOW + STRIDE, 1) if count else 0, STRIDE)


class _Rows(dict):
    """Row of the character table per trigram, remembered."""

    def __missing__(self, gram: str) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        row = self[gram] = zlib.crc32(gram.encode("utf-8", "replace")) % GRAMS
        return row


_ROWS = _Rows()


def trigrams(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the character table for all words, their borders marked, and where each word starts."""
    sizes = np.fromiter((len(word) for word in words), np.int64, len(words))
    marked = (f"^{word}$" for word in words)
    rows = [_ROWS[word[at : at + 3]] for word in marked for at in range(len(word) - 2)]
    return np.array(rows, np.int64), np.r_[0, sizes.cumsum()]


def _sum_rows(values: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Sums of ``values`` by row number, of which there are ``count``."""
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    out = np.zeros((count, *values.shape[1:]), values.dtype)
    out[ordered[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.minimum(-x, 60)))


def _segments(offsets: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the trigrams of the chosen words, whose they are, and how many each word has."""
    sizes = offsets[chosen + 1] - offsets[chosen]
    flat = np.repeat(offsets[chosen] - np.r_[0, sizes.cumsum()[:-1]], sizes) + np.arange(sizes.sum())
    return flat, np.repeat(np.arange(len(chosen)), sizes), sizes


@dataclass
class Network:
    """``vocabulary`` numbers the words with a vector of their own (from 1); ``p`` are the parameters;
    ``base`` is the log-odds of a text without words."""

    vocabulary: dict[str, int]
    p: dict[str, np.ndarray]
    base: float

    def inputs(self, words: Sequence[str]) -> np.ndarray:
        """Input vector per word: its own, if it has one, plus the mean of its character trigrams."""
        rows, offsets = trigrams(words)
        return self.combine(np.array([self.vocabulary.get(word, 0) for word in words]), rows, offsets)

    def combine(self, own: np.ndarray, rows: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        chars = np.add.reduceat(self.p["grams"][rows], offsets[:-1], axis=0)
        return self.p["words"][own] + chars / np.diff(offsets)[:, None].astype(np.float32)

    def project(self, x: np.ndarray) -> np.ndarray:
        """What both directions add to their gates for an input: (rows, 2, 3 * HIDDEN)."""
        flat = x @ self.p["in"].transpose(1, 0, 2).reshape(SIZE, -1)
        return flat.reshape(len(x), 2, 3 * HIDDEN) + self.p["bias"]

    def forward(self, gates: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logit per window. ``gates`` is (windows, words, 2, 3 * HIDDEN), ``mask`` (windows, words)."""
        count, width = mask.shape
        state = np.zeros((2, count, HIDDEN), np.float32)
        states = np.zeros((width, 2, count, HIDDEN), np.float32)
        steps, h2 = [], 2 * HIDDEN
        for at in range(width):
            back = width - 1 - at
            now = np.stack([gates[:, at, 0], gates[:, back, 1]])
            live = np.stack([mask[:, at], mask[:, back]])[:, :, None]
            before = state
            rec = np.matmul(before, self.p["rec"])
            both = _sigmoid(now[..., :h2] + rec[..., :h2])
            r, z = both[..., :HIDDEN], both[..., HIDDEN:]
            new = 2 * _sigmoid(2 * (now[..., h2:] + r * rec[..., h2:])) - 1
            state = (new + z * (before - new)) * live
            states[at, 0], states[back, 1] = state[0], state[1]
            if keep:
                steps.append((before, rec[..., h2:], r, z, new, live))
        hidden = np.concatenate([states[:, 0], states[:, 1]], axis=-1)  # (words, windows, 2 * HIDDEN)
        heat = np.where(mask.T, hidden @ self.p["attend"], -1e9)
        weight = np.exp(heat - heat.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[..., None] * hidden).sum(axis=0)
        logit = pooled @ self.p["out"] + self.p["out_bias"][0]
        return (logit, (steps, hidden, weight, pooled)) if keep else logit

    def backward(self, slope: np.ndarray, kept, mask: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the parameters after the inputs, and of the gates, for d loss / d logit."""
        steps, hidden, weight, pooled = kept
        width = mask.shape[1]
        grads = {"out": pooled.T @ slope, "out_bias": np.array([slope.sum()]), "rec": np.zeros_like(self.p["rec"])}
        d_pooled = slope[:, None] * self.p["out"]
        d_weight = (hidden * d_pooled).sum(axis=-1)
        d_heat = weight * (d_weight - (weight * d_weight).sum(axis=0))
        grads["attend"] = np.einsum("tbh,tb->h", hidden, d_heat)
        d_hidden = weight[..., None] * d_pooled + d_heat[..., None] * self.p["attend"]
        d_gates = np.zeros((mask.shape[0], width, 2, 3 * HIDDEN), np.float32)
        carry = np.zeros((2, mask.shape[0], HIDDEN), np.float32)
        for at in range(width - 1, -1, -1):
            back = width - 1 - at
            before, rec_new, r, z, new, live = steps[at]
            d = (carry + np.stack([d_hidden[at, :, :HIDDEN], d_hidden[back, :, HIDDEN:]])) * live
            d_new = d * (1 - z) * (1 - new**2)
            d_z = d * (before - new) * z * (1 - z)
            d_r = d_new * rec_new * r * (1 - r)
            d_now = np.concatenate([d_r, d_z, d_new], axis=-1)
            d_rec = np.concatenate([d_r, d_z, d_new * r], axis=-1)
            grads["rec"] += np.matmul(before.transpose(0, 2, 1), d_rec)
            carry = d * z + np.matmul(d_rec, self.p["rec"].transpose(0, 2, 1))
            d_gates[:, at, 0], d_gates[:, back, 1] = d_now[0], d_now[1]
        return grads, d_gates


def _start(vocabulary: dict[str, int], odds: np.ndarray, seed: int, base: float) -> Network:
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    p = {
        "words": draw(len(vocabulary) + 1, SIZE, scale=0.02),
        "grams": draw(GRAMS, SIZE, scale=0.05),
        "in": draw(2, SIZE, 3 * HIDDEN, scale=0.4),
        "rec": draw(2, HIDDEN, 3 * HIDDEN, scale=0.2),
        "bias": np.zeros((2, 3 * HIDDEN), np.float32),
        "attend": draw(2 * HIDDEN, scale=0.1),
        "out": draw(2 * HIDDEN, scale=0.3),
        "out_bias": np.array([base], np.float32),
    }
    p["words"][0] = 0
    p["words"][:, 0] += odds
    return Network(vocabulary, p, base)


def fit_network(texts: Sequence[Sequence[Sequence[str]]], toxic: Sequence[int], epochs: int = 8, seed: int = 7) -> Network:
    """Train on documents given as windows of words. The loss of a document is that of its most toxic
    window, of a clean one that of its CLEAN_WINDOWS most toxic ones; Adam, on batches of documents. Words that meet toxic documents much more or less often
    than chance start from their log-odds. A word of a clean window that toxic documents do not prefer is
    clean in any number, so some of them are shown repeated, too. Without documents of both kinds the
    score is the base rate."""
    rng = np.random.default_rng(seed)
    marks = np.array(toxic, np.float32)
    base = float(np.log((marks.sum() + 0.5) / (len(marks) - marks.sum() + 0.5)))
    met, met_toxic = Counter(), Counter()
    for windows, mark in zip(texts, marks):
        own = {word for window in windows for word in window}
        met.update(own)
        if mark:
            met_toxic.update(own)
    rate = marks.mean() if len(marks) else 0.0
    kept, odds = [], [0.0]
    for word in sorted(met):
        n, up = met[word], met_toxic[word]
        z = (up - n * rate) / np.sqrt(max(n * rate * (1 - rate), 1e-9))
        if n >= 3 and (abs(z) >= 3 or n >= 20):
            kept.append(word)
            share = (up + 0.5) / (marks.sum() + 1), (n - up + 0.5) / (len(marks) - marks.sum() + 1)
            odds.append(float(np.clip(np.log(share[0] / share[1]), -4, 4)) if abs(z) >= 3 else 0.0)
    net = _start({word: at + 1 for at, word in enumerate(kept)}, np.array(odds, np.float32), seed, base)
    usable = [at for at, windows in enumerate(texts) if windows]
    if not marks.any() or marks.all() or not usable:
        net.p["out"][:] = 0
        return net
    every = {word: at for at, word in enumerate(sorted(met))}
    flat_grams, offsets = trigrams(list(every))
    own_row = np.array([net.vocabulary.get(word, 0) for word in every])
    calm = np.array([met_toxic[word] <= met[word] * rate for word in every])
    owner = np.array([doc for doc in usable for _ in texts[doc]])
    length = np.array([len(window) for doc in usable for window in texts[doc]])
    table = np.full((len(owner), WINDOW), -1, np.int32)
    for at, window in enumerate(window for doc in usable for window in texts[doc]):
        table[at, : len(window)] = [every[word] for word in window]
    moment, spread, step = {}, {}, 0
    first = np.searchsorted(owner, usable)
    for _ in range(epochs):
        gates = net.project(net.combine(own_row, flat_grams, offsets)).astype(np.float32)
        logits = _score_windows(net, gates, table, length)
        shown = [1 if marks[owner[lo]] else CLEAN_WINDOWS for lo in first]
        spans = zip(first, np.r_[first[1:], len(owner)], shown)
        best = np.concatenate([lo + np.argsort(-logits[lo:hi], kind="stable")[:most] for lo, hi, most in spans])
        for some in np.array_split(rng.permutation(best), max(1, len(best) // 64)):
            step += 1
            clean = rng.permutation(some[marks[owner[some]] == 0])[: 1 + len(some) // 8]
            word = table[clean, rng.integers(length[clean])]
            word = word[calm[word]]
            again = np.where(np.arange(WINDOW) < rng.integers(1, WINDOW + 1, len(word))[:, None], word[:, None], -1)
            ids = np.concatenate([table[some], again])
            ids = ids[:, : (ids >= 0).sum(axis=1).max()]
            mask = ids >= 0
            wanted = np.concatenate([marks[owner[some]], np.zeros(len(word), np.float32)])
            chosen, inverse = np.unique(ids[mask], return_inverse=True)
            places, whose, sizes = _segments(offsets, chosen)
            rows = flat_grams[places]
            x = net.combine(own_row[chosen], rows, np.r_[0, sizes.cumsum()])
            per_word = net.project(x).astype(np.float32)
            gate = np.zeros((*ids.shape, 2, 3 * HIDDEN), np.float32)
            gate[mask] = per_word[inverse]
            logit, state = net.forward(gate, mask, keep=True)
            slope = ((_sigmoid(logit) - wanted) / len(ids)).astype(np.float32)
            grads, d_gate = net.backward(slope, state, mask)
            d_word = _sum_rows(d_gate[mask], inverse, len(chosen))
            grads["bias"] = d_word.sum(axis=0)
            grads["in"] = np.einsum("rd,rkh->kdh", x, d_word)
            d_x = np.einsum("rkh,kdh->rd", d_word, net.p["in"])
            grads["words"] = _sum_rows(d_x, own_row[chosen], len(net.p["words"]))
            grads["words"][0] = 0
            grads["grams"] = _sum_rows((d_x / sizes[:, None])[whose], rows, GRAMS)
            norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
            for name, grad in grads.items():
                grad = grad * min(1.0, 1.0 / max(norm, 1e-9))
                moment[name] = 0.9 * moment.get(name, 0) + 0.1 * grad
                spread[name] = 0.99 * spread.get(name, 0) + 0.01 * grad**2
                change = (moment[name] / (1 - 0.9**step)) / (np.sqrt(spread[name] / (1 - 0.99**step)) + 1e-6)
                pull = 1e-3 * net.p[name] if name in ("words", "grams") else 0.0
                net.p[name] = (net.p[name] - (0.01 if name != "grams" else 0.003) * (change * (np.abs(grad) > 0) + pull)).astype(np.float32)
            net.p["words"][0] = 0
    return net


def _score_windows(net: Network, gates: np.ndarray, table: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Logit per window of a table of word numbers, -1 behind its end; short windows go together."""
    logits = np.zeros(len(table), np.float32)
    order = np.argsort(length, kind="stable")
    for at in range(0, len(order), BATCH):
        some = order[at : at + BATCH]
        ids = table[some][:, : length[some].max()]
        logits[some] = net.forward(gates[ids], ids >= 0)
    return logits


class Scorer:
    """Scores texts; what words add to the gates is kept between texts."""

    def __init__(self, net: Network):
        self.net, self.known = net, {}
        self.gates = np.zeros((0, 2, 3 * HIDDEN), np.float32)

    def _learn(self, words: list[str]) -> None:
        new = [word for word in dict.fromkeys(words) if word not in self.known]
        if new and len(self.known) + len(new) > KNOWN_WORDS:
            self.known, self.gates = {}, self.gates[:0]
            new = list(dict.fromkeys(words))
        if new:
            start = len(self.known)
            self.known.update({word: start + at for at, word in enumerate(new)})
            parts = [self.net.project(self.net.inputs(new[at : at + 20_000])) for at in range(0, len(new), 20_000)]
            self.gates = np.concatenate([self.gates[:start], *parts]).astype(np.float32, copy=False)

    def _logits(self, texts: Sequence[list[str]]) -> list[float]:
        """Greatest logit over all windows per list of words."""
        self._learn([word for words in texts for word in words])
        best = np.full(len(texts), -np.inf)
        starts = [(doc, at) for doc, words in enumerate(texts) for at in window_starts(len(words))]
        ids = [np.fromiter((self.known[word] for word in words), np.int64, len(words)) for words in texts]
        for lo in range(0, len(starts), 16 * BATCH):
            some = starts[lo : lo + 16 * BATCH]
            table = np.full((len(some), WINDOW), -1)
            length = np.zeros(len(some), np.int64)
            for row, (doc, at) in enumerate(some):
                part = ids[doc][at : at + WINDOW]
                table[row, : len(part)], length[row] = part, len(part)
            np.maximum.at(best, [doc for doc, _ in some], _score_windows(self.net, self.gates, table, length))
        return np.where(np.isfinite(best), best, self.net.base).tolist()

    def score(self, texts: Iterable[str | None] | pa.Array) -> np.ndarray:
        """Probability per text, a slice of texts at a time; an Arrow array is never held as strings."""
        logits: list[float] = []
        part: list[list[str]] = []
        held = 0
        for text in texts:
            part.append(words_of(text.as_py() if isinstance(text, pa.Scalar) else text))
            held += len(part[-1])
            if held > 200_000:
                logits += self._logits(part)
                part, held = [], 0
        return _sigmoid(np.array(logits + (self._logits(part) if part else []), float))


_SCORERS: dict[bytes, Scorer] = {}


def _scorer(net: Network) -> Scorer:
    """The scorer of this Python process for a network, so that tasks share the words it has met."""
    key = b"".join(net.p[name].tobytes() for name in ("out", "attend", "rec"))
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(net)
    return _SCORERS[key]


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _training_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [" ".join(words_of(text)) for text in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(words, pa.string())], ["doc_id", "toxic", "words"])


def _windows(words: str, known: dict[str, str]) -> list[list[str]]:
    """All windows of words parted by blanks; equal words are one object, kept in ``known``."""
    shared = [known.setdefault(word, word) for word in words.split()]
    return [shared[at : at + WINDOW] for at in window_starts(len(shared))]


def train(docs: DataFrame, labels: DataFrame, most_documents: int = MOST_DOCUMENTS, most_characters: int = MOST_CHARACTERS) -> Network:
    """The network, fitted on at most ``most_documents`` labelled documents that are not held out, those of
    the smallest hash of their id, as far as their texts have ``most_characters`` together; all windows of each."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marked = marked.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sizes = own.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("size"))
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    first = marked.join(sizes, "doc_id").orderBy(*by_hash).limit(most_documents)
    upto = first.withColumn("upto", F.sum("size").over(Window.orderBy(*by_hash)))  # over most_documents rows
    chosen = upto.where(F.col("upto") <= most_characters).select("doc_id", "toxic")
    one = own.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")
    rows = one.mapInArrow(_training_words, "doc_id long, toxic int, words string").collect()
    rows.sort(key=lambda row: (row["doc_id"], row["words"]))
    known: dict[str, str] = {}
    return fit_network([_windows(row["words"], known) for row in rows], [int(row["toxic"] == 1) for row in rows])


def score_documents(docs: DataFrame, net: Network) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per row of ``docs``.

    All words of a text are scored, in overlapping windows; the most toxic window counts. Null and
    empty texts and those without words get the base rate. Only the text is an input. Repeated rows
    get equal scores, a null doc_id stays null and is not held out, an empty table gives no rows;
    other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(net)
        for batch in batches:
            scores = scorer.score(batch.column(2))
            columns = [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])
        batch = columns = None
        pa.default_memory_pool().release_unused()  # the worker lives on

    doc = F.col("doc_id").cast("long")
    narrow = docs.select(doc.alias("doc_id"), held_out(doc).alias("held_out"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, net: Network, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``limit``, with all columns; only texts go to Python, only scores come back."""

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _scorer(net)
        for texts in parts:
            yield pa.array(scorer.score(texts), pa.float64())
        texts = None
        pa.default_memory_pool().release_unused()  # the worker lives on

    return docs.where(score(F.col("text").cast("string")) < limit)
