"""Secrets in texts: fixed forms, and tokens that a battery of randomness tests singles out."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm import spans
from tallyframe.session import stored

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # a run of that class ends all its matches, so only whole runs can be long enough
HEX = re.compile(r"[0-9a-f]{16,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
KEYWORDS = ("passw", "secret", "token", "api")

# Inferred encodings: name, alphabet size. A token gets the first whose characters hold it.
ENCODINGS = (("hex", 16), ("base36", 36), ("base64", 64), ("letters", 26))
DRAWS, LONGEST = 2000, 256  # tokens drawn per null distribution; longer tokens use that of LONGEST
# Ordinary writing is surprised by a token of p-value p by -STEPS * log2(p), rounded down and at most MOST_SURPRISE.
STEPS, MOST_SURPRISE = 4, 400
NEVER = 1  # a token with at most so many random ones beyond it is never taken for random
EXACT = 40  # so many drawn ordinary tokens below a score, and its share is counted; with fewer the fitted tail holds
LETTERS = np.array([8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.2, 0.8, 4.0, 2.4, 6.7, 7.5, 1.9, 0.1, 6.0, 6.3, 9.1, 2.8, 1.0, 2.4, 0.2, 2.0, 0.1])  # a to z, percent in English
_SYMBOLS = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/"
_CODE = np.zeros(128, np.int64)
_CODE[[ord(c) for c in _SYMBOLS]] = np.arange(64)
_CODE[[ord("-"), ord("_")]] = (62, 63)  # the URL-safe letters of base64
_SORT = np.full(128, 3)  # digits, small letters, capitals, signs; of letters alone, vowels or not
_SORT[48:58], _SORT[97:123], _SORT[65:91] = 0, 1, 2
_VOWEL = np.isin(np.arange(128), [ord(c) for c in "aeiouAEIOU"]).astype(np.int64)
CHANGES = np.array([0.4688, 0.4012, 0.6445, 0.3107])  # how often neighbours are of two sorts, if random
_FOLDED = _CODE.copy()
_FOLDED[65:91] = _CODE[97:123]


def encoding(token: str) -> int:
    """Number of the inferred encoding of a token."""
    plain = token.rstrip("=")
    if re.fullmatch(r"[0-9A-F]+|[0-9a-f]+", plain):
        return 0
    if re.fullmatch(r"[A-Z]+|[a-z]+", plain):
        return 3
    return 1 if re.fullmatch(r"[0-9A-Z]+|[0-9a-z]+", plain) else 2


def battery(tokens: list[str], encodings: list[int], as_words: bool = False) -> np.ndarray:
    """Per token the root mean square of four normal scores; about 1 for random symbols, greater for others.

    Chi-squared uniformity over the alphabet (by the cube-root approximation, only too uneven counts
    count), the number of runs above and below the middle of the alphabet, that of runs of one sort of
    symbol (only too few count, but for letters alone), and the correlation of neighbouring symbols. ``as_words`` maps the letters of words onto the alphabet, to learn how
    ordinary words score under it.
    """
    if not tokens:
        return np.zeros(0)
    plain = [token.rstrip("=") or "=" for token in tokens]
    n = np.array([len(token) for token in plain])
    size = np.array([ENCODINGS[e][1] for e in encodings])
    flat = np.frombuffer("".join(plain).encode("ascii"), np.uint8)
    owner, first = np.repeat(np.arange(len(n)), n), np.r_[0, n.cumsum()[:-1]]
    code = np.where(size[owner] == 64, _CODE[flat], _FOLDED[flat])
    code = np.where((size[owner] == 26) | as_words, code - 10, code) % size[owner]
    counts = np.bincount(owner * 64 + code, minlength=64 * len(n)).reshape(-1, 64)
    expected, free = n / size, size - 1.0
    chi = (counts.astype(float) ** 2).sum(axis=1) / expected - n
    uneven = (np.cbrt(chi / free) - (1 - 2 / (9 * free))) / np.sqrt(2 / (9 * free))
    high = (2 * code >= size[owner]).astype(np.int64)
    inner = np.ones(len(flat), bool)
    inner[first] = False
    changes = np.add.reduceat(np.r_[0, high[1:] != high[:-1]] * inner, first)
    up = np.add.reduceat(high, first).astype(float)
    down = n - up
    mean = 2 * up * down / n + 1
    spread = np.sqrt(np.maximum((mean - 1) * (mean - 2) / np.maximum(n - 1, 1), 1e-9))
    runs = np.where(np.minimum(up, down) < 1, np.sqrt(n), np.abs(changes + 1 - mean) / np.maximum(spread, 0.5))
    sort = np.where(size[owner] == 26, _VOWEL[flat], _SORT[flat])
    turns = np.add.reduceat(np.r_[0, sort[1:] != sort[:-1]] * inner, first)
    often = CHANGES[np.asarray(encodings)]
    sorts = ((n - 1) * often - turns) / np.sqrt(np.maximum(n - 1, 1) * often * (1 - often))
    sorts = np.where(size == 26, np.abs(sorts), np.maximum(sorts, 0))
    centre = code - (np.add.reduceat(code, first) / n)[owner]
    together = np.add.reduceat(np.r_[0.0, centre[1:] * centre[:-1]] * inner, first)
    square = np.add.reduceat(centre**2, first)
    serial = np.where(square > 0, np.abs(together / np.maximum(square, 1e-9) + 1 / n) * np.sqrt(n), np.sqrt(n))
    return np.sqrt((np.maximum(uneven, 0) ** 2 + runs**2 + sorts**2 + serial**2) / 4)


def _ordinary(kind: int, n: int, rng: np.random.Generator) -> list[str]:
    """DRAWS tokens of ``n`` symbols as people write them in an encoding: words of 3 to 10 English letters; in
    hex between numbers, in base36 and base64 with numbers at the end, in base64 also with signs or
    capitals where words start."""
    share = np.where(np.arange(26) < 6, LETTERS, 0) if kind == 0 else LETTERS
    letters = rng.choice(26, (DRAWS, n), p=share / share.sum()) + ord("a")
    digits = rng.integers(0, 10, (DRAWS, n)) + ord("0")
    starts = np.zeros((DRAWS, n + 11), bool)
    at = rng.integers(0, 11, DRAWS)
    while (at < n).any():
        starts[np.arange(DRAWS), np.minimum(at, n)] = True
        at += rng.integers(3, 11, DRAWS)
    starts = starts[:, :n]
    if kind == 0:
        letters = np.where(starts.cumsum(axis=1) % 2, letters, digits)
    elif kind != 3:
        numbered = np.arange(n) >= n - rng.integers(0 if kind == 2 else 1, 5, (DRAWS, 1))
        letters = np.where(numbered, digits, letters)
        if kind == 2:
            sign = np.array([ord(c) for c in "_-/"])[rng.integers(0, 3, (DRAWS, 1))]
            letters = np.where(starts & ~numbered, np.where(rng.random((DRAWS, 1)) < 0.5, letters - 32, sign), letters)
    return [row.tobytes().decode("ascii") for row in letters.astype(np.uint8)]


@cache
def nulls(kind: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted scores of the battery over DRAWS tokens of ``n`` symbols: uniform random ones, and ordinary ones."""
    rng = np.random.default_rng([kind, n])
    symbols = "abcdefghijklmnopqrstuvwxyz" if kind == 3 else _SYMBOLS[: ENCODINGS[kind][1]]
    drawn = ["".join(row) for row in rng.choice(list(symbols), (DRAWS, n))]
    return np.sort(battery(drawn, [kind] * DRAWS)), np.sort(battery(_ordinary(kind, n, rng), [kind] * DRAWS))


@cache
def _tail(kind: int, n: int) -> tuple[float, float]:
    """Middle and width of a normal lower tail that lies above the drawn ordinary scores at three small shares."""
    _, ordinary = nulls(kind, n)
    middle = float(np.median(ordinary))
    shares = {0.05: 1.6449, 0.02: 2.0537, 0.01: 2.3263}  # normal quantiles
    return middle, max(max((middle - float(np.quantile(ordinary, share))) / z for share, z in shares.items()), 1e-3)


def _surprise(score: float, kind: int, n: int) -> int:
    _, ordinary = nulls(kind, n)
    below = int(np.searchsorted(ordinary, score + 1e-9))
    middle, width = _tail(kind, n)
    p = (1 + below) / (1 + DRAWS) if below >= EXACT else min(math.erfc((middle - score) / width / math.sqrt(2)) / 2, (1 + EXACT) / (1 + DRAWS))
    return int(min(-STEPS * math.log2(max(p, 1e-300)), MOST_SURPRISE))


def ranks(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per token the number of drawn random tokens of its encoding and length that score at least as
    high (one more over DRAWS + 1 is the p-value of being random), and the surprise of ordinary writing."""
    kinds = [encoding(token) for token in tokens]
    rarer, usual = np.zeros(len(tokens), np.int64), np.zeros(len(tokens), np.int64)
    for at, (token, kind, score) in enumerate(zip(tokens, kinds, battery(tokens, kinds))):
        n = min(len(token.rstrip("=")), LONGEST)
        rarer[at] = DRAWS - np.searchsorted(nulls(kind, n)[0], score - 1e-9)
        usual[at] = _surprise(float(score), kind, n)
    return rarer, usual


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, number of the kind) of the fixed forms, sorted."""
    found = [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    lower = text.lower()
    if any(word in lower for word in KEYWORDS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    return sorted(found)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base, place, wide = [], [], []
        for row, text in enumerate(batch.column(1).to_pylist()):
            found = base_spans(text) if text else []
            base.append(found)
            begun, ended = [start for start, _, _ in found], [0, *accumulate((end for _, end, _ in found), max)]
            for m in TOKEN.finditer(text or ""):
                if ended[bisect_left(begun, m.end())] <= m.start():  # no base span reaches into it
                    place.append((row, m.start(), m.end()))
                    wide.append(m[0])
        more: list[list[dict]] = [[] for _ in base]
        for (row, start, end), rarer, usual in zip(place, *ranks(wide)):
            more[row].append({"start": start, "end": end, "rarer": int(rarer), "usual": int(usual)})
        named = [[{"start": s, "order": k, "end": e} for s, e, k in found] for found in base]
        digests = [",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in found) for found in base]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(named, pa.list_(pa.struct([("start", pa.int32()), ("order", pa.int32()), ("end", pa.int32())]))),
                pa.array([hashlib.sha256(text.encode()).hexdigest() for text in digests], pa.string()),
                pa.array(more, pa.list_(pa.struct([(name, pa.int32()) for name in ("start", "end", "rarer", "usual")]))),
            ],
            ["doc_id", "base", "base_sha256", "wide"],
        )


LAYOUT = (
    "doc_id long, base array<struct<start:int,`order`:int,end:int>>, base_sha256 string, "
    "wide array<struct<start:int,end:int,rarer:int,usual:int>>"
)


def rejected(met: dict[int, int], rate: float = 0.01) -> int:
    """The greatest rank at which a token counts as not random, -1 if none: the procedure of Benjamini and
    Hochberg over the tokens ``met`` per rank, so that at most ``rate`` of those left out are random ones."""
    every, seen, limit = sum(met.values()), 0, -1
    for rank in sorted(met):
        seen += met[rank]
        if (1 + rank) / (1 + DRAWS) <= rate * seen / every:
            limit = rank
    return limit


def discovered(met: dict[int, int], rate: float = 0.01) -> int:
    """The least surprise at which a token counts as no ordinary writing, above MOST_SURPRISE if none: the procedure
    of Benjamini and Hochberg over the tokens ``met`` per surprise, so that at most ``rate`` of the tokens found are
    ordinary ones, however many the corpus holds."""
    every, seen, limit = sum(met.values()), 0, MOST_SURPRISE + 1
    for surprise in sorted(met, reverse=True):
        seen += met[surprise]
        if 2 ** (-surprise / STEPS) <= rate * seen / every:
            limit = surprise
    return limit


def find_secrets(docs: DataFrame, rate: float = 0.01) -> DataFrame:
    """doc_id, ``base`` and ``all`` (arrays of start, order, end; order numbers KINDS) and base_sha256.

    Base forms stay. Every other token of 16 or more letters, digits and base64 signs goes through the
    battery, and its p-values come from the battery's own distribution over random and over ordinary
    tokens of its encoding and length. It is added, as kind random, where ordinary writing is rejected under
    false-discovery control over all tokens of the corpus (the rarer secrets are among them, the more a token
    has to differ, so short ones are lost first), and where randomness is not rejected among those. Only counts
    per rank and per surprise come to the driver (DRAWS + 1 and MOST_SURPRISE + 1 at most). One row per
    row of ``docs``; null and empty texts have no span; offsets are code points; an empty table gives
    no rows; other columns are ignored.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = stored(narrow.mapInArrow(_scan, LAYOUT), "secrets")
    each = found.select(F.explode("wide").alias("c")).select("c.*")
    counted = lambda rows, name: {r[name]: r["n"] for r in rows.groupBy(name).agg(F.count(F.lit(1)).alias("n")).collect()}
    least = discovered(counted(each, "usual"), rate)
    limit = max(rejected(counted(each.where(F.col("usual") >= least), "rarer"), rate), NEVER)
    random = F.filter("wide", lambda c: (c["rarer"] > limit) & (c["usual"] >= least))
    shaped = F.transform(random, lambda c: F.struct(c["start"].alias("start"), F.lit(KINDS.index("random")).alias("order"), c["end"].alias("end")))
    return found.select("doc_id", "base", F.array_sort(F.concat("base", shaped)).alias("all"), "base_sha256")


def secrets_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans): counts of the base forms, a digest of
    them, and all spans as ``kind:start:end``; one row per row of ``docs``."""
    found = find_secrets(docs)
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    number = lambda kind: F.size(F.filter("base", lambda c: c["order"] == kind)).cast("long")
    counts = [number(kind).alias(f"n_{KINDS[kind]}") for kind in range(3)]
    named = F.transform("all", lambda c: F.struct(F.element_at(kinds, c["order"] + 1).alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return found.select("doc_id", *counts, "base_sha256", spans.joined(named).alias("spans"))
