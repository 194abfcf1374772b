"""Personal data in texts: wide generators propose spans, boosted trees select among them."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import boosting, spans
from tallyframe.session import stored

# Each run of characters is taken whole: a match can only start where the run does, or where the
# match before ended, so long runs cost no more than their length, and no group repeats by recursion.
_LOCAL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++"
BASE = {
    "email": _LOCAL + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Wider forms: written-out addresses, numbers without a country code or after 00, other groupings, and cards at
# the start or end of a longer run of digits, of which the base form takes the whole.
_FOURS = r"[0-9]{4}(?:\x20[0-9]{4}\x20[0-9]{4}\x20[0-9]{4}|-[0-9]{4}-[0-9]{4}-[0-9]{4})"
WIDE = {
    "email_words": _LOCAL + r"\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]++)++",
    "phone_local": r"(?<![0-9A-Za-z+(.-])\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
    "phone_00": r"(?<![0-9A-Za-z+(.-])00[1-9][0-9]{0,2}[\x20().-]{1,2}[0-9][0-9\x20().-]{5,14}[0-9](?![0-9A-Za-z-])",
    "card_dots": r"(?<![0-9A-Za-z.])[0-9]{4}\.[0-9]{4}\.[0-9]{4}\.[0-9]{1,7}(?![0-9A-Za-z.])",
    "phone_bare": r"(?<![0-9A-Za-z+(.-])[2-9][0-9]{2}[2-9][0-9]{6}(?![0-9A-Za-z]|[.-][0-9])",
    "card_part": r"(?<![0-9])" + _FOURS + r"(?![0-9])",
    "card_tail": r"(?<![0-9])" + _FOURS + r"(?![\x20-]?[0-9])",
    "ip_groups": r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
}
KINDS = tuple(BASE)
_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|(?<=0))"
IP_PARTS = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"
# Words before a span that speak for its kind, and those that speak against any; the last of them counts.
CUES = {
    "email": "mail email contact write reach".split(),
    "ip": "ip host address addr server node gateway dns".split(),
    "card": "card visa mastercard amex credit debit account pay payment".split(),
    "phone": "phone telephone tel call mobile cell fax contact reach ring text".split(),
}
AGAINST = "order ref reference invoice part sku item serial version release isbn issn tracking ticket id model batch date page row case code build lot".split()
# Examples that teach the wider forms: numbers of each, and what stands around them.
EXAMPLES = {
    "email_words": ("jane (at) example (dot) org", "joe.doe [at] mail.example.com", "info(at)example.net"),
    "phone_local": ("415-555-1234", "(212) 555-0198", "303.555.7788", "415 555 9999"),
    "phone_00": ("0049 30 1234567", "0033 1 42 68 53 00", "0044-20-7946-0958"),
    "phone_bare": ("4155551234", "2125550198", "6505557788"),
    "card_dots": ("4111.1111.1111.1111", "5500.0000.0000.0004", "4012.8888.8888.1881"),
    "card_part": ("4111 1111 1111 1111 12/27", "5500-0000-0000-0004-2027"),
    "card_tail": ("2024 4111 1111 1111 1111", "12 4012 8888 8888 1881"),
    "ip_groups": ("2001:db8:0:0:1:2:3:4", "fe80:0:0:0:202:b3ff:fe1e:8329"),
}
FOR_FRAMES = ("{} #", "{}: #", "my {} is # thanks", "the {} (#)", "{} # or ask, then", "new {} no. #, please")
AGAINST_FRAMES = ("{} #", "{}: #", "see {} # there", "{} no. # of it", "{} (#)")
PLAIN_FRAMES = ("#", "and # the", "of it. # Then", "were (#)", "here, # or so")
PLAIN_TIMES = 20  # plain sentences are as common as all others
PLAIN_CASES = frozenset(EXAMPLES) - {"phone_bare"}  # forms that need no cue; ten bare digits do
CONTEXT = 32
SCORE_BINS = 1000
FEATURES = ("kind", "form", "length", "breaks", "before", "after", "near", "variety", "zero")
FORMS = (*BASE, *WIDE)


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a Luhn check digit."""
    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""), lambda d: F.ascii(d) - 48)
    doubled = F.transform(each, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _guards(text: Column) -> dict[str, Column]:
    digits = text.rlike("[0-9]")
    return {
        "email": F.contains(text, F.lit("@")),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(r"[0-9][\x20-]?[0-9]"),
        "phone": F.contains(text, F.lit("+")),
        "email_words": text.rlike(r"[\[(]at[\])]"),
        "phone_local": digits,
        "phone_00": F.contains(text, F.lit("00")),
        "card_dots": text.rlike(r"[0-9]{4}\.[0-9]{4}\."),
        "phone_bare": text.rlike("[0-9]{10}"),
        "card_part": text.rlike(r"[0-9]{4}[\x20-][0-9]{4}[\x20-]"),
        "card_tail": text.rlike(r"[0-9]{4}[\x20-][0-9]{4}[\x20-]"),
        "ip_groups": text.rlike("[0-9A-Fa-f]:[0-9A-Fa-f]"),
    }


def _side(char: Column) -> Column:
    """0 none or white space, 1 letter, 2 digit, 3 other."""
    return F.when(char.rlike(r"^[\x20\x09-\x0D]?$"), 0).when(char.rlike("^[0-9]"), 2).when(char.rlike(r"^\p{L}"), 1).otherwise(3)


def _near(left: Column, kind: str) -> Column:
    """2 if the last cue before a span speaks for its kind, 1 if it speaks against, 0 without any."""
    words = sorted({*CUES[kind], *AGAINST}, key=lambda word: (-len(word), word))
    last = F.lower(F.regexp_extract(F.right(left, F.lit(CONTEXT)), rf"(?is)^.*(?<![a-z])({'|'.join(words)})(?![a-z])", 1))
    return F.when(last == "", 0).when(last.isin(CUES[kind]), 2).otherwise(1)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and ``found``: per document an array of (kind, start, end, form, base, checked, open, f).

    ``form`` is the generator, ``base`` says that a base form passed its check, ``checked`` that it is a base
    form, ``open`` that a wider form is possible (digits of its kind, Luhn for cards) and can be added, ``f`` are the
    features: format and context, and nothing that decides the check. Nothing but columns of Spark: one pass per form
    over the texts that can hold it.
    """
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    guards = _guards(F.col("text"))
    forms = {**BASE, **WIDE}
    listed = {f"m_{form}": spans.matches(F.col("text"), pattern, guards[form]) for form, pattern in forms.items()}
    listed |= {f"p_{form}": spans.pieces(F.col("text"), pattern, guards[form]) for form, pattern in forms.items()}
    found = whole.select("doc_id", *[column.alias(name) for name, column in listed.items()])
    return found.select("doc_id", F.concat(*[_described(form) for form in forms]).alias("found"))


def _described(form: str) -> Column:
    found, between, kind = F.col(f"m_{form}"), F.col(f"p_{form}"), form.partition("_")[0]
    at = spans.starts(found, between)

    def describe(pair: Column, place: Column) -> Column:
        match, start = pair["m"], pair["s"]
        digits = F.regexp_replace(match, "[^0-9]", "")
        count, passes_ip = F.length(digits), match.rlike(IP_PARTS)
        passes_luhn = (count > 1) & (count <= 40) & luhn(F.substring(digits, 1, 40))
        valid = {
            "email": F.lit(True),
            "ip": passes_ip,
            "card": count.between(13, 19) & passes_luhn,
            "phone": count.between(9, 15),
        }[kind]
        left, right = F.element_at(between, place + 1), F.element_at(between, place + 2)
        values = [
            F.lit(KINDS.index(kind)),
            F.lit(FORMS.index(form)),
            F.least(F.length(match), F.lit(48)),
            F.least(F.length(F.regexp_replace(match, r"[^\x20().-]", "")), F.lit(12)),
            _side(F.right(left, F.lit(1))),
            _side(F.left(right, F.lit(1))),
            _near(left, kind),
            F.least(F.size(F.array_distinct(F.split(digits, ""))), F.lit(10)),
            F.startswith(digits, F.lit("0")).cast("int"),
        ]
        return F.struct(
            F.lit(kind).alias("kind"),
            start.alias("start"),
            (start + F.length(match)).alias("end"),
            F.lit(form).alias("form"),
            (F.lit(form in BASE) & valid).alias("base"),
            F.lit(form in BASE).alias("checked"),
            (F.lit(form in WIDE) & (valid if form != "ip_groups" else F.lit(True))).alias("open"),
            F.array(*[value.cast("int") for value in values]).alias("f"),
        )

    return F.transform(F.arrays_zip(found.alias("m"), at.alias("s")), describe)


def taught(spark: SparkSession) -> DataFrame:
    """(f, up, fold) of the wider forms in the examples: ``up`` is 1 in a sentence that speaks for personal data."""
    rows = []
    for form, numbers in EXAMPLES.items():
        for number in numbers:
            frames = [(frame.format(word), 1) for frame in FOR_FRAMES for word in CUES[form.partition("_")[0]]]
            frames += [(frame.format(word), 0) for frame in AGAINST_FRAMES for word in AGAINST]
            frames += [(frame, int(form in PLAIN_CASES)) for frame in PLAIN_FRAMES * PLAIN_TIMES]
            rows += [(frame.replace("#", number), up) for frame, up in frames]
    listed = json.dumps([{"doc_id": 2 * at + up, "text": text} for at, (text, up) in enumerate(rows)])
    docs = spark.range(1).select(F.explode(F.from_json(F.lit(listed), "array<struct<doc_id:long,text:string>>")).alias("d")).select("d.*")
    each = candidates(docs).select("doc_id", F.explode("found").alias("c")).where("c.open")
    return each.select(F.col("c.f").alias("f"), (F.col("doc_id") % 2).alias("up"), F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("fold"))


def fit(found: DataFrame, most_vectors: int = 20_000, precision: float = 0.95) -> tuple[boosting.Boosted, dict[str, float]]:
    """The trees and a threshold per kind.

    Two teachers of equal weight: the base forms of the corpus, of which those that passed their check are
    cases, and the examples of the wider forms, in sentences that speak for personal data or against it. The
    checks are no features, so format and context have to tell. All base candidates are counted per
    feature vector; of them at most ``most_vectors`` vectors, those of the smallest hash, fit the trees, and half
    of the examples. The other half sets each kind's threshold, as only wider forms are added by it: the least
    score, in steps of 1 / SCORE_BINS, at which the share of cases is ``precision``.
    """
    each = found.select(F.explode("found").alias("c")).where("c.checked")
    counted = each.groupBy("c.f").agg(F.sum(F.col("c.base").cast("long")).alias("up"), F.count(F.lit(1)).alias("all"))
    learn = counted.orderBy(F.xxhash64("f"), "f").limit(most_vectors).collect()
    told = stored(taught(found.sparkSession).groupBy("f", "fold").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("all")), "taught")
    examples = told.where("fold = 0").orderBy("f").collect()
    even = sum(r["all"] for r in examples) / max(sum(r["all"] for r in learn), 1)
    weighed = [(r["f"], even * r["up"], even * r["all"]) for r in learn] + [(r["f"], r["up"], r["all"]) for r in examples]
    model = boosting.fit([f for f, _, _ in weighed], [up for _, up, _ in weighed], [every - up for _, up, every in weighed])
    step = F.floor(model.score(F.col("f")) * SCORE_BINS).cast("int").alias("step")
    held = told.where("fold = 1").select(F.col("f")[0].alias("place"), step, "up", "all")
    return model, _thresholds(held.groupBy("place", "step").agg(F.sum("up").alias("up"), F.sum("all").alias("all")).collect(), precision)


def _thresholds(rows: Sequence, precision: float) -> dict[str, float]:
    """Per kind the least score from which on the share of cases is ``precision``, from sums per kind (its
    ``place``) and ``step`` of the score; 0.5 for a kind of which no held-out document has a case or other."""
    limits = {}
    for place, kind in enumerate(KINDS):
        own = sorted((r for r in rows if r["place"] == place), key=lambda r: -r["step"])
        limits[kind] = 1.1 if own else 0.5
        up = every = 0
        for r in own:
            up, every = up + r["up"], every + r["all"]
            if up >= precision * every:
                limits[kind] = r["step"] / SCORE_BINS
    return limits


def personal_data(docs: DataFrame, most_vectors: int = 20_000, precision: float = 0.95) -> DataFrame:
    """doc_id and ``base`` and ``all``: arrays of (kind, start, end, score), sorted by kind and start.

    All base forms that pass their check stay. Of the wider forms, a possible one is added where its score
    reaches its kind's threshold, it touches no base span, and no better candidate overlaps it. One
    row per row of ``docs``; null and empty texts have none; an empty table gives no rows; other
    columns are ignored.
    """
    found = stored(candidates(docs), "candidates")
    model, limits = fit(found, most_vectors, precision)
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    order = F.create_map(*[F.lit(x) for place, kind in enumerate(KINDS) for x in (kind, place)])

    def scored(c: Column) -> Column:
        fields = {"order": order[c["kind"]], "start": c["start"], "end": c["end"], "kind": c["kind"], "score": model.score(c["f"]), "base": c["base"]}
        return F.struct(*[value.alias(name) for name, value in fields.items()])

    apart = lambda a, b: (a["end"] <= b["start"]) | (b["end"] <= a["start"])
    better = lambda a, b: (a["score"] > b["score"]) | ((a["score"] == b["score"]) & (F.struct(a["order"], a["start"], a["end"]) < F.struct(b["order"], b["start"], b["end"])))
    rows = found.withColumn("found", F.transform(F.filter("found", lambda c: c["base"] | c["open"]), scored))
    base = F.filter("found", lambda c: c["base"])
    rows = rows.select("doc_id", F.array_sort(base).alias("base"), F.filter("found", lambda c: ~c["base"] & (c["score"] >= limit[c["kind"]])).alias("more"))
    free = F.filter("more", lambda c: ~F.exists("base", lambda b: ~apart(b, c)))
    rows = rows.withColumn("more", F.when(F.size("more") > 0, free).otherwise(F.col("more")))
    alone = F.filter("more", lambda c: ~F.exists("more", lambda d: ~apart(d, c) & better(d, c)))
    rows = rows.withColumn("more", F.when(F.size("more") > 0, alone).otherwise(F.col("more")))
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", "more")).alias("all"))


def personal_data_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans): counts of base spans, a digest of
    them, and all spans as ``kind:start:end``; one row per row of ``docs``."""
    rows = personal_data(docs)
    number = lambda kind: F.size(F.filter("base", lambda c: c["kind"] == kind)).cast("long")
    counts = [number(kind).alias(f"n_{kind}") for kind in KINDS]
    digest = F.sha2(spans.joined(F.col("base")), 256).alias("base_sha256")
    return rows.select("doc_id", *counts, digest, spans.joined(F.col("all")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with every selected span replaced by its kind in brackets, overlaps merged."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    marks = personal_data(docs).select("doc_id", F.array_sort(F.transform("all", lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind")))).alias("marks"))
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    walk = lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]"))).otherwise(acc["out"]).alias("out"),
    )
    done = F.aggregate("marks", first, walk, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    return rows.join(marks, "doc_id").select("doc_id", done.alias("text"))
