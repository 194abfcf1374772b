"""The near-dedup stage of the pipeline against brute force over all pairs."""

from __future__ import annotations

import numpy as np

import corpus_pipeline
from tallyframe.llm import shingles, simhash

FOLDER = "/root/testdata/sf0.001"


def _shingles(text: str | None) -> frozenset:
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[at : at + 5]) for at in range(max(len(words) - 4, 1)))


def _kept(rows) -> set:
    """Smallest ids of the groups, by comparing all pairs."""
    sets = {i: _shingles(text) for i, text in rows}
    root = {i: i for i in sets}
    ids = sorted(sets)
    for at, a in enumerate(ids):
        for b in ids[at + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared / (len(sets[a]) + len(sets[b]) - shared) >= 0.8:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return set(root.values())


def test_near_stage_drops_edited_copies(spark):
    rng = np.random.default_rng(8)
    rows = []
    for base in range(30):
        words = [f"w{k}" for k in rng.integers(0, 900, 120)]
        for copy in range(6):  # each edit of one word changes up to five shingles, so copies lie on both sides of 0.8
            edited = list(words)
            for at in rng.integers(0, len(words), copy):
                edited[at] = f"e{rng.integers(10**6)}"
            rows.append((100 * base + copy, " ".join(edited)))
    rows += [(9001, None), (9002, " "), (9003, "one two"), (9004, "ONE  two"), (9005, "three")]
    docs = spark.createDataFrame([*rows, (None, "three")], "doc_id long, text string")
    got = corpus_pipeline.near(spark, docs, FOLDER).collect()
    expected = _kept(rows)
    assert {r["doc_id"] for r in got} == expected | {None} and 35 < len(expected) < len(rows)
    assert corpus_pipeline.near(spark, docs.limit(0), FOLDER).collect() == []


def test_near_stage_on_the_given_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    expected = _kept([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert {r["doc_id"] for r in corpus_pipeline.near(spark, docs, FOLDER).collect()} == expected


def test_units_of_a_large_band_find_every_link(spark, monkeypatch):
    monkeypatch.setattr(shingles, "CHUNK", 8)
    monkeypatch.setattr(shingles, "COLUMNS", 16)
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(80)]
    rows = []
    for doc in range(60):
        words = list(base)
        for at in rng.integers(0, 80, doc % 4):
            words[at] = f"e{rng.integers(30)}"
        rows.append((1 + doc % 2, doc, doc // 12, " ".join(words)))
    sets = {doc: _shingles(text) for _, doc, _, text in rows}

    def groups(links):
        root = {doc: doc for doc in sets}
        for a, b in links:
            low, high = sorted((root[a], root[b]))
            root = {doc: low if label == high else label for doc, label in root.items()}
        return root

    expected = [
        (a[1], b[1])
        for a in rows
        for b in rows
        if a[1] < b[1] and a[0] == b[0] and a[2] != b[2] and len(sets[a[1]] & sets[b[1]]) / len(sets[a[1]] | sets[b[1]]) >= 0.8
    ]
    found = [tuple(row) for row in shingles.close_links(spark.createDataFrame(rows, "band long, doc long, own long, text string")).collect()]
    assert len(found) == len(set(found)) and all(a < b for a, b in found)
    assert groups(found) == groups(expected) and 60 > len(set(groups(expected).values())) > 2


def test_shared_counts_equal_plain_sets(monkeypatch):
    monkeypatch.setattr(shingles, "COLUMNS", 5)
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40), np.uint64)) for _ in range(20)]
    found = shingles.shared_counts(sets)
    assert all(found[a, b] == len(np.intersect1d(sets[a], sets[b])) for a in range(20) for b in range(20) if a != b)


def test_awkward_rows_of_the_near_stage(spark):
    layout = "doc_id long, text string, band long, own string, least string"
    rows = [(1, "a b c d e f g", None, None, None), (1, "a b c d e f g", 1, "x", "y"), (2, "A  b c d e f g", None, None, None), (3, None, None, None, None)]
    rows += [(4, "", 5, "o", "l"), (5, "long word " * 40_000, None, None, None), (6, "LONG word " * 40_001, None, None, None), (None, "a b c d e f g", 1, None, None)]
    kept = corpus_pipeline.near(spark, spark.createDataFrame(rows, layout), FOLDER)
    assert kept.columns == ["doc_id", "text", "band", "own", "least"]
    assert sorted((row["doc_id"] or 0) for row in kept.collect()) == [0, 1, 1, 3, 5]


def test_bk_trees_of_wide_values_equal_brute_force():
    rng = np.random.default_rng(6)
    values = np.repeat(rng.integers(0, 2**64, (60, 2), np.uint64), 5, axis=0)
    values[:, 0] ^= np.uint64(1) << rng.integers(0, 64, 300, np.uint64)
    found = simhash.within(simhash.bk_tree(values, 4), values, values[:50], 1)
    apart = np.bitwise_count(values[:50, None] ^ values[None, :]).sum(axis=2)
    assert set(zip(*(end.tolist() for end in found))) == set(zip(*(end.tolist() for end in np.nonzero(apart <= 1))))


def test_neighbours_equal_fingerprints_compared_in_pairs(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**64, (8, shingles.PRINT_WORDS), np.uint64)
    rows = []
    for doc in range(160):
        flipped = base[doc % 8].copy()
        for at in rng.integers(0, 128, rng.integers(0, 8)):
            flipped[at // 64] ^= np.uint64(1) << np.uint64(at % 64)
        rows.append((doc, [int(word) for word in flipped.view(np.int64)], [int(doc % 3 > 0), 2 + doc % 2]))
    prints = spark.createDataFrame(rows, "doc long, print array<long>, shards array<long>")

    def near(a, b):
        return sum(((x ^ y) & 2**64 - 1).bit_count() for x, y in zip(a[1], b[1])) <= 5

    expected = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and set(a[2]) & set(b[2]) and near(a, b)}
    for shard_rows, leaf in ((4096, 4096), (4096, 4), (20, 4)):  # one leaf, a tree, trees of pairs of chunks
        members: dict[int, set] = {}
        for doc, band in shingles.neighbours(prints, 5, shard_rows, leaf).collect():
            members.setdefault(band, set()).add(doc)
        assert all(any({a, b} <= group for group in members.values()) for a, b in expected)
        for group in members.values():  # connected, and of at least two
            todo, seen = [min(group)], {min(group)}
            while todo:
                at = todo.pop()
                new = {b for b in group - seen if (min(at, b), max(at, b)) in expected}
                seen |= new
                todo += new
            assert seen == group and len(group) > 1


def test_fingerprints_propose_nearly_all_pairs_at_the_threshold():
    rng = np.random.default_rng(9)
    found = 0
    for _ in range(400):
        both, own = rng.integers(0, 2**64, 80, np.uint64), rng.integers(0, 2**64, 20, np.uint64)
        a, b = (shingles.fingerprint(np.concatenate([both, part])) for part in (own[:10], own[10:]))
        blocks = np.unpackbits((a ^ b).view(np.uint8)).reshape(shingles.BLOCKS, shingles.WIDTH)
        close = np.bitwise_count(a ^ b)[: shingles.PRINT_WORDS].sum() <= shingles.RADIUS
        found += bool(close and (~blocks.any(axis=1)).any())
    assert found >= 398


def test_texts_of_a_large_group_travel_once_and_not_once_per_band(spark, monkeypatch):
    rng = np.random.default_rng(10)
    base = [f"w{k}" for k in range(100)]
    rows = []
    for doc in range(160):  # up to 7 edits, so some copies are similar to few others and some to none
        edited = list(base)
        for at in rng.integers(0, 100, doc % 8):
            edited[at] = f"e{rng.integers(10**6)}"
        rows.append((doc, " ".join(edited)))
    counts, compare, link = {}, shingles.similar_pairs, shingles.close_links

    def pairs(met, *more):
        counts["pairs"] = met.count()
        return compare(met, *more)

    def links(members, *more):
        counts["texts"], counts["docs"] = members.count(), members.select("doc").distinct().count()
        return link(members, *more)

    monkeypatch.setattr(shingles, "similar_pairs", pairs)
    monkeypatch.setattr(shingles, "close_links", links)
    got = corpus_pipeline.near(spark, spark.createDataFrame(rows, "doc_id long, text string"), FOLDER).collect()
    expected = _kept(rows)
    assert {r["doc_id"] for r in got} == expected and 50 < len(expected) < 120
    assert counts["texts"] == counts["docs"] <= 160 and counts["pairs"] <= 2 * 160


def test_nearest_in_bands_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(shingles, "ROWS", 16)
    rng = np.random.default_rng(11)
    base = rng.integers(0, 2**64, (3, 12), np.uint64)
    prints, bands = [], []
    for doc in range(120):
        flipped = np.unpackbits(base[doc % 3].view(np.uint8))
        flipped[rng.choice(768, rng.integers(0, 130), replace=False)] ^= 1
        prints.append((doc, int(rng.integers(3, 9)), [int(word) for word in np.packbits(flipped).view(np.int64)]))
        bands += [(doc, band) for band in (0, 1 + doc % 5)]  # a large band and small ones
    size, bits = [p[1] for p in prints], np.array([p[2] for p in prints]).view(np.uint64)

    def apart(a, b):
        return int(np.bitwise_count(bits[a] ^ bits[b]).sum())

    expected = set()
    for band in range(6):
        docs = sorted(doc for doc, own in bands if own == band)
        near = {a: [] for a in docs}
        for a in docs:
            for b in docs:
                most = shingles.FEW_RADIUS if min(size[a], size[b]) < shingles.FEW else shingles.WHOLE_RADIUS
                if a != b and apart(a, b) <= most and min(size[a], size[b]) >= 0.8 * max(size[a], size[b]):
                    near[a].append(b)
        sure = {a: [b for b in near[a] if apart(a, b) <= shingles.SURE] for a in docs}
        for a in (a for a in docs if near[a]):
            todo, seen = [a], {a}
            while todo:
                todo += (new := set(near[todo.pop()]) - seen)
                seen |= new
            nearest = min(near[a], key=lambda b: (apart(a, b), b))
            hub = min(sure[a], key=lambda b: (-len(sure[b]), b)) if sure[a] else None
            expected.add((a, min(seen), nearest, apart(a, nearest), hub))
    frames = spark.createDataFrame(bands, "doc long, band long"), spark.createDataFrame(prints, "doc long, size long, print array<long>")
    found = {(r["doc"], r["root"], r["nearest"], r["apart"], r["hub"]) for r in shingles.nearest_in_bands(*frames).collect()}
    unsure = {(a, nearest) for a, _, nearest, _, hub in expected if hub is None}
    assert {row if (row[0], row[2]) not in unsure else (*row[:4], None) for row in found} == expected and 0 < len(unsure) < len(expected)
