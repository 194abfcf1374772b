"""The conversation trie against a plain recursive version, and tree contraction against a plain walk."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

import check
from tallyframe.llm import checks, prefix_trie, registry

FOLDER = "/root/testdata/sf0.001"
LAYOUT = "conv_id long, turn int, role string, text string, node string, depth int, parent long"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    turns = {conv: [turn for _, turn in sorted(found)] for conv, found in own.items()}
    rebuilt = {}
    for conv in turns:
        h = zlib.crc32(str(conv).encode()) % 4
        rebuilt[conv] = tuple(turns.get(conv - conv % 20 if conv >= 0 else conv + -conv % 20, [])[:h] + turns[conv][h:])
    members, ends = defaultdict(set), defaultdict(list)
    for conv, path in rebuilt.items():
        ends[path].append(conv)
        for depth in range(len(path) + 1):
            members[path[:depth]].add(conv)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)

    def totals(path):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        below = [totals(kid) for kid in kids[path]]
        return (sum(b[0] for b in below) or 1, (len(members[path]) - 1) * words + sum(b[1] for b in below))

    for path in members:
        sha = hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest()
        parent = min(members[path[:-1]]) if path else None
        yield (min(members[path]), len(path), parent, len(members[path]), len(kids[path]), *totals(path), sha)


def awkward():
    rng = np.random.default_rng(3)
    rows = []
    for conv in [*range(60), 100, 101, 119, 123456789012, -5, -25]:
        same = conv % 3 == 0
        for turn in range(int(rng.integers(0, 5)) if not same else 4):
            rows.append((conv, turn, "user", f"w{turn} x" if same else f"w{rng.integers(3)} y z", "n", 1, 2))
    rows += [(300 + k, 0, "u", "one turn", None, None, None) for k in range(60)]  # turnless where the family has no head
    rows += [(7, None, None, None, None, None, None), (8, None, "a", "b c", None, None, None), (9, 1, "a", "b", None, None, None), (9, 1, "a", "b", None, None, None)]
    rows += [(11, 1, "a", "b " * 3, None, None, None), (11, 1, "b", "", None, None, None), (12, 5, "r", "é😀 \n x", None, None, None)]
    rows += [(None, 1, "user", "no conversation", None, None, None), (40, 9, "user", "word " * 20_000, None, None, None)]
    rows += [(500, turn, "user", f"deep {turn}", None, None, None) for turn in range(300)]
    return rows


def test_trie_on_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_BITS", 5)  # the long conversation has several chunks
    monkeypatch.setattr(prefix_trie, "BUCKET_BITS", 3)
    rows = awkward()
    found = prefix_trie.prefix_trie(spark.createDataFrame(rows, LAYOUT))
    assert found.columns == COLUMNS and {kind for name, kind in found.dtypes if name != "ends_sha256"} == {"bigint"}
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(brute(rows), key=repr)


def test_empty_table_has_no_root(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], LAYOUT)).collect() == []


def test_trie_equals_its_sql(spark):
    database = check.connect(FOLDER)
    assert check.difference(spark, database, FOLDER, registry.op13_prefix_trie, checks.ORACLES["op13_prefix_trie"]) is None


@pytest.mark.parametrize("shape", ["chain", "star", "random", "caterpillar"])
def test_contraction_equals_a_walk(spark, shape):
    rng = np.random.default_rng(5)
    size = 200
    parents = {
        "chain": [None, *range(size - 1)],
        "star": [None] + [0] * (size - 1),
        "random": [None] + [int(rng.integers(0, at)) for at in range(1, size)],
        "caterpillar": [None] + [at - 2 + at % 2 if at > 1 else 0 for at in range(1, size)],
    }[shape]
    weights = rng.integers(-5, 100, size).tolist()
    parents += [None]  # a tree of one node
    weights += [7]
    expected = list(weights)
    for at in range(size - 1, 0, -1):
        expected[parents[at]] += expected[at]
    names = rng.permutation(size + 1).tolist()
    rows = [(names[at], None if parent is None else names[parent], weights[at]) for at, parent in enumerate(parents)]
    found = prefix_trie.subtree_totals(spark.createDataFrame(rows, "node long, parent long, w long"), ["w"]).collect()
    assert sorted((row["node"], row["w"]) for row in found) == sorted(zip(names, expected))


def test_a_ring_is_an_error(spark):
    ring = spark.createDataFrame([(1, 2, 1), (2, 3, 1), (3, 1, 1), (4, 1, 1)], "node long, parent long, w long")
    with pytest.raises(ValueError, match="ring"):
        prefix_trie.subtree_totals(ring, ["w"])
