"""Trie of conversation prefixes with subtree totals, found by parallel tree contraction."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.ordered import with_row_index
from tallyframe.session import stored

WORD = r"[^\x20\x09-\x0D]+"
FAMILY, HEADS = 20, 4  # conversations of a family share their first turns, fewer than HEADS of them
CHUNK_BITS = 16  # a conversation's running keys are computed in chunks of 2**16 turns
BUCKET_BITS = 8  # conv_ids are joined to texts of at most 2**8 of them before they are hashed
KEY = ("depth", "k1", "k2")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, n, digest, words): the turns of each conversation numbered from 1, ``n`` of them.

    Turns are ordered by ``turn``, null first; those of one turn number by the digest of role and text. The order
    is one global sort, so a conversation that holds much of the table is split; texts are not shuffled.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    narrow = conversations.select(
        F.col("conv_id").cast("long").alias("conv"), "turn", digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")
    ).where("conv IS NOT NULL")
    placed = with_row_index(narrow, [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("digest")], "at")
    firsts = placed.groupBy("conv").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    return placed.join(firsts, "conv").select("conv", (F.col("at") - F.col("first") + 1).alias("pos"), "n", "digest", "words")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, turns_left) of every conversation rebuilt with the head of its family, and its turns
    (conv, depth, last, digest, words); ``last`` marks the final one."""
    convs = turns.where("pos = 1").select("conv", "n")
    heads = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(HEADS))
    convs = convs.select("conv", "n", heads.alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = convs.join(bases, "base", "left").select("conv", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size"))
    convs = stored(convs, "convs")
    own = turns.join(convs, "conv").where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "size", "digest", "words")
    lent = turns.where(F.col("pos") < HEADS).select(F.col("conv").alias("base"), F.col("pos").alias("depth"), "digest", "words")
    lent = lent.join(convs, "base").where("depth <= taken").select("conv", "depth", "size", "digest", "words")
    rebuilt = own.union(lent).select("conv", "depth", (F.col("depth") == F.col("size")).alias("last"), "digest", "words")
    return convs.select("conv", "size"), rebuilt


def prefix_keys(rebuilt: DataFrame) -> DataFrame:
    """``rebuilt`` with the key (k1, k2) of the prefix that ends at each turn and that of its parent (p1, p2).

    A key is the exclusive or of the hashes of (depth, digest) along the prefix, so it can be
    computed in chunks: a running value inside a chunk and the chunks before it as a whole.
    """
    hashed = rebuilt.select(
        "*",
        F.shiftright(F.col("depth") - 1, CHUNK_BITS).alias("chunk"),
        *[F.xxhash64(F.lit(seed), "depth", "digest").alias(f"h{seed}") for seed in (1, 2)],
    )
    inside = Window.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = hashed.select("*", *[F.bit_xor(f"h{seed}").over(inside).alias(f"r{seed}") for seed in (1, 2)])
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = hashed.groupBy("conv", "chunk").agg(*[F.bit_xor(f"h{seed}").alias(f"w{seed}") for seed in (1, 2)])
    carried = whole.select("conv", "chunk", *[F.bit_xor(f"w{seed}").over(before).alias(f"c{seed}") for seed in (1, 2)]).where("chunk > 0")
    joined = running.join(carried, ["conv", "chunk"], "left")
    keys = [F.col(f"r{seed}").bitwiseXOR(F.coalesce(f"c{seed}", F.lit(0))) for seed in (1, 2)]
    parents = [key.bitwiseXOR(F.col(f"h{seed}")).alias(f"p{seed}") for seed, key in enumerate(keys, 1)]
    return joined.select("conv", "depth", "last", "digest", "words", keys[0].alias("k1"), keys[1].alias("k2"), *parents)


def hash_lists(members: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """(keys, ends_sha256): SHA-256 of the decimal ``conv`` of each key in ascending order, joined by commas.

    Up to 2**BUCKET_BITS neighbouring numbers become one text before the shuffle; a task then feeds the texts of
    a key to the hash one after the other, so it holds one batch of them whatever the key has.
    """
    texts = members.groupBy(*keys, F.shiftright("conv", BUCKET_BITS).alias("bucket")).agg(F.array_sort(F.collect_list("conv")).alias("own"))
    texts = texts.select(*keys, "bucket", F.array_join(F.col("own").cast("array<string>"), ",").alias("ids"))
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def rows(done: list) -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [[]] * (width + 1)
            arrays = [pa.array(column, pa.int64()) for column in columns[:-1]] + [pa.array(columns[-1], pa.string())]
            return pa.RecordBatch.from_arrays(arrays, [*keys, "ends_sha256"])

        for batch in batches:
            done = []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if row[:width] == key:
                    state.update(b",")
                else:
                    if state is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = row[:width], hashlib.sha256()
                state.update(row[-1].encode())
            yield rows(done)
        if state is not None:
            yield rows([(*key, state.hexdigest())])

    placed = texts.repartition(*keys).sortWithinPartitions(*keys, "bucket").select(*[F.col(key).cast("long") for key in keys], "ids")
    return placed.mapInArrow(run, ", ".join(f"{key} long" for key in keys) + ", ends_sha256 string")


def subtree_totals(tree: DataFrame, weights: Sequence[str]) -> DataFrame:
    """(node, weights): each node's own weights and those of all nodes below it, for a forest (node, parent, weights).

    Rounds of parallel tree contraction. Rake: every leaf is final and adds its total to its
    parent. Compress: of the nodes with a single child those whose drawn number is above that of parent and child,
    hence no two neighbours, leave their chain; their weights go to the parent and the child hangs there instead.
    A round removes all leaves and a share of every chain, so rows fall geometrically and a
    chain takes a number of rounds that is logarithmic in its length. Then the rounds are undone last first:
    a node that left a chain has its own weights of that time plus the total of its child. Sums per
    parent are combined before the shuffle, so a parent of very many children is no hot key. Links
    that form a ring raise an error.
    """
    sums = [F.sum(weight).alias(f"_{weight}") for weight in weights]
    grown = [(F.col(weight) + F.coalesce(f"_{weight}", F.lit(0))).alias(weight) for weight in weights]
    kids = tree.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("kids"))
    live = stored(tree.select("node", "parent", *weights).join(kids, "node", "left").fillna(0, ["kids"]), "live")
    rounds, rows = [], live.count()
    while rows:
        leaf = F.col("kids") == 0
        below = live.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            *[F.sum(F.when(leaf, F.col(weight))).alias(f"_{weight}") for weight in weights],
            F.count(F.when(~leaf, 1)).alias("kids"),
            F.min(F.when(~leaf, F.col("node"))).alias("child"),
        )
        raked = live.where(leaf).select("node", *weights)
        bare = stored(live.where(~leaf).drop("kids").join(below, "node").select("node", "parent", "kids", "child", *grown), "raked")
        drawn = [F.xxhash64(F.lit(len(rounds)), F.col(name)) for name in ("node", "parent", "child")]
        leaves_chain = (F.col("kids") == 1) & F.col("parent").isNotNull() & (drawn[0] > drawn[1]) & (drawn[0] > drawn[2])
        gone = bare.where(leaves_chain)
        up = gone.groupBy(F.col("parent").alias("node")).agg(*sums)
        down = gone.select(F.col("child").alias("node"), F.col("parent").alias("_parent"))
        stay = bare.where(F.coalesce(~leaves_chain, F.lit(True))).join(up, "node", "left").join(down, "node", "left")
        live = stored(stay.select("node", F.coalesce("_parent", "parent").alias("parent"), *grown, "kids"), "live")
        rounds.append((raked, gone.select("node", "child", *weights)))
        before, rows = rows, live.count()
        if rows == before:
            raise ValueError("the links form a ring")
    totals = None
    for raked, gone in reversed(rounds):
        if totals is None:
            totals = raked
            continue
        children = totals.select(F.col("node").alias("child"), *[F.col(weight).alias(f"_{weight}") for weight in weights])
        totals = stored(totals.union(raked).union(gone.join(children, "child").select("node", *grown)), "totals")
    return totals if totals is not None else live.select("node", *weights)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    Null role and text are empty; rows without conv_id belong to no conversation and are left out; a null turn comes
    first, and turns of one number are ordered by their content, so repeated rows are turns of their own. An empty
    table has no root. Other columns are ignored. Prefixes are told apart by 128 bits of key; that each
    key stands for one parent and one SHA-256 of role and text is checked while grouping, and a clash stops the job.
    """
    convs, rebuilt = rebuild(stored(numbered_turns(conversations), "turns"))
    keyed = stored(prefix_keys(rebuilt), "prefixes")
    one = F.min("digest").eqNullSafe(F.max("digest")) & (F.min("p1") == F.max("p1")) & (F.min("p2") == F.max("p2"))
    nodes = keyed.groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), one.alias("one")
    )
    checked = F.when(F.col("one"), F.col("conv_id")).otherwise(F.raise_error(F.lit("two prefixes share a key")).cast("long"))
    nodes = nodes.select(*KEY, checked.alias("conv_id"), "n_convs", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), "p1", "p2")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", zero.alias("saved"), none.alias("p1"), none.alias("p2"))
    nodes = stored(nodes.union(root).withColumn("node", F.monotonically_increasing_id()), "nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(above, ["depth", "p1", "p2"], "left")
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(kids, "node", "left").fillna(0, ["n_children"]), "nodes")
    leaf = (F.col("n_children") == 0).cast("long")
    totals = subtree_totals(nodes.select("node", "parent", leaf.alias("n_leaves"), F.col("saved").alias("saved_tokens")), ["n_leaves", "saved_tokens"])
    turnless = convs.where("size = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv")
    ends = hash_lists(keyed.where("last").select(*KEY, "conv").union(turnless))
    found = nodes.join(totals, "node").join(ends, list(KEY), "left")
    sha = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", sha)
