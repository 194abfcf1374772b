"""Packing token sequences: first-fit decreasing in randomised groups of documents."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.session import stored

LENGTH = 2048
END_ID = 1
GROUP_PIECES = 2048
KNOWN_WORDS = 400_000
TEXTS, CHARACTERS = 10_000, 2_000_000  # texts that are encoded at once, fewer if they have more characters
PIECES = 8192  # pieces that go through the tokenizer as one text
ODD_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f", "\x85")  # split by str.split(), but not all of them space to tokenizers
ROW_BITS = 40


def _strings(offsets: np.ndarray, data: pa.Buffer | None, kind: pa.DataType) -> pa.Array:
    """The parts of ``data`` between neighbouring offsets."""
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), data or pa.py_buffer(b"")])


def _offsets(strings: pa.Array) -> np.ndarray:
    return np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]


class WordIds:
    """Token ids of texts, as little-endian 32-bit bytes.

    The tokenizer never joins characters across white space, so the ids of a text are those of its
    words in turn. Arrow finds the distinct words of a group of texts and copies their ids to where they are. Letters, and
    letters with signs after them, are cut there, other words by the tokenizer's own pattern; pieces met before are
    looked up. New pieces go through the tokenizer together, past its steps that make pieces, and their ids are told apart by
    the mark that only the last token of a piece has. Words with letters beyond Latin-1, whose lower case
    need not be final, go through it one by one. Texts with control characters on which two
    definitions of white space differ, and those that hold the string of a special token, go through the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        layout = json.loads(self.tokenizer.to_str())
        self.whole = (*ODD_SPACE, *(token["content"] for token in layout["added_tokens"]))
        self.pieces = regex.compile(layout["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.signs = "".join(filter(regex.compile(r"[^\s\p{L}\p{N}]").match, map(chr, range(256))))
        self.steps = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.at_spaces = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(False, use_regex=False)])
        mark, vocabulary = layout["model"]["end_of_word_suffix"], self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[number for token, number in vocabulary.items() if token.endswith(mark)]] = True
        self.known, self.known_ids = pa.array([""], pa.large_string()), pa.array([b""], pa.large_binary())

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; the new words of all are learnt together."""
        whole = [any(mark in text for mark in self.whole) for text in texts]
        cut = pc.utf8_split_whitespace(pa.array(["" if odd else text for text, odd in zip(texts, whole)], pa.large_string()))
        found = cut.flatten().dictionary_encode()
        ids = self.word_ids(found.dictionary).take(found.indices)
        ends, data = _offsets(ids)[cut.offsets.to_numpy()].tolist(), memoryview(ids.buffers()[2] or b"")
        return [self.encode_whole(text) if odd else bytes(data[start:end]) for text, odd, start, end in zip(texts, whole, ends, ends[1:])]

    def encode_each(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of texts, null ones as empty, in groups of TEXTS that end at the text that passes CHARACTERS; Arrow gives
        back what a group took before the next one."""
        held, size = [], 0
        for text in texts:
            held.append(text.as_py() or "")
            size += len(held[-1])
            if len(held) == TEXTS or size > CHARACTERS:
                yield from self.encode_all(held)
                held, size = [], 0
                pa.default_memory_pool().release_unused()
        if held:
            yield from self.encode_all(held)

    def encode_whole(self, text: str) -> bytes:
        return b"".join(map(_four_bytes, self.tokenizer.encode(text, add_special_tokens=False).ids))

    def word_ids(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words; an empty one, beside space at the start or end of a text, has none."""
        latin = pc.match_substring_regex(words, r"^[\x{0}-\x{ff}]*$")
        low = pc.utf8_lower(words)
        letters = pc.utf8_rtrim(low, self.signs)
        plain = pc.and_(latin, pc.utf8_is_alpha(letters))
        other, foreign = pc.and_not(latin, plain), pc.invert(latin)
        low_plain, cuts = low.filter(plain), [self.pieces.findall(word) for word in low.filter(other).to_pylist()]
        starts = _offsets(low_plain)
        middle = starts[:-1] + pc.binary_length(letters.filter(plain)).to_numpy()
        borders = np.r_[np.stack([starts[:-1], middle], axis=1).ravel(), starts[-1:]]
        both = _strings(borders, low_plain.buffers()[2], pa.large_string())  # letters and signs of each word in turn
        ids = self.piece_ids(pa.concat_arrays([both, pa.array([part for parts in cuts for part in parts], pa.large_string())]))
        parts = np.r_[np.full(len(low_plain), 2), np.array([len(parts) for parts in cuts], np.int64)]
        ids = _strings(_offsets(ids)[np.r_[0, np.cumsum(parts)]], ids.buffers()[2], pa.large_binary())
        alone = self.tokenizer.encode_batch_fast(words.filter(foreign).to_pylist(), add_special_tokens=False)
        ids = pa.concat_arrays([ids, pa.array([np.array(one.ids, "<u4").tobytes() for one in alone], pa.large_binary())])
        order = np.concatenate([np.flatnonzero(kind.to_numpy(zero_copy_only=False)) for kind in (plain, other, foreign)])
        return ids.take(pa.array(np.argsort(order)))

    def piece_ids(self, pieces: pa.Array) -> pa.Array:
        """Ids of pieces, which are known after it; over KNOWN_WORDS those that are not among them are forgotten."""
        found = pa.concat_arrays([pieces, pa.array([""], pa.large_string())]).dictionary_encode()
        place = pc.index_in(found.dictionary, value_set=self.known)
        new = found.dictionary.filter(pc.is_null(place))
        known, ids = pa.concat_arrays([self.known, new]), pa.concat_arrays([self.known_ids, *self.learn_pieces(new)])
        place = place.to_numpy(zero_copy_only=False).copy()
        place[np.isnan(place)] = np.arange(len(self.known), len(known))
        own = ids.take(pa.array(place.astype(np.int64)))
        self.known, self.known_ids = (known, ids) if len(known) <= KNOWN_WORDS else (found.dictionary, own)
        return own.take(found.indices.slice(0, len(pieces)))

    def learn_pieces(self, pieces: pa.Array) -> Iterator[pa.Array]:
        for at in range(0, len(pieces), PIECES):
            some = pieces.slice(at, PIECES)
            self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = None, self.at_spaces
            try:
                ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some.to_pylist())], add_special_tokens=False)[0].ids, "<u4")
            finally:
                self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.steps
            ends = 4 * (np.flatnonzero(self.last[ids]) + 1)
            if len(ends) != len(some):
                raise ValueError("the tokenizer does not mark the end of each piece")
            yield _strings(np.r_[0, ends], pa.py_buffer(ids.tobytes()), pa.large_binary())


def _four_bytes(number: int) -> bytes:
    return number.to_bytes(4, "little")


_ENCODERS: dict[str, WordIds] = {}


def cut_pieces(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, rid): each document, with the end id, in pieces
    of ``length`` tokens and a last one of what remains. ``rid`` numbers the documents."""
    end = _four_bytes(end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.setdefault(tokenizer_path, None) or WordIds(tokenizer_path)
        _ENCODERS[tokenizer_path] = encoder
        rid = TaskContext.get().partitionId() << ROW_BITS
        for batch in batches:
            out = []
            for doc, found in zip(batch.column(0).to_pylist(), encoder.encode_each(batch.column(1))):
                ids = found + end
                total = len(ids) // 4
                for start in range(0, total, length):
                    piece = ids[4 * start : 4 * (start + length)]
                    out.append((doc, start, len(piece) // 4, zlib.crc32(piece), total, rid))
                rid += 1
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "rid"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 6)], names)
        batch = None
        pa.default_memory_pool().release_unused()  # the worker lives on

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, rid long")


def first_fit_decreasing(lengths: Sequence[int], capacity: int = LENGTH) -> tuple[list[int], list[int]]:
    """(bin, offset) per item, the longest placed first, each in the first bin with room.

    The free room of the bins is in the leaves of a tournament tree whose inner nodes hold the
    greatest room below, so the first bin is found by going down left wherever there is room.
    """
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    for item in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        need, node = lengths[item], 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        bins[item], offsets[item] = node - leaves, capacity - room[node]
        room[node] -= need
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins, offsets


def pack_documents(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, group_pieces: int = GROUP_PIECES, seed: int = 5) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row of ``docs`` is a document of its own, repeated rows too. Null and empty texts are the
    end id alone. Documents are cut at multiples of ``length``; pieces go to random groups of about
    ``group_pieces``, and each group is packed on its own, so no task grows with the input. Only
    lengths and checksums are shuffled, never ids. A document longer than a group is spread over
    groups. An empty table gives no rows; other columns are ignored.
    """
    pieces = stored(cut_pieces(docs, tokenizer_path, length), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["rid", "start"], ignore_index=True)
        bins, offsets = first_fit_decreasing(group["length"].tolist(), length)
        return group.assign(sequence_id=[(key[0] << 32) + at for at in bins], offset=offsets).drop(columns=["rid", "group"])

    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("rid", "start", F.lit(seed)), F.lit(groups)))
    layout = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return dealt.groupBy("group").applyInPandas(pack, layout)
