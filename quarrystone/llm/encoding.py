"""A whole corpus encoded with a public byte-level BPE vocabulary.

The texts of a task are cut into words; each distinct word is encoded once.
New words are visited in sorted order, which is the depth-first order of the
trie of their bytes: the states of the prefix shared with the word before are
still on the stack and are not computed again. The state of a prefix is its
last token. It is the longest token that ends the prefix and may follow the
last token of what is left without it, so every prefix needs only states
further up its own path, and a word of any length takes linear time.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

#: Where the rank file of byte_bpe_50k lies unless the caller says otherwise.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Distinct words a task remembers before it starts afresh; bounds its memory, changes no result.
REMEMBERED_WORDS = 400_000
REMEMBERED_PAIRS = 1_000_000
#: The pattern that cuts texts into words, and the same for texts of ASCII only.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ASCII_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"""

_words = regex.compile(WORDS).findall
_ascii_words = re.compile(ASCII_WORDS, re.ASCII).findall


class TrieEncoder:
    """Encodes distinct words by their trie; see the module's text."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.known: dict[tuple[int, int], bool] = {}
        # how each token comes about: the two tokens its bytes are merged from last
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1 and len(parts := self.merged(token, rank)) == 2:
                self.halves[rank] = (parts[0], parts[1])
                self.joined[parts[0], parts[1]] = rank
        # the longest token that ends in given two bytes bounds where a last token can start
        self.reach: dict[bytes, int] = {}
        for token in ranks:
            if len(token) > 1:
                self.reach[token[-2:]] = max(len(token), self.reach.get(token[-2:], 0))

    @classmethod
    def load(cls, path: str) -> TrieEncoder:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)})

    def merged(self, data: bytes, below: int = 1 << 60) -> list[int]:
        """Plain byte-pair merging of a few bytes, lowest rank first, with ranks under ``below``."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _follows(self, before: int, token: int) -> bool:
        """Whether the two tokens, side by side, are how their bytes are encoded.

        Merging must not cross the border between them. The merge made last
        on either side is undone step by step; while the two tokens at the
        border could be joined by a merge that comes before the one undone
        last, the border would not have stood.
        """
        first_left, first_right = 1 << 60, 1 << 60  # a join at the border must come before these to spoil it
        left, right = before, token
        while True:
            join = self.joined.get((left, right))
            if join is not None and join < first_left and join <= first_right:
                return False
            undo_left, undo_right = self.halves.get(left), self.halves.get(right)
            if undo_left is None and undo_right is None:
                return True
            if undo_right is None or (undo_left is not None and left > right):
                first_left = min(first_left, left)
                left = undo_left[1]
            else:
                first_right = min(first_right, right)
                right = undo_right[0]

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each of the sorted ``words``."""
        ranks, known, reach = self.ranks.get, self.known, self.reach.get
        last: list[int] = []  # of the prefix ending at each byte: its last token
        size: list[int] = []  # and that token's length
        out, previous = [], b""
        for word in words:
            n = len(word)
            shared = 0
            top = min(n, len(previous))
            while shared < top and word[shared] == previous[shared]:
                shared += 1
            del last[shared:], size[shared:]
            for end in range(shared + 1, n + 1):
                for start in range(max(0, end - reach(word[end - 2 : end], 1)) if end > 1 else 0, end):
                    token = ranks(word[start:end])
                    if token is None:
                        continue
                    if start:
                        pair = last[start - 1], token
                        fits = known.get(pair)
                        if fits is None:
                            if len(known) >= REMEMBERED_PAIRS:
                                known.clear()
                            fits = known[pair] = self._follows(*pair)
                        if not fits:
                            continue
                    last.append(token)
                    size.append(end - start)
                    break
            ids, end = [], n
            while end:
                ids.append(last[end - 1])
                end -= size[end - 1]
            ids.reverse()
            out.append(ids)
            previous = word
        return out


class _Index(dict):
    """Word -> place in the word table; unknown words get the next place."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        self.new.append(word)
        return place


class WordTable:
    """The encodings of the words met so far, as one Arrow list column."""

    def __init__(self, encoder: TrieEncoder):
        self.encoder = encoder
        self.clear()

    def clear(self) -> None:
        self.index = _Index()
        self.values, self.ends = [np.zeros(0, np.int32)], [np.zeros(1, np.int32)]
        self.lists = None

    def _grow(self) -> None:
        new, self.index.new = self.index.new, []
        data = [w.encode("utf-8", "surrogatepass") for w in new]
        order = sorted(range(len(data)), key=data.__getitem__)
        ids: list[list[int]] = [[]] * len(new)
        for i, found in zip(order, self.encoder.encode([data[i] for i in order])):
            ids[i] = found
        start = self.ends[-1][-1]
        self.values.append(np.fromiter(chain.from_iterable(ids), np.int32))
        self.ends.append(start + np.cumsum(np.fromiter(map(len, ids), np.int32, len(ids)), dtype=np.int32))
        self.values, self.ends = [np.concatenate(self.values)], [np.concatenate(self.ends)]
        self.lists = pa.ListArray.from_arrays(pa.array(self.ends[0]), pa.array(self.values[0]))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, pa.Array]:
        """(number of ids of each text, all ids one after another)."""
        if len(self.index) > REMEMBERED_WORDS:
            self.clear()
        place = self.index.__getitem__
        cut = [list(map(place, _ascii_words(t) if t.isascii() else _words(t))) if t else [] for t in texts]
        if self.index.new:
            self._grow()
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        words = np.fromiter(chain.from_iterable(cut), np.int64, int(counts.sum()))
        if not len(words):
            return counts, pa.array([], pa.int32())
        lengths = np.diff(self.ends[0])[words]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        return np.diff(ends[bounds]), pc.list_flatten(self.lists.take(pa.array(words)))


#: Per Python worker: the word table of each vocabulary, kept from task to task.
_TABLES: dict[str, WordTable] = {}


def word_table(path: str) -> WordTable:
    if path not in _TABLES:
        own = path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))
        _TABLES[path] = WordTable(TrieEncoder.load(own))
    return _TABLES[path]


def ship_vocabulary(spark: SparkSession, path: str) -> None:
    """Give the executors the rank file, for nodes that don't have it where the driver has."""
    if os.path.exists(path):
        spark.sparkContext.addFile(path)


def _slices(texts: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` characters, a longer text alone."""
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def encode_corpus(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids): the ids of every text, without special tokens.

    A null and an empty text have no ids: an empty list. Strings of special
    tokens are ordinary text. Texts of any length are encoded whole. One pass,
    no shuffle; repeated rows are encoded alike. An empty table stays empty.
    """
    ship_vocabulary(documents.sparkSession, vocabulary)
    rows = documents.select(key, F.col(text).cast("string").alias("_text"))
    schema = StructType([rows.schema[key], StructField("ids", ArrayType(IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table(vocabulary)
        for batch in batches:
            for start, end in _slices(batch.column("_text")):
                part = batch.slice(start, end - start)
                counts, ids = table.encode(part.column("_text").to_pylist())
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, ids)], names=[key, "ids"])

    return rows.mapInArrow(run, schema)


def count_tokens(documents: DataFrame, keep: list[str], text: str = "text", vocabulary: str = VOCABULARY, name: str = "n_tokens") -> DataFrame:
    """(keep, name): how many ids every text has; 0 for null and empty texts."""
    ship_vocabulary(documents.sparkSession, vocabulary)
    rows = documents.select(*keep, F.col(text).cast("string").alias("_text"))
    schema = StructType([*(rows.schema[k] for k in keep), StructField(name, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table(vocabulary)
        for batch in batches:
            for start, end in _slices(batch.column("_text")):
                part = batch.slice(start, end - start)
                counts, _ = table.encode(part.column("_text").to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), pa.array(counts)], names=[*keep, name])

    return rows.mapInArrow(run, schema)
