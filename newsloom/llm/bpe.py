"""Byte-level BPE: encoding by merge ranks, and decoding.

A text is cut by the tokenizer's pattern, and each match is encoded by itself: if its bytes are a
token they become that token, else adjacent parts with the smallest merge rank are joined, leftmost
first, until no pair has a rank. A segment tree over the byte positions of the match holds, for
each range, the smallest pair rank and its leftmost position. A merge takes the pair at the root
and updates the three leaves it changes (the pair itself, the part after it, the part before it),
each in logarithmic time, so a match of n bytes takes n log n steps, however long it is.

Each Python worker keeps the ids of matches it has met, in tables of bounded size. The only other
state is the vocabulary, sent to the executors once; its size is fixed.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

from .common import worker_model

#: Entries of a generation of a table, and the longest text kept there.
CACHED = 250_000
LONGEST_CACHED = 64
# Fixed value: a pattern that starts a new match at every space with a non-space on at least one side.
SPACED_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_NONE = 1 << 62
_SPACE_WITHIN_SPACES = re.compile(r"\s \s").search


def read_ranks(path: str) -> dict[bytes, int]:
    """Merge ranks from a file with one base-64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encode_match(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one match of the pattern."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    leaves = 1 << (n - 2).bit_length() if n > 2 else 1
    shift = n.bit_length()
    # a key is rank << shift | position: the smallest key is the leftmost smallest rank
    tree = [_NONE] * (2 * leaves)
    rank_of = ranks.get
    for i in range(n - 1):
        rank = rank_of(piece[i:i + 2])
        if rank is not None:
            tree[leaves + i] = rank << shift | i
    for node in range(leaves - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b
    after = list(range(1, n + 1))  # where the part that starts here ends
    before = list(range(-1, n))    # where the part before the one that starts here starts
    mask = (1 << shift) - 1

    while tree[1] != _NONE:
        i = tree[1] & mask
        j = after[i]
        end = after[j]
        after[i] = end
        before[end] = i
        rank = rank_of(piece[i:after[end]]) if end < n else None
        changed = [(leaves + i, _NONE if rank is None else rank << shift | i)]
        if j < n - 1:
            changed.append((leaves + j, _NONE))
        if i:
            h = before[i]
            rank = rank_of(piece[h:end])
            changed.append((leaves + h, _NONE if rank is None else rank << shift | h))
        for node, key in changed:
            if tree[node] == key:
                continue
            tree[node] = key
            while node > 1:
                other = tree[node ^ 1]
                if other < key:
                    key = other
                node >>= 1
                if tree[node] == key:
                    break
                tree[node] = key
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:after[i]]])
        i = after[i]
    return ids


class _Found(dict):
    """A table that finds a value when it is first asked for. When full it becomes the older generation,
    whose entries are forgotten unless they are met again before the next one is full."""

    def __init__(self, find, keeps):
        super().__init__()
        self.find, self.keeps, self.old = find, keeps, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.find(key)
        if self.keeps(key):
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class Codec:
    """Encoder and decoder of one vocabulary and pattern.

    With ``SPACED_PATTERN`` texts are cut at single spaces first, and the ids of what stands between two
    of them are kept too; with any other pattern only those of its matches.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = regex.compile(pattern).findall
        self.spaced = pattern == SPACED_PATTERN
        self.match = _Found(
            lambda m: np.array(encode_match(m.encode("utf-8", "replace"), ranks), "<u4").tobytes(),
            lambda m: len(m) <= LONGEST_CACHED)
        self.after_space = _Found(lambda part: self._matches(" " + part),
                                  lambda part: len(part) <= LONGEST_CACHED and "\n" not in part)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def _matches(self, text: str) -> bytes:
        return b"".join(map(self.match.__getitem__, self.split(text)))

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers; null counts as empty."""
        if not text:
            return b""
        if not self.spaced or _SPACE_WITHIN_SPACES(text):
            return self._matches(text)
        first, *rest = text.split(" ")
        return self._matches(first) + b"".join(map(self.after_space.__getitem__, rest))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _codec(shared, pattern: str) -> Codec:
    """The worker's codec, kept between tasks."""
    return worker_model(shared.value, lambda ranks: Codec(ranks, pattern))


def share_ranks(spark: SparkSession, ranks: dict[bytes, int]):
    """The vocabulary for the executors; it has a fixed size, whatever the data."""
    return spark.sparkContext.broadcast(ranks)


_RESULT = StructType().add("ids", BinaryType()).add("n_tokens", LongType()) \
    .add("ids_sha256", StringType()).add("decoded_sha256", StringType())


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text",
           id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """``id_col``, the ``ids`` of the whole text, their number ``n_tokens``, ``ids_sha256`` of the ids
    as little-endian unsigned 32-bit integers and ``decoded_sha256`` of what they decode to.

    One row per row of ``docs``, in one pass without a shuffle. Null and empty texts have no ids.
    Other columns of ``docs`` are left out, so their names do not matter.
    """
    shared = share_ranks(docs.sparkSession, ranks)
    rows = docs.select(F.col(id_col), F.col(text).alias("_text"))
    fields = [f for f in _RESULT if with_ids or f.name != "ids"]
    schema = StructType([rows.schema[0], *fields])

    def run(batches):
        codec = _codec(shared, pattern)
        for batch in batches:
            found = {f.name: [] for f in _RESULT}
            for text_ in batch.column(1).to_pylist():
                ids = codec.encode(text_)
                found["ids"].append(ids)
                found["n_tokens"].append(len(ids) // 4)
                found["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                found["decoded_sha256"].append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(found[f.name], {"ids": pa.binary(), "n_tokens": pa.int64()}
                                             .get(f.name, pa.string())) for f in fields]],
                [f.name for f in schema])

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """Add ``text`` to rows of ids; bytes that are no UTF-8 become replacement characters."""
    shared = share_ranks(encoded.sparkSession, ranks)
    plain = encoded.drop("text")
    schema = StructType([*plain.schema.fields]).add("text", StringType())
    at = plain.columns.index(ids)

    def run(batches):
        codec = _codec(shared, "")
        for batch in batches:
            texts = [None if x is None else codec.decode(x).decode("utf-8", "replace")
                     for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             [f.name for f in schema])

    return plain.mapInArrow(run, schema)
