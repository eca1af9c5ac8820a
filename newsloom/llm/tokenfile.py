"""Token-id files: one array of ids, with Elias-Fano coded document boundaries.

A file is a row of numbered segments; a segment is a run of documents in ascending id order:

    magic ``EFTK0001``; then as unsigned 64-bit integers: documents, ids, smallest document id,
    largest document id less the smallest, number of documents without an id (these come first);
    boundaries as an Elias-Fano sequence of the ends of all documents;
    document ids as an Elias-Fano sequence, less the smallest;
    the ids of all documents, as unsigned 32-bit integers. All numbers are little-endian.

An Elias-Fano sequence of n numbers up to u keeps the low ``floor(log2(u / n))`` bits of each
number packed, and the high bits in unary: a one at place ``high(i) + i``. ``select(i)``, the place
of the i-th one, gives back the high part: a search among the counts of ones up to each byte, then a
table of the places in a byte. This takes about 2 + log2(u / n) bits for each document instead of 64.

Segments are the rows of a Parquet table, so Spark's committer makes the file whole or not at all
when executors are lost, and any storage that Spark reaches can hold it. Documents are dealt by range of
id, sorted within each range and packed in the same task; a task holds one segment, about
``SEGMENT_IDS`` ids and one document more.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import BinaryType, LongType, StructType

from .common import Generations, worker_model

MAGIC = b"EFTK0001"
SEGMENT_IDS = 1 << 21
#: Places of up to this many segments (three numbers each) are sent to all executors.
BROADCAST_SEGMENTS = 1 << 20
#: Pieces of a generation of the table, and their longest.
CACHED = 400_000
LONGEST_CACHED = 64
#: Characters encoded together, and the longest text taken in one part.
SLICE_CHARS = 4 << 20
PART_CHARS = 1 << 20
_HEAD = struct.Struct("<8s5Q")
_SEQUENCE = struct.Struct("<4Q")


# --- Elias-Fano ------------------------------------------------------------------------------------

#: For each byte and k: the place of its k-th one.
_IN_BYTE = np.array([[places[k] if k < len(places) else 0 for k in range(8)] for places in (
    [bit for bit in range(8) if byte >> bit & 1] for byte in range(256))], np.uint8)


class EliasFano:
    """A non-decreasing sequence of unsigned numbers."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        self._bits = np.frombuffer(high, np.uint8)
        self._upto = np.cumsum(np.bitwise_count(self._bits), dtype=np.uint32)  # ones up to each byte
        self._low = np.frombuffer(low + bytes(16), np.uint8)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"")
        values = values.astype(np.uint64)
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        high = np.zeros(((int(values[-1]) >> low_bits) + n + 7) // 8 * 8, np.uint8)
        high[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        return cls(n, low_bits, np.packbits(low, bitorder="little").tobytes(),
                   np.packbits(high, bitorder="little").tobytes())

    def to_bytes(self) -> bytes:
        return _SEQUENCE.pack(self.n, self.low_bits, len(self.low), len(self.high)) + self.low + self.high

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        n, low_bits, low, high = _SEQUENCE.unpack_from(data, at)
        at += _SEQUENCE.size
        return cls(n, low_bits, bytes(data[at:at + low]), bytes(data[at + low:at + low + high])), at + low + high

    def select(self, i: np.ndarray) -> np.ndarray:
        """The places of the i-th ones among the high bits, counted from 0."""
        byte = np.searchsorted(self._upto, i, side="right")
        before = np.where(byte > 0, self._upto[byte - 1], 0)
        return 8 * byte + _IN_BYTE[self._bits[byte], i - before]

    def _low_of(self, i: np.ndarray) -> np.ndarray:
        """The low bits of the i-th numbers, from the nine bytes that can hold them."""
        start = i.astype(np.int64) * self.low_bits
        first, shift = start >> 3, (start & 7).astype(np.uint64)
        low = np.zeros(len(i), np.uint64)
        for k in range(8):
            low |= self._low[first + k].astype(np.uint64) << np.uint64(8 * k)
        last = self._low[first + 8].astype(np.uint64) << np.uint64(1)
        return ((low >> shift) | (last << (np.uint64(63) - shift))) & np.uint64((1 << self.low_bits) - 1)

    def get(self, i) -> np.ndarray:
        """The numbers at the places ``i``, by select."""
        i = np.atleast_1d(np.asarray(i, np.int64))
        if len(i) and not (0 <= i.min() and i.max() < self.n):
            raise IndexError(i)
        if not len(i):
            return np.zeros(0, np.uint64)
        high = (self.select(i) - i).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self._low_of(i) if self.low_bits else high

    def __getitem__(self, i: int) -> int:
        return int(self.get(i)[0])


# --- segments --------------------------------------------------------------------------------------

def pack_segment(doc_ids: list[int | None], documents: list[bytes]) -> bytes:
    """A segment of documents in ascending id order, those without an id first."""
    nulls = sum(d is None for d in doc_ids)
    known = doc_ids[nulls:]
    first = known[0] if known else 0
    ends = np.cumsum([len(d) // 4 for d in documents], dtype=np.int64)
    ids = b"".join(documents)
    span = known[-1] - first if known else 0
    return b"".join((
        _HEAD.pack(MAGIC, len(documents), len(ids) // 4, first & (1 << 64) - 1, span, nulls),
        EliasFano.of(ends).to_bytes(),
        EliasFano.of(np.array([d - first for d in known], np.uint64)).to_bytes(), ids))


@dataclass
class Segment:
    """A segment read back; ``document(i)`` needs two selects and reads nothing else."""

    nulls: int
    first: int
    ends: EliasFano
    doc_ids: EliasFano
    ids: memoryview

    @classmethod
    def read(cls, data: bytes) -> Segment:
        view = memoryview(data)
        magic, _, n_ids, first, _, nulls = _HEAD.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a segment of token ids")
        ends, at = EliasFano.read(view, _HEAD.size)
        doc_ids, at = EliasFano.read(view, at)
        return cls(nulls, first - (1 << 64) if first >> 63 else first, ends, doc_ids, view[at:at + 4 * n_ids])

    def bounds(self, i) -> tuple[np.ndarray, np.ndarray]:
        """Where the i-th documents start and end."""
        i = np.atleast_1d(np.asarray(i, np.int64))
        starts = np.zeros(len(i), np.int64)
        starts[i > 0] = self.ends.get(i[i > 0] - 1).astype(np.int64)
        return starts, self.ends.get(i).astype(np.int64)

    def document(self, i: int) -> np.ndarray:
        (start,), (end,) = self.bounds(i)
        return np.frombuffer(self.ids[4 * start:4 * end], "<u4")

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.first + self.doc_ids[i - self.nulls]


# --- encoding --------------------------------------------------------------------------------------

# How a definition looks that drops white space, cuts lower-cased text into pieces that
# do not affect each other, and marks the last token of each piece.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_CUT = [{"type": "Split", "pattern": {"Regex": _PIECES}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
# Characters whose case, composition and class are the same for every Unicode version, and the pieces
# of text that has no others, in lower case.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7EÀ-ÖØ-öø-ÿŒœ¡¿«»“”‘’„–—…€]*")
_PLAIN_PIECES = r"[a-zß-öø-ÿœ]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\t\n\r 0-9a-zß-öø-ÿœ]+"
_SPACE = re.compile(r"[\t\n\r ]")


def cuts_into_pieces(definition: str) -> bool:
    """Whether a tokenizer works as the fixed values above say; only then are ids of pieces put together."""
    parts = json.loads(definition)
    normalizer, cut = (parts.get(key) or {} for key in ("normalizer", "pre_tokenizer"))
    return (normalizer.get("normalizers") == _NORMALIZER and cut.get("pretokenizers") == _CUT
            and bool(parts["model"].get("end_of_word_suffix")) and not parts.get("post_processor"))


class WordEncoder:
    """The tokenizers library over the pieces of texts.

    Each worker keeps the ids of pieces it has met and hands new ones to the library, many together.
    Where one ends is seen from its last token, which has the suffix of word ends. Texts with
    other characters than ``_PLAIN``, and all texts if the tokenizer does not cut into pieces, go to the
    library whole.
    """

    def __init__(self, definition: str, end_id: int):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        self.pieces = cuts_into_pieces(definition)
        self.end = struct.pack("<I", end_id)
        self.known = Generations(CACHED)
        if self.pieces:
            suffix = json.loads(definition)["model"]["end_of_word_suffix"]
            vocabulary = self.tokenizer.get_vocab()
            self.is_last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.is_last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        for at in range(0, len(pieces), 20_000):
            lines = [pieces[i:i + 200] for i in range(at, min(at + 20_000, len(pieces)), 200)]
            for line, found in zip(lines, self._whole([" ".join(line) for line in lines])):
                stops = (4 * np.flatnonzero(self.is_last[np.frombuffer(found, "<u4")]) + 4).tolist()
                if len(stops) == len(line) and stops[-1] == len(found):
                    ids = [found[a:b] for a, b in zip([0, *stops], stops)]
                else:  # a piece without a last token
                    ids = self._whole(line)
                self.known.young.update(zip(line, ids))

    def _by_pieces(self, texts: list[str]) -> list[bytes]:
        """The ids of lower-cased texts without other characters than ``_PLAIN``. Pieces are told apart with
        Arrow and looked up once for all of the texts; what is new goes to the library together."""
        spaced = pc.replace_substring_regex(pa.array(texts, pa.string()), pattern=_PLAIN_PIECES, replacement=r"\0 ")
        split = pc.ascii_split_whitespace(spaced)
        coded = split.flatten().dictionary_encode()
        self.known.turn()
        young, pieces = self.known.young, coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        fresh = [p for p in pieces if p and p not in young]
        self._learn(self.known.recall(fresh))
        ids = [young[p] if p else b"" for p in pieces]
        for piece in fresh:
            if len(piece) > LONGEST_CACHED:
                del young[piece]
        # the ids of all pieces, and where those of each occurrence lie among them
        pool, lengths = np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        codes = coded.indices.to_numpy()
        counts = lengths[codes]
        upto = np.concatenate(([0], np.cumsum(counts)))
        start = (np.cumsum(lengths) - lengths)[codes] - upto[:-1]
        found = pool[np.repeat(start, counts) + np.arange(upto[-1])].tobytes()
        ends = (4 * upto[split.offsets.to_numpy()]).tolist()
        return [found[i:j] for i, j in zip(ends, ends[1:])]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text with the end id, as little-endian unsigned 32-bit integers."""
        if not self.pieces:
            return [ids + self.end for ids in self._whole([t or "" for t in texts])]
        plain = [bool(t and _PLAIN.fullmatch(t)) for t in texts]
        short = iter(self._by_pieces([t.lower() for t, p in zip(texts, plain) if p and len(t) <= PART_CHARS]))
        out = []
        for text, is_plain in zip(texts, plain):
            if not text:
                ids = b""
            elif not is_plain:
                ids = self._whole([text])[0]
            elif len(text) <= PART_CHARS:
                ids = next(short)
            else:
                ids = b"".join(self._by_pieces([part])[0] for part in _parts(text.lower()))
            out.append(ids + self.end)
        return out


def _parts(text: str) -> Iterator[str]:
    """A text in parts of about ``PART_CHARS`` characters, cut at white space."""
    at = 0
    while len(text) - at > PART_CHARS:
        cut = _SPACE.search(text, at + PART_CHARS)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def write_token_file(docs: DataFrame, path: str, definition: str, end_id: int, text: str = "text",
                     id_col: str = "doc_id", segment_ids: int = SEGMENT_IDS) -> None:
    """Encode every whole text, add ``end_id`` to each, and write them in ascending id order.

    Null and empty texts have the end id only; rows without an id come first; rows with equal ids
    follow each other in the order of a hash of their texts, then the texts. ``definition`` is the
    tokenizer's JSON; strings of special tokens in a text are ordinary text. Ranges are cut on ids and
    hashes, so no text is sampled to the driver.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches):
        encoder = worker_model(shared.value, lambda value: WordEncoder(value, end_id))
        doc_ids, documents, held, no = [], [], 0, 0
        for batch in batches:
            new_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for some, some_texts in _slices(new_ids, texts):
                for doc_id, ids in zip(some, encoder.encode_all(some_texts)):
                    if held and held + len(ids) > 4 * segment_ids:
                        yield _row(no, doc_ids, documents)
                        doc_ids, documents, held, no = [], [], 0, no + 1
                    doc_ids.append(doc_id)
                    documents.append(ids)
                    held += len(ids)
        if documents:
            yield _row(no, doc_ids, documents)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.xxhash64(text).alias("hash"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash").asc()]
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order, "text").select("doc_id", "text")
    numbered = ordered.mapInArrow(run, "no long, n_ids long, segment binary")
    part = F.spark_partition_id().cast("long").alias("part")
    numbered.select(part, "no", "n_ids", "segment").write.option("compression", "zstd").parquet(path)


def _slices(doc_ids: list, texts: list[str | None]) -> Iterator[tuple[list, list]]:
    """Ids and texts in slices of about ``SLICE_CHARS`` characters."""
    start = held = 0
    for at, text in enumerate(texts, 1):
        held += len(text or "")
        if held >= SLICE_CHARS or at == len(texts):
            yield doc_ids[start:at], texts[start:at]
            start, held = at, 0


def _row(no: int, doc_ids: list, documents: list[bytes]) -> pa.RecordBatch:
    n_ids = sum(map(len, documents)) // 4
    return pa.RecordBatch.from_arrays(
        [pa.array([no]), pa.array([n_ids]), pa.array([pack_segment(doc_ids, documents)], pa.binary())],
        ["no", "n_ids", "segment"])


def read_token_file(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, and its ids if asked for.

    ``start`` counts the ids of all documents before. Places of segments are summed over one number
    per segment; documents are never counted through one task. The segments meet their places where
    they are stored while these are few enough to send, else through a shuffle.
    """
    file = spark.read.parquet(path)
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = file.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    within = W.partitionBy("part").orderBy("no").rowsBetween(W.unboundedPreceding, -1)
    places = file.select("part", "no", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("at"))
    places = places.join(parts, "part").select("part", "no", (F.col("at") + F.col("part_start")).alias("at"))
    if file.count() <= BROADCAST_SEGMENTS:
        places = F.broadcast(places)
    schema = StructType().add("doc_id", LongType()).add("start", LongType()).add("n_tokens", LongType()) \
        .add("ids_crc32", LongType())
    if with_ids:
        schema = schema.add("ids", BinaryType())

    def run(batches):
        for batch in batches:
            for base, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                segment = Segment.read(data.as_py())
                starts, ends = segment.bounds(np.arange(segment.ends.n))
                known = segment.doc_ids.get(np.arange(segment.doc_ids.n)).astype(np.int64) + segment.first
                doc_ids = pa.concat_arrays([pa.nulls(segment.nulls, pa.int64()), pa.array(known, pa.int64())])
                slices = [segment.ids[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                made = [doc_ids, pa.array(starts + base, pa.int64()),
                        pa.array(ends - starts, pa.int64()), pa.array([zlib.crc32(s) for s in slices], pa.int64())]
                if with_ids:
                    made.append(pa.array([bytes(s) for s in slices], pa.binary()))
                yield pa.RecordBatch.from_arrays(made, schema.names)

    return file.join(places, ["part", "no"]).select("at", "segment").mapInArrow(run, schema)
