"""Fill-in-middle: texts cut at two random places and put together in another order.

The places where a text may be cut are a set of byte offsets, kept as compressed containers: the
offsets of each 65,536 bytes are one container, an array of 16-bit numbers, a bitmap or a list of
runs, whichever is smallest. Beside them stand the cumulative cardinalities, so the i-th place is
found by a binary search for its container and a select inside it. Plain ASCII is one run for each
container. A text is read one container at a time; no table of all its offsets is ever made.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

CHUNK = 1 << 16
SENTINELS = ("<P>", "<S>", "<M>")
#: Bytes of output handed back at once.
PIECE_BYTES = 8 << 20


# --- the set of boundaries -------------------------------------------------------------------------

class ArrayContainer:
    """The places themselves, 2 bytes each."""

    def __init__(self, places: np.ndarray):
        self.places = places.astype("<u2")

    def select(self, i: int) -> int:
        return int(self.places[i])


class BitmapContainer:
    """One bit per byte of text, and how many are set before each 64-bit word."""

    def __init__(self, mask: np.ndarray):
        bits = np.zeros(CHUNK, bool)
        bits[:len(mask)] = mask
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype="<u4")[:-1]))

    def select(self, i: int) -> int:
        at = int(np.searchsorted(self.before, i, side="right")) - 1
        word = int(self.words[at])
        for _ in range(i - int(self.before[at])):
            word &= word - 1
        return 64 * at + (word & -word).bit_length() - 1


class RunContainer:
    """First places of runs of neighbours, and how many places lie before each run."""

    def __init__(self, starts: np.ndarray, before: np.ndarray):
        self.starts, self.before = starts.astype("<u2"), before.astype("<u4")

    def select(self, i: int) -> int:
        run = int(np.searchsorted(self.before, i, side="right")) - 1
        return int(self.starts[run]) + i - int(self.before[run])


def container(mask: np.ndarray, count: int):
    """The smallest container for the places that ``mask`` marks within one chunk."""
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    runs = (len(edge) + 1 + bool(mask[0])) // 2
    if min(4 * runs, 2 * count) >= CHUNK // 8:
        return BitmapContainer(mask)
    if 4 * runs >= 2 * count:
        return ArrayContainer(np.flatnonzero(mask))
    edges = np.concatenate(([0], edge)) if mask[0] else edge
    starts, stops = edges[::2], edges[1::2]
    lengths = np.append(stops, len(mask))[:len(starts)] - starts
    return RunContainer(starts, np.cumsum(lengths) - lengths)


class BoundarySet:
    """Byte offsets in ascending order; ``select(i)`` is the i-th of them, counted from 0."""

    def __init__(self):
        self.keys, self.containers, self.before, self.size = [], [], [], 0

    def add(self, key: int, mask: np.ndarray) -> None:
        """The places ``key * 65536 + i`` for which ``mask[i]`` holds; keys come in ascending order."""
        if count := int(np.count_nonzero(mask)):
            self.keys.append(key)
            self.containers.append(container(mask, count))
            self.before.append(self.size)
            self.size += count

    def select(self, i: int) -> int:
        if not 0 <= i < self.size:
            raise IndexError(i)
        at = bisect_right(self.before, i) - 1
        return self.keys[at] * CHUNK + self.containers[at].select(i - self.before[at])


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _starts(data: np.ndarray, before: int, units: str) -> np.ndarray:
    """Where units start in a chunk; ``before`` is the byte in front of it."""
    if units == "chars":
        return (data & 0xC0) != 0x80
    last = np.concatenate(([before], data[:-1])).astype(np.uint8)
    if units == "words":
        return _SPACE[data] & ~_SPACE[last]
    if units == "lines":
        return last == 0x0A
    raise ValueError(f"units are chars, words or lines, not {units}")


def boundaries(text: bytes, units: str = "chars") -> BoundarySet:
    """Where a text may be cut: the start of every unit and the end of the text.

    ``chars`` are code points; a unit of ``words`` is a word with the white space before it (white space
    at the end is a unit of its own); ``lines`` end with their line break. The units of a text always
    add up to the text, and a text of n units has n + 1 boundaries.
    """
    data, found = np.frombuffer(text, np.uint8), BoundarySet()
    for at in range(0, len(data) + 1, CHUNK):
        part = data[at:at + CHUNK]
        mask = np.ones(min(CHUNK, len(data) + 1 - at), bool)  # the end of the text counts
        mask[:len(part)] = _starts(part, int(data[at - 1]) if at else 0x20, units)
        mask[0] |= not at
        found.add(at // CHUNK, mask)
    return found


# --- the transformation ----------------------------------------------------------------------------

def draws(doc_id, seed: int) -> list[int]:
    """The numbers h1 to h4 of a document: the first four groups of eight hexadecimal digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4)]


_RESULT = StructType().add("n", LongType()).add("form", StringType()).add("prefix_units", LongType()) \
    .add("middle_units", LongType()).add("prefix_bytes", LongType()).add("middle_bytes", LongType()) \
    .add("output", BinaryType())
_ARROW = {"n": pa.int64(), "form": pa.string(), "prefix_units": pa.int64(), "middle_units": pa.int64(),
          "prefix_bytes": pa.int64(), "middle_bytes": pa.int64(), "output": pa.binary()}


def rearrange(text: bytes, doc_id, seed: int, fim_percent: int, spm_percent: int, sentinels: tuple[bytes, ...],
              units: str) -> tuple:
    """One text: ``n, form, prefix_units, middle_units, prefix_bytes, middle_bytes, output``."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    places = boundaries(text, units)
    n = places.size - 1
    if not text or any(s in text for s in sentinels) or h3 % 100 >= fim_percent:
        return n, "plain", None, None, None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    start, stop = places.select(first), places.select(second)
    prefix, middle, suffix = text[:start], text[start:stop], text[stop:]
    p, s, m = sentinels
    if h4 % 100 < spm_percent:
        form, output = "spm", b"".join((s, suffix, p, prefix, m, middle))
    else:
        form, output = "psm", b"".join((p, prefix, s, suffix, m, middle))
    return n, form, first, second - first, start, stop - start, output


def transform(docs: DataFrame, seed: int = 1, fim_percent: int = 90, spm_percent: int = 20,
              sentinels: tuple[str, str, str] = SENTINELS, units: str = "chars", text: str = "text",
              id_col: str = "doc_id") -> DataFrame:
    """``id_col``, the number of units ``n``, ``form`` (plain, psm or spm), the units and bytes of prefix
    and middle (null if plain) and the ``output`` text.

    One row per row of ``docs``, in one pass without a shuffle; equal rows give equal results, on every
    run, as all that is random comes from the id and the seed. Null texts count as empty; empty texts
    and those that hold a sentinel stay plain. A null id draws like an empty one. Other columns of
    ``docs`` are left out, so their names do not matter.
    """
    rows = docs.select(F.col(id_col), F.col(text).cast("binary").alias("_text"))
    schema = StructType([rows.schema[0], *_RESULT])
    marks = tuple(s.encode() for s in sentinels)

    def run(batches):
        for batch in batches:
            ids, found, held, first = batch.column(0), [], 0, 0
            for at, (doc_id, value) in enumerate(zip(ids.to_pylist(), batch.column(1)), 1):
                found.append(rearrange(value.as_py() or b"", doc_id, seed, fim_percent, spm_percent, marks, units))
                held += len(found[-1][-1])
                if held >= PIECE_BYTES or at == len(ids):
                    made = [pa.array(column, _ARROW[f.name]) for f, column in zip(_RESULT, zip(*found))]
                    yield pa.RecordBatch.from_arrays([ids.slice(first, at - first), *made], [f.name for f in schema])
                    found, held, first = [], 0, at

    return rows.mapInArrow(run, schema).withColumn("output", F.col("output").cast("string"))


def restore(transformed: DataFrame, sentinels: tuple[str, str, str] = SENTINELS, form: str = "form",
            output: str = "output", name: str = "restored") -> DataFrame:
    """Add the text that ``output`` and ``form`` stand for, with column functions only.

    No part of a transformed text holds a sentinel, and no sentinel starts with the end of another, so
    the three in an output are found by splitting it.
    """
    parts = F.split(F.col(output), "|".join(re.escape(s) for s in sentinels))
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return transformed.withColumn(
        name, F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output)))
