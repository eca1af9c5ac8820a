"""Near-duplicate groups by SimHash, compared exactly in tiles.

A text's fingerprint has 64 bits; a bit is set if it is set in more than half of the hashes of the
text's word shingles. Two texts are linked if their fingerprints differ in at most ``radius`` bits,
and a document's component is what its links reach.

Every pair of distinct fingerprints that can be near is compared, in tiles: numpy exclusive-or and
bit counts of one block of fingerprints against another. A fingerprint's cell is the bit counts of
its equal parts (2, 4 or 8 parts). The bit counts of two fingerprints differ by no more than their
distance, part by part, so tiles whose cells differ by more than the radius in all are skipped,
which loses nothing. Cells too large for one tile are dealt over several. Each pair of tiles is a
row of a join on the cell, so tasks share the work and none holds more than two tiles.

The compared pairs still grow with the square of the number of distinct fingerprints; more parts
make the constant smaller (about 0.4, 0.13 and 0.01 of all pairs) and the copies of tiles more
numerous (21, 161, 1825 per fingerprint). ``parts_for`` chooses by the number of fingerprints;
links are the same for each choice.

Within a pair of tiles only a spanning forest of the links found is passed on: groups of copies
never become all their pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructType

from .common import Scratch, words_of
from .components import components

SHINGLE_WORDS = 4
RADIUS = 4
TILE = 4096
_CHUNK = 1 << 17
_U64 = np.dtype("<u8")


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of a text as an unsigned number; 0 for a text without words."""
    words = words_of(text)
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    k = min(shingle_words, len(words))
    starts = np.concatenate(([0], ends[:len(words) - k] + 1)).tolist()
    stops = ends[k - 1:].tolist()
    digest, counts, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(starts)
    for at in range(0, n, _CHUNK):
        hashes = np.fromiter(
            (digest(joined[i:j], 42) for i, j in zip(starts[at:at + _CHUNK], stops[at:at + _CHUNK])),
            _U64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(_U64)[0])


def fingerprints(rows: DataFrame, text: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``rid, id, fp`` from ``rid, id`` and a text; ``fp`` is the fingerprint as a signed number."""
    def run(batches):
        for batch in batches:
            found = [fingerprint(t, shingle_words) for t in batch.column(text).to_pylist()]
            fp = pa.array(np.array(found, _U64).view("<i8"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("id"), fp], ["rid", "id", "fp"])

    kept = rows.select("rid", "id", text)
    schema = StructType([kept.schema["rid"], kept.schema["id"]]).add("fp", LongType())
    return kept.mapInArrow(run, schema)


def parts_for(distinct: int) -> int:
    return 2 if distinct <= 1 << 21 else 4 if distinct <= 1 << 25 else 8


def _cell(parts: int):
    """The bit counts of the equal parts of ``fp``, one base-128 digit each."""
    width, code = 64 // parts, F.lit(0).cast("long")
    for i in range(parts):
        part = F.shiftrightunsigned(F.col("fp"), i * width).bitwiseAND(F.lit((1 << width) - 1))
        code = code * 128 + F.bit_count(part)
    return code


def _neighbour_steps(parts: int, radius: int) -> list[int]:
    """Differences between the codes of cells that can be near, one of each opposite pair."""
    def steps(left: int, room: int):
        if not left:
            yield ()
            return
        for d in range(-room, room + 1):
            for rest in steps(left - 1, room - abs(d)):
                yield (d, *rest)

    zero = (0,) * parts
    codes = []
    for step in steps(parts, radius):
        if step >= zero:
            code = 0
            for d in step:
                code = code * 128 + d
            codes.append(code)
    return codes


def spanning_links(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the near pairs between two tiles connect; at most one per member."""
    n, both = len(left), np.concatenate((left, right))
    root = np.arange(len(both))
    for at in range(0, n, max(1, (1 << 22) // max(1, len(right)))):
        rows = left[at:at + max(1, (1 << 22) // max(1, len(right)))]
        near = np.bitwise_count(rows[:, None] ^ right[None, :]) <= radius
        i, j = np.nonzero(near)
        i, j = i + at, j + n
        while True:  # each round hooks roots to smaller ones, then every member jumps to its root
            a, b = root[i], root[j]
            differ = a != b
            if not differ.any():
                break
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := root[root], root):
                root = up
    linked = np.nonzero(root != np.arange(len(both)))[0]
    a, b = both[linked], both[root[linked]]
    return a[a != b], b[a != b]


def _links_of_tiles(radius: int):
    def run(batches):
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            for x, y in zip(left, right):
                a, b = spanning_links(x.values.to_numpy().view(_U64), y.values.to_numpy().view(_U64),
                                      radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view("<i8")), pa.array(b.view("<i8"))], ["a", "b"])
    return run


def near_links(distinct: DataFrame, scratch: Scratch, radius: int = RADIUS, tile: int = TILE,
               parts: int | None = None) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp``, which connect whatever is near."""
    parts = parts or parts_for(distinct.count())
    cells = distinct.select("fp", _cell(parts).alias("cell"))
    sizes = cells.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    sizes = scratch.save(sizes, "cells")
    most = sizes.agg(F.max("tiles")).first()[0] or 1
    tiles = scratch.save(
        cells.join(sizes, "cell")
        .groupBy("cell", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int").alias("no"))
        .agg(F.collect_list("fp").alias("fps")), "tiles")
    # a cell of very many tiles is met in several tasks
    ways = -(-most // 4)
    steps = F.explode(F.array(*map(F.lit, _neighbour_steps(parts, radius))))
    left = tiles.select("cell", "no", F.col("fps").alias("left"), steps.alias("step")).select(
        "no", "left", "step", (F.col("cell") + F.col("step")).alias("to"),
        F.explode(F.sequence(F.lit(0), F.lit(ways - 1))).alias("way"))
    right = tiles.select(F.col("cell").alias("to"), F.col("no").alias("no_r"),
                         F.col("fps").alias("right"), (F.col("no") % ways).alias("way"))
    tasks = max(distinct.sparkSession.sparkContext.defaultParallelism * 4,
                int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pairs = left.repartition(tasks, "to", "way").join(right.repartition(tasks, "to", "way"), ["to", "way"])
    pairs = pairs.where("step != 0 OR no <= no_r").select("left", "right")
    return pairs.mapInArrow(_links_of_tiles(radius), "a long, b long")


def simhash_groups(rows: DataFrame, scratch: Scratch, text: str = "text",
                   shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS, tile: int = TILE,
                   parts: int | None = None) -> DataFrame:
    """``rid, id, fp, component_id, kept`` for every row of ``rid, id`` and a text.

    ``component_id`` is the smallest id that the row's links reach, itself included; null ids count
    only if there is no other. One row of each component stays: the one with the smallest id, and
    of equal ids the smallest ``rid``. Null and empty texts have fingerprint zero, which is linked
    like any other. An empty table gives no rows.
    """
    prints = scratch.save(fingerprints(rows, text, shingle_words), "fingerprints")
    order = F.struct(F.col("id").isNull(), "id", "rid")
    distinct = scratch.save(prints.groupBy("fp").agg(F.min(order).alias("first")), "distinct")
    links = near_links(distinct.select("fp"), scratch, radius, tile, parts)
    roots = components(links, scratch)
    rooted = scratch.save(
        distinct.join(roots, F.col("fp") == F.col("node"), "left")
        .select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    firsts = rooted.groupBy("root").agg(F.min("first").alias("stays"))
    of_print = scratch.save(rooted.join(firsts, "root").select("fp", "stays"), "of-fingerprint")
    return prints.join(of_print, "fp").select(
        "rid", "id", "fp", F.col("stays.id").alias("component_id"),
        (F.col("stays.rid") == F.col("rid")).alias("kept"))


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """``id_col, fingerprint`` (16 hex digits), ``component_id, kept`` for every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
                       F.col(text).alias("text"))
    found = simhash_groups(rows, scratch, **options)
    return found.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id", "kept")


def drop_near_copies(docs: DataFrame, text: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """The row that stays of each group, with the columns it came with."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.save(docs.select(F.monotonically_increasing_id().alias("rid"),
                                    F.struct("*").alias("row")), "rows")
    plain = rows.select("rid", F.col("row")[id_col].alias("id"), F.col("row")[text].alias("text"))
    gone = simhash_groups(plain, scratch, **options).where("NOT kept").select("rid")
    return rows.join(scratch.save(gone, "gone"), "rid", "left_anti").select("row.*")
