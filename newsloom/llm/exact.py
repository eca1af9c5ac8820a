"""Exact deduplication by deterministic block naming, in DataFrame operations only.

Every text is cut into blocks of a fixed number of bytes. Equal blocks get one integer name, which
is the block's place among the distinct blocks, sorted by hash and content. Then adjacent names are paired and the
sorted distinct pairs named in the same way, level by level, until every document has one name.
Names come from comparing contents, so two texts have one name only if they are equal.

Two things keep the cost at about one pass over the text:

* A block whose hash no other block has cannot equal any other. It is named apart, by a negative
  number of its own, and is not sorted. The hash only sets such blocks aside; which blocks are
  equal is decided by the sort. A pair with a negative name is unique too and takes that name.
* Hot groups shrink before each shuffle: contents and pairs are made distinct in the map tasks,
  and names come back by joins whose skewed partitions are split at run time.

The hashes that occur twice are brought to the block table as their last 20 bits: at most 2^20
numbers however large the input, which is why that side may be broadcast. More bits in use only
mean that more blocks are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import Scratch

BLOCK_BYTES = 4096
_COARSE = 1 << 20


def _coarse(h: Column) -> Column:
    return F.pmod(h, F.lit(_COARSE)).cast("int").alias("_coarse")


def _blocks(rows: DataFrame, block_bytes: int) -> DataFrame:
    """``rid, n, pos, block``: the blocks of every text; an empty text has one empty block."""
    at = F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("pos")
    return rows.select("rid", "n", "body", at).select(
        "rid", "n", "pos",
        F.col("body").substr(F.col("pos") * block_bytes + 1, F.lit(block_bytes)).alias("block"))


def _ranked(distinct: DataFrame, keys: list[str], scratch: Scratch) -> DataFrame:
    """Distinct keys with their place in sorted order as ``name``: the number of the range and the
    place in it. Ranges are cut on a hash of the keys, so the sample for the cuts holds no contents."""
    hashed = distinct.withColumn("h", F.xxhash64(*keys))
    ordered = hashed.repartitionByRange("h").sortWithinPartitions("h", *keys)
    return scratch.save(ordered.select(*keys, F.monotonically_increasing_id().alias("name")), "names")


def identities(docs: DataFrame, scratch: Scratch, text: str = "text",
               block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """All rows with a row number ``rid``, and ``rid, n, name`` for each: rows have equal texts if
    and only if ``n`` and ``name`` are equal. A null text counts as empty."""
    source = scratch.save(
        docs.select(F.monotonically_increasing_id().alias("rid"), F.struct("*").alias("row")), "rows")
    body = F.coalesce(F.col("row")[text], F.lit("")).cast("binary")
    rows = source.withColumn(
        "n", F.greatest(F.lit(1), F.ceil(F.length(body) / block_bytes)).cast("int"))
    blocks = _blocks(rows.select("rid", "n", body.alias("body")), block_bytes)

    twice = blocks.groupBy(F.xxhash64("block").alias("h")).count().where("count > 1")
    coarse = scratch.save(twice.select(_coarse(F.col("h"))).distinct(), "coarse")
    flagged = blocks.join(
        F.broadcast(coarse.withColumn("seen", F.lit(True))),
        _coarse(F.xxhash64("block")) == F.col("_coarse"), "left").drop("_coarse")
    names = _ranked(flagged.where("seen").select("block").distinct(), ["block"], scratch)
    named = flagged.where("seen").join(names, "block").select("rid", "n", "pos", "name")
    alone = flagged.where("seen IS NULL").select(
        "rid", "n", "pos", (F.lit(-1) - F.monotonically_increasing_id()).alias("name"))
    level = scratch.save(named.unionByName(alone), "level")
    longest = rows.agg(F.max("n")).first()[0] or 1

    done = [level.where("n = 1").select("rid", "n", "name")]
    width = 1
    while width < longest:
        level, width = _next_level(level, width, scratch), 2 * width
        last = level.where((F.col("n") > width // 2) & (F.col("n") <= width))
        done.append(last.select("rid", "n", "name"))
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    return rows, found


def _next_level(level: DataFrame, width: int, scratch: Scratch) -> DataFrame:
    """Name the adjacent pairs of documents that have more than one name left."""
    first = F.col("pos") % 2 == 0
    pairs = scratch.save(
        level.where(F.col("n") > width)
        .groupBy("rid", "n", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
        .agg(F.max(F.when(first, F.col("name"))).alias("a"),
             F.max(F.when(~first, F.col("name"))).alias("b")), "pairs")
    b = F.coalesce("b", F.lit(0))
    unique = (F.col("a") < 0) | (b < 0)
    # the last name of an odd row stays unpaired; it is told apart from a pair by its length
    open_ = pairs.where(~unique).select("rid", "n", "pos", "a", F.coalesce("b", F.lit(-1)).alias("b"))
    names = _ranked(open_.select("a", "b").distinct(), ["a", "b"], scratch)
    named = open_.join(names, ["a", "b"]).select("rid", "n", "pos", "name")
    closed = pairs.where(unique).select("rid", "n", "pos", F.least("a", b).alias("name"))
    return scratch.save(named.unionByName(closed), "level")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Of equal texts the row with the largest id stays; a null id is smallest, and of rows that are
    equal in id and text one stays. Null texts equal empty ones. An empty table gives no rows.
    Columns of ``docs`` with one of those names are replaced; other names cannot clash.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    rows, decisions = decide(docs, scratch, id_col, text, block_bytes)
    made = ["keep_id", "group_size", "kept", "text_sha256"]
    own = [F.col("row")[c].alias(c) for c in docs.columns if c not in made]
    sha = F.sha2(F.coalesce(F.col("row")[text], F.lit("")), 256).alias("text_sha256")
    rid = f"rid_{scratch.run}"  # no column of docs has this name
    joined = rows.select(F.col("rid").alias(rid), *own, sha).join(
        decisions.withColumnRenamed("rid", rid), rid)
    return joined.drop(rid)


def decide(docs: DataFrame, scratch: Scratch, id_col: str, text: str,
           block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """The rows, and ``rid, keep_id, group_size, kept`` for each."""
    rows, found = identities(docs, scratch, text, block_bytes)
    keyed = scratch.save(
        found.join(rows.select("rid", F.col("row")[id_col].alias("id")), "rid"), "identities")
    groups = scratch.save(
        keyed.where("name >= 0").groupBy("n", "name")
        .agg(F.max(F.struct("id", "rid")).alias("stays"), F.count("*").alias("group_size"))
        .where("group_size > 1"), "groups")
    decisions = scratch.save(keyed.join(groups, ["n", "name"], "left").select(
        "rid", F.when(F.col("stays").isNull(), F.col("id")).otherwise(F.col("stays.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("stays.rid") == F.col("rid"), F.lit(True)).alias("kept")), "decisions")
    scratch.drop(keyed, groups)
    return rows, decisions


def drop_exact_copies(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows that stay, with the columns they came with, in one row of each class."""
    scratch = Scratch(docs.sparkSession, "exact")
    rows, decisions = decide(docs, scratch, id_col, text)
    gone = scratch.save(decisions.where("NOT kept").select("rid"), "gone")
    return rows.join(gone, "rid", "left_anti").select("row.*")
